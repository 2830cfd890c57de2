"""Group sizes, duplicates, distinct values and multiset comparison.

Sizes are counted by a grouped aggregate (combined on the map side) and joined
back, not by a window: a window would bring every row of a hot key into one
task, while the join's skewed partitions are split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from matchwright.operators.joins import null_safe_join, quoted


def _as_list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def group_sizes(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """One row per key with its number of rows; null is a key like any other."""
    return df.groupBy(*_as_list(keys)).agg(F.count(F.lit(1)).alias(name))


def add_group_count(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Append the group's size to every row."""
    keys = _as_list(keys)
    return null_safe_join(df, group_sizes(df, keys, name), list(keys))


def find_duplicates(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """All rows whose key occurs more than once, with the number of times."""
    keys = _as_list(keys)
    repeated = group_sizes(df, keys, name).filter(F.col(name) > 1)
    return null_safe_join(df, repeated, list(keys))


def several_values(df: DataFrame, by: str, over: str, name: str = "n") -> DataFrame:
    """Distinct (by, over) pairs of every ``by`` that has more than one; null is
    a value. ``df`` is read twice: stage it first if it is costly."""
    return find_duplicates(df.select(by, over).distinct(), by, name)


def multiset_difference(
    left: DataFrame, right: DataFrame, name: str = "surplus"
) -> DataFrame:
    """Rows that one side has more often: positive = surplus on the left."""
    columns = left.columns
    both = left.withColumn("__sign", F.lit(1)).unionByName(
        right.select(*columns).withColumn("__sign", F.lit(-1))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("__sign").cast("bigint").alias(name))
        .filter(F.col(name) != 0)
    )


def _row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of whole rows that tells nulls apart by their place."""
    parts: list[Column] = [F.lit(seed)]
    for field in df.schema:
        column = F.col(quoted(field.name))
        parts += [column.isNull(), column]
        if isinstance(field.dataType, (ArrayType, StructType)):  # nulls inside are not hashed
            parts.append(F.to_json(F.struct(column), {"ignoreNullFields": "false"}))
    return F.xxhash64(*parts)


def _range_of(df: DataFrame, ranges: int) -> Column:
    return F.pmod(_row_hash(df, 1), F.lit(ranges))


def fingerprints(df: DataFrame, ranges: int) -> DataFrame:
    """(range, rows, one, two): order-free sums over the rows of each hash range.

    The sums are combined on the map side, so a task sends ``ranges`` rows at
    most, whatever it reads. A row adds two hashes of 64 bits.
    """
    return (
        df.select(_row_hash(df, 1).alias("__one"), _row_hash(df, 2).alias("__two"))
        .groupBy(F.pmod("__one", F.lit(ranges)).alias("range"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.sum(F.col(f"__{n}").cast("decimal(20,0)")).alias(n) for n in ("one", "two")),
        )
    )


def _alike(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the left's columns, in the types a union gives them."""
    right = right.select(*(F.col(quoted(c)) for c in left.columns))
    both = left.unionByName(right).schema

    def cast(df: DataFrame) -> DataFrame:
        if all(f.dataType == both[f.name].dataType for f in df.schema):
            return df
        return df.select(*(F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in both))

    return cast(left), cast(right)


def differing_ranges(left: DataFrame, right: DataFrame, ranges: int = 4096) -> list[int]:
    """Which of ``ranges`` hash ranges do not hold the same rows on both sides.

    Decided by counts and two 64-bit sums of hashes. The list reaches the
    driver: ``ranges`` numbers at most.
    """
    left, right = _alike(left, right)
    one = fingerprints(left, ranges).withColumnsRenamed(
        {"rows": "l_rows", "one": "l_one", "two": "l_two"}
    )
    apart = null_safe_join(one, fingerprints(right, ranges), "range", "full").where(
        "NOT (l_rows <=> rows AND l_one <=> one AND l_two <=> two)"
    )
    return sorted(r["range"] for r in apart.select("range").collect())


def ranged_difference(
    left: DataFrame, right: DataFrame, name: str = "surplus", ranges: int = 4096
) -> DataFrame:
    """``multiset_difference``, for sides expected to be nearly the same.

    Fingerprints tell which hash ranges differ; only their rows are shuffled
    and compared one by one, so equal sides shuffle fingerprints alone. Each
    side is read twice: stage it first if it is costly. Equality of a range is
    equality of 128 bits of sums, not of every row.
    """
    left, right = _alike(left, right)
    apart = differing_ranges(left, right, ranges)
    kept = [df.where(_range_of(df, ranges).isin(apart)) for df in (left, right)]
    return multiset_difference(*kept, name)


def multisets_equal(left: DataFrame, right: DataFrame) -> bool:
    """Whether both sides hold the same rows the same number of times.

    Rows are compared one by one only where the fingerprints of
    ``ranged_difference`` differ (as they do for a zero and its negative).
    """
    return ranged_difference(left, right).isEmpty()
