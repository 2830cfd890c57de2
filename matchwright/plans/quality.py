"""Checks of a table as one result table, and profiles of several sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.operators.joins import key_pairs, quoted
from matchwright.operators.reshape import stack_rows
from matchwright.operators.similarity import alike


def source_profile(sources: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Rows and nulls of one column per source, in one job.

    A source without rows is reported with zeros.
    """
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(column).isNull()).alias("n_nulls"),
        ).select(F.lit(tag).alias("source"), "n_rows", "n_nulls")
        for tag, df in sources.items()
    ]
    return stack_rows(parts, strict=True)


def any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: whether any of the columns holds a null."""
    missing = _any_null_of(columns or df.columns)
    return df.agg(F.coalesce(F.bool_or(missing), F.lit(False)).alias("any_null"))


def _any_null_of(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _text(col: Column) -> Column:
    return col.cast("string")


def quality_checks(
    df: DataFrame,
    key: str,
    value: str,
    duplicate_keys: Sequence[Sequence[str]] = (),
    input_rows: DataFrame | None = None,
    coverage_on: list | None = None,
) -> DataFrame:
    """(check, n_bad, sample): bad rows per check and the smallest bad key.

    Each duplicate check counts the rows of repeated keys, coverage the input
    rows whose key did not arrive. All checks come from one scan of ``df``: its
    rows are counted by the key, by every set of duplicate keys and by the
    coverage's key at the same time (grouping sets), input rows among them as
    rows that only ask. Group counts are combined before the shuffle, and one
    row per group is what the checks read.
    """
    on = key_pairs(coverage_on or [key])
    asking = input_rows is not None
    sets = list(
        dict.fromkeys(
            [(key,), *map(tuple, duplicate_keys), *([tuple(b for _, b in on)] if asking else [])]
        )
    )
    columns = list(dict.fromkeys(c for keys in sets for c in keys))
    named = {c: f"__key{i}" for i, c in enumerate(columns)}
    tests = {
        "null_key": F.col(key).isNull(),
        "null_value": F.col(value).isNull(),
        "zero_value": F.coalesce(F.col(value) == 0, F.lit(False)),
        "any_null": _any_null_of(df.columns),
    }
    rows = df.select(
        *[F.col(quoted(c)).alias(k) for c, k in named.items()],
        *[bad.cast("int").alias(f"__{test}") for test, bad in tests.items()],
        F.lit(1).alias("__own"),
    )
    if asking:
        asked = input_rows.select(*[F.col(quoted(a)).alias(named[b]) for a, b in on])
        rows, asked = alike(rows, asked, [named[b] for _, b in on])
        rows = rows.unionByName(asked.withColumn("__own", F.lit(0)), allowMissingColumns=True)
    groups = rows.groupingSets(
        [[named[c] for c in keys] for keys in sets], *named.values()
    ).agg(
        F.grouping_id().alias("__set"),
        F.sum("__own").alias("__n"),
        F.count_if(F.col("__own") == 0).alias("__asked"),
        *[F.sum(f"__{test}").alias(f"__{test}") for test in tests],
    )

    def among(keys: Sequence[str]) -> Column:
        """Whether a group is one of this set of keys: a bit for each left out."""
        left_out = [1 << i for i, c in enumerate(reversed(columns)) if c not in keys]
        return F.col("__set") == sum(left_out)

    def check(name: str, keys: Sequence[str], bad: Column, n: Column, shown: Column) -> Column:
        of = among(keys) & bad
        return F.struct(
            F.lit(name).alias("check"),
            F.coalesce(F.sum(F.when(of, n)), F.lit(0)).cast("bigint").alias("n_bad"),
            F.min(F.when(of, shown)).alias("sample"),
        )

    found = []
    for test in tests:
        n = F.col(f"__{test}")
        # the sample of null keys is null, as they are
        found.append(check(test, [key], n > 0, n, _text(F.col(named[key]))))
    for keys in duplicate_keys:
        shown = F.concat_ws("|", *[_text(F.col(named[k])) for k in keys])
        n = F.col("__n")
        found.append(check("duplicate_" + "_".join(keys), list(keys), n > 1, n, shown))
    if asking:
        first = _text(F.col(named[on[0][1]]))
        lost = (F.col("__n") == 0) & (F.col("__asked") > 0)
        found.append(check("not_covered", [b for _, b in on], lost, F.col("__asked"), first))
    return groups.agg(F.array(*found).alias("__checks")).select(F.inline("__checks"))
