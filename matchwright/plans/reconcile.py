"""Fold any number of coded sources into one table, and report the differences.

Which sources hold a key, and how often, is one census: the tagged keys of all
sources, grouped with map-side combine. Agreed and gap rows, and the full fold,
are then the rows of the sources met with that census, instead of chains of full
joins; a key repeated within sources comes out as often as the joins would
make it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.operators.counts import several_values
from matchwright.operators.filters import apply_exclusions, drop_all_null
from matchwright.operators.joins import lookup, null_safe_join, quoted, without
from matchwright.operators.reshape import pivot_longer_multi, stack_rows
from matchwright.sources.staging import stage_table

Sources = Mapping[str, DataFrame]


def _tagged(df: DataFrame, key: str, columns: Sequence[str], tag: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{c}_{tag}") for c in columns])


def multi_source_inner(sources: Sources, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys of all sources, each column suffixed with its source's name."""
    frames = [_tagged(df, key, columns, tag) for tag, df in sources.items()]
    return reduce(lambda a, b: null_safe_join(a, b, key, "inner"), frames)


# Rows of one key in one source above which its rows are dealt out. A table of
# the keys above it has at most its rows / SPLIT_ABOVE rows.
SPLIT_ABOVE = 1 << 20


def multi_source_full(
    sources: Sources, key: str, columns: Sequence[str], split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """Keys of any source, each column suffixed with its source's name.

    The census of all sources says which keys a source lacks: these join it as
    rows of nulls, and then every source has every key, null included, and the
    fold is inner joins on one key. A key with more than ``split_above`` rows
    in a source is dealt out by salts: its largest source's rows get one each,
    the others' rows all of them, so every combination comes about once.
    """
    tags = list(sources)
    census = stage_table(key_census(sources, key), "census")
    counts = [f"n_{t}" for t in tags]
    most = F.greatest(*counts) if len(counts) > 1 else F.col(counts[0])
    hot = census.where(most > split_above).select(
        key,
        F.ceil(most / split_above).alias("__salts"),
        F.array_position(F.array(*counts), most).alias("__largest"),
    )
    folded = []
    for i, (tag, df) in enumerate(sources.items()):
        own = _tagged(df, key, columns, tag)
        padded = own.unionByName(
            census.where(f"{quoted(f'n_{tag}')} = 0").select(key), allowMissingColumns=True
        )
        folded.append(_dealt_out(padded, hot, key, i + 1))
    joined = reduce(lambda a, b: null_safe_join(a, b, [key, "__salt"], "inner"), folded)
    return joined.drop("__salt")


def _dealt_out(rows: DataFrame, hot: DataFrame, key: str, place: int) -> DataFrame:
    """Rows with ``__salt``: 0, or of a hot key one salt in its largest source and all in others."""
    numbered = rows.withColumn("__row", F.xxhash64(F.monotonically_increasing_id()))
    met = null_safe_join(numbered, hot, key, "left")
    every = F.sequence(F.lit(0).cast("bigint"), F.col("__salts") - 1)
    salt = (
        F.when(F.col("__salts").isNull(), F.array(F.lit(0).cast("bigint")))
        .when(F.col("__largest") == place, F.array(F.pmod("__row", "__salts")))
        .otherwise(every)
    )
    return met.select(key, F.explode(salt).alias("__salt"), *[c for c in rows.columns if c != key])


def key_census(sources: Sources, key: str) -> DataFrame:
    """One row per key with ``n_<source>`` counts and ``in_all``."""
    tags = list(sources)
    union = stack_rows(
        [df.select(key, F.lit(i).alias("__source")) for i, df in enumerate(sources.values())],
        strict=True,
    )
    census = union.groupBy(key).agg(
        *[F.count_if(F.col("__source") == i).alias(f"n_{tag}") for i, tag in enumerate(tags)]
    )
    in_all = reduce(lambda a, b: a & b, [F.col(f"n_{tag}") > 0 for tag in tags])
    return census.withColumn("in_all", in_all)


def _times_others(tags: Sequence[str], tag: str) -> Column:
    """How often a join of all sources repeats one row of source ``tag``."""
    others = [F.greatest(F.col(f"n_{t}"), F.lit(1)) for t in tags if t != tag]
    return reduce(lambda a, b: a * b, others, F.lit(1).cast("bigint"))


# Copies that one step of the spreading makes of a row.
_AT_ONCE = 1 << 16


def _repeated(
    df: DataFrame, times: Column, columns: Sequence[str], counted: str | None
) -> DataFrame:
    """Each row ``times`` over, or once with that number as column ``counted``.

    Rows are spread in two steps, of blocks of copies and of the copies of a
    block, so that no array grows with the product of the sources' counts.
    """
    if counted is not None:
        return df.select(*columns, times.alias(counted))
    last = F.lit(_AT_ONCE).cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(__times - 1) DIV {_AT_ONCE}"))
    spread = df.withColumn("__times", times).where("__times > 0").withColumn("__block", F.explode(blocks))
    left = F.least(F.col("__times") - F.col("__block") * last, last)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), left))
    return spread.withColumn("__copy", copies).select(*columns)


def agreed_rows(
    sources: Sources, key: str, value: str, preferred: str, counted: str | None = None
) -> DataFrame:
    """(key, value) of the keys that all sources hold, valued by ``preferred``.

    A key that sources repeat comes out as often as joins would make it;
    ``counted`` names a column that says how often instead. Null is a key.
    """
    census = key_census(sources, key).filter("in_all")
    rows = null_safe_join(sources[preferred].select(key, value), census, key)
    return _repeated(rows, _times_others(list(sources), preferred), [key, value], counted)


def value_conflicts(
    sources: Sources, key: str, value: str, counted: str | None = None
) -> DataFrame:
    """Keys of all sources whose first source's value differs from another's.

    Nulls never differ. Equal (key, value) rows of a source are counted before
    the joins and spread out after the filter, or counted, as in ``agreed_rows``.
    """
    tags = list(sources)
    frames = [
        df.groupBy(key, F.col(value).alias(f"{value}_{tag}")).agg(
            F.count(F.lit(1)).alias(f"__n_{tag}")
        )
        for tag, df in sources.items()
    ]
    joined = reduce(lambda a, b: null_safe_join(a, b, key, "inner"), frames)
    first = F.col(f"{value}_{tags[0]}")
    differs = reduce(lambda a, b: a | b, [first != F.col(f"{value}_{t}") for t in tags[1:]])
    times = reduce(lambda a, b: a * b, [F.col(f"__n_{t}") for t in tags])
    return _repeated(
        joined.filter(differs), times, [key, *[f"{value}_{t}" for t in tags]], counted
    )


def gap_rows_wide(
    sources: Sources, key: str, columns: Sequence[str], split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """Full fold of the sources without the keys that all of them hold."""
    agreed = key_census(sources, key).filter("in_all").select(key)
    # taken out of every source first, so the agreed bulk never meets the fold
    partial = {tag: null_safe_join(df, agreed, key, "left_anti") for tag, df in sources.items()}
    return multi_source_full(partial, key, columns, split_above)


def gap_rows_long(
    sources: Sources,
    key: str,
    columns: Sequence[str],
    tag: str = "source",
    counted: str | None = None,
) -> DataFrame:
    """One row per key and holding source, for keys that some source lacks.

    Rows whose columns are all null are dropped; repeated keys as in
    ``agreed_rows``.
    """
    tags = list(sources)
    census = key_census(sources, key).filter(~F.col("in_all"))
    rows = stack_rows(
        [df.select(key, F.lit(t).alias(tag), *columns) for t, df in sources.items()], strict=True
    )
    held = drop_all_null(null_safe_join(rows, census, key), columns)
    times = reduce(
        lambda acc, t: F.when(F.col(tag) == t, _times_others(tags, t)).otherwise(acc),
        tags,
        F.lit(1).cast("bigint"),
    )
    return _repeated(held, times, [key, tag, *columns], counted)


def gaps_to_long(
    wide: DataFrame, key: str, columns: Sequence[str], tags: Sequence[str], tag: str = "source"
) -> DataFrame:
    """The long form of a wide gap table, all-null rows dropped."""
    pattern = f"({'|'.join(columns)})_({'|'.join(tags)})"
    return drop_all_null(pivot_longer_multi(wide, key, pattern, tag), columns)


def conflict_report(rows: DataFrame, by: str, over: str) -> DataFrame:
    """Distinct (by, over) where one ``by`` has several ``over``, with ``n``."""
    return several_values(rows, by, over)


def corrected_gaps(
    gaps: DataFrame,
    exclusions: Sequence[Mapping[str, Any]],
    key: str,
    columns: Sequence[str],
) -> DataFrame:
    """Gap rows without the excluded records, distinct."""
    return apply_exclusions(gaps, exclusions).select(key, *columns).distinct()


def merge_reconciled(
    agreed: DataFrame,
    gaps: DataFrame,
    dimension: DataFrame,
    key: str,
    value: str,
) -> DataFrame:
    """Agreed rows and corrected gap rows under the dimension's columns."""
    both = stack_rows([agreed.select(key, value), gaps.select(key, value)], strict=True)
    named = lookup(both, dimension, key)
    rest = [c for c in dimension.columns if c != key]
    return named.select(key, *rest, value)


def still_missing(input_rows: DataFrame, output: DataFrame, on: list) -> DataFrame:
    """Input rows whose key did not reach the output."""
    return without(input_rows, output, on)
