"""Unions, ordering and reshaping."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_rows(frames: Sequence[DataFrame], strict: bool = False) -> DataFrame:
    """Union by name. Unless ``strict``, a column missing in a frame is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), frames)


def sort_nulls_last(df: DataFrame, *columns: str, collation: str | None = None) -> DataFrame:
    """Ascending order with nulls last; strings by ``collation`` if given."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}

    def key(c: str) -> Column:
        return F.collate(F.col(c), collation) if collation and c in text else F.col(c)

    return df.orderBy(*[key(c).asc_nulls_last() for c in columns])


def smallest_values(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ascending order: a top-n, not a full sort."""
    return sort_nulls_last(df, *columns).limit(n)


def pivot_longer_multi(
    df: DataFrame, keep: str | Sequence[str], pattern: str, tag: str = "source"
) -> DataFrame:
    """Wide to long with several value columns at once.

    ``pattern`` has two groups and must match whole column names: the first
    names the value column of the result, the second is the row's tag. It is a
    narrow transformation (one generator, no shuffle).
    """
    keep = [keep] if isinstance(keep, str) else list(keep)
    found: dict[str, dict[str, str]] = {}
    values: list[str] = []
    for column in df.columns:
        hit = None if column in keep else re.fullmatch(pattern, column)
        if hit:
            value, source = hit.group(1), hit.group(2)
            found.setdefault(source, {})[value] = column
            if value not in values:
                values.append(value)
    rows = [
        F.struct(
            F.lit(source).alias(tag),
            *[
                (F.col(columns[v]) if v in columns else F.lit(None)).alias(v)
                for v in values
            ],
        )
        for source, columns in found.items()
    ]
    return df.select(*keep, F.inline(F.array(*rows)))
