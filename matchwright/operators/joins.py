"""Joins in which a null key equals a null key.

Catalyst keeps ``<=>`` an equi-join, so these plan as hash or sort-merge joins
like any other; whether a side is broadcast is left to Spark's size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]


def key_pairs(on: Key | Sequence[Key]) -> list[tuple[str, str]]:
    """``"a"``, ``("a", "b")`` or a list of these, as (left, right) pairs.

    A tuple is always one differently named pair; use a list for several keys.
    """
    keys = on if isinstance(on, list) else [on]
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys]


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Key | list[Key],
    how: str = "inner",
    suffixes: tuple[str, str] = ("", "_right"),
) -> DataFrame:
    """Join on null-safe equality.

    Key columns appear once, under the left name (coalesced in a full join).
    Other columns present on both sides get the suffixes.
    """
    pairs = key_pairs(on)
    condition = " AND ".join(f"l.{quoted(a)} <=> r.{quoted(b)}" for a, b in pairs)
    joined = left.alias("l").join(right.alias("r"), F.expr(condition), how)
    if how in ("left_anti", "left_semi"):
        return joined
    left_keys, right_keys = dict(pairs), {b for _, b in pairs}
    left_columns = left.columns
    right_rest = [c for c in right.columns if c not in right_keys]
    clash = (set(left_columns) - set(left_keys)) & set(right_rest)
    out = []
    for c in left_columns:
        value = f"l.{quoted(c)}"
        if c in left_keys and how in ("full", "full_outer", "outer"):
            value = f"coalesce({value}, r.{quoted(left_keys[c])})"
        out.append(f"{value} AS {quoted(c + suffixes[0] if c in clash else c)}")
    for c in right_rest:
        name = c + suffixes[1] if c in clash or c in left_keys else c
        out.append(f"r.{quoted(c)} AS {quoted(name)}")
    return joined.selectExpr(*out)


def lookup(df: DataFrame, dimension: DataFrame, on: Key | list[Key]) -> DataFrame:
    """Left join to a dimension that was projected to its key and payload."""
    return null_safe_join(df, dimension, on, "left")


def without(df: DataFrame, used: DataFrame, on: Key | list[Key]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``used``.

    Only the key columns of ``used`` are read. Its distinct keys are taken
    first (with map-side combine), so a key repeated a billion times reaches
    the join once.
    """
    pairs = key_pairs(on)
    keys = used.select(*[quoted(b) for _, b in pairs]).distinct()
    return null_safe_join(df, keys, on, "left_anti")


def within(df: DataFrame, used: DataFrame, on: Key | list[Key]) -> DataFrame:
    """Rows of ``df`` whose key is in ``used``."""
    pairs = key_pairs(on)
    keys = used.select(*[quoted(b) for _, b in pairs]).distinct()
    return null_safe_join(df, keys, on, "left_semi")
