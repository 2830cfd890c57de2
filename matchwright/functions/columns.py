"""Column casts and column-list helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_integer(col: Column | str) -> Column:
    """Lenient integer: text that is a number is truncated, anything else null."""
    value = F.col(col) if isinstance(col, str) else col
    return value.try_cast("double").try_cast("int")


def columns_containing(df: DataFrame, text: str, ignore_case: bool = True) -> list[str]:
    """Names of the columns that contain ``text``."""
    if ignore_case:
        return [c for c in df.columns if text.lower() in c.lower()]
    return [c for c in df.columns if text in c]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns in which ``pattern`` is found."""
    return [c for c in df.columns if re.search(pattern, c)]


def move_first(df: DataFrame, *columns: str) -> DataFrame:
    """Reorder: the given columns, then all others in their order."""
    return df.select(*columns, *[c for c in df.columns if c not in columns])


def move_last(df: DataFrame, *columns: str) -> DataFrame:
    """Reorder: all other columns in their order, then the given ones."""
    return df.select(*[c for c in df.columns if c not in columns], *columns)


def map_columns(
    df: DataFrame, fn: Callable[[Column], Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """Apply ``fn`` to all (or the given) columns, keeping names and order."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(*[fn(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])
