"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.operators.joins import Key, null_safe_join


def split_by_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows where the column is set, rows where it is null)."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def regex_lookup(
    df: DataFrame,
    column: str,
    pattern: str,
    equals: Mapping[str, Any] | None = None,
    isin: Mapping[str, Sequence[Any]] | None = None,
    or_equals: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Rows in which the pattern is found and all ``equals``/``isin`` hold,
    or in which one of ``or_equals`` holds."""
    found = F.col(column).rlike(pattern)
    for name, value in (equals or {}).items():
        found = found & (F.col(name) == F.lit(value))
    for name, values in (isin or {}).items():
        found = found & F.col(name).isin(list(values))
    for name, value in (or_equals or {}).items():
        found = found | (F.col(name) == F.lit(value))
    return df.filter(found)


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which all of the columns are null."""
    return df.na.drop(how="all", subset=list(columns))


def _matches(rule: Mapping[str, Any]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c) == F.lit(v) for c, v in rule.items()])


def apply_exclusions(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Drop rows that meet any rule (all of its column = value tests hold).

    The tests are three-valued, as in a WHERE clause: a row for which a rule
    is undecided because a tested column is null is dropped as well.
    """
    for rule in rules:
        df = df.filter(~_matches(rule))
    return df


def apply_exclusion_table(df: DataFrame, rules: DataFrame, on: Key | list[Key]) -> DataFrame:
    """Drop rows listed in a rules table; null equals null, nothing else goes."""
    return null_safe_join(df, rules, on, "left_anti")
