"""Relaxed object literals (keys may be bare words) to flat rows."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.fixed_values import BARE_KEY_PATTERN, BARE_KEY_REPLACEMENT

# Ship this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NESTED = "map<string,map<string,array<string>>>"


def quote_bare_keys(text: Column) -> Column:
    """Put quotes around the bare keys of an object literal."""
    return F.regexp_replace(text, BARE_KEY_PATTERN, BARE_KEY_REPLACEMENT)


def _parsed(text_col: str) -> Column:
    return F.from_json(quote_bare_keys(F.col(text_col)), _NESTED)


def rejected_literals(df: DataFrame, text_col: str) -> DataFrame:
    """The rows of ``df`` whose record ``flatten_literals`` cannot read."""
    doc = _parsed(text_col)
    return df.where(doc.isNull() | F.exists(F.map_values(doc), lambda inner: inner.isNull()))


def flatten_literals(
    df: DataFrame,
    text_col: str,
    outer: str = "block",
    inner: str = "name",
    value: str = "value",
) -> DataFrame:
    """``{outer: {inner: ["v"]}}`` in a text column to one row per leaf.

    Each record is parsed once and on its own, so any number of rows and files
    run in parallel. A record that does not read as such a literal (null, cut
    short, a null in place of an inner object) raises; ``rejected_literals``
    finds those beforehand. So does a leaf array that does not hold exactly one
    element. An empty object has no leaves and so no rows. Of a repeated key
    the last one counts. Other columns of ``df`` are kept.
    """
    keep = [F.col(c) for c in df.columns if c != text_col]
    bad = F.raise_error(F.lit("a record is not a readable literal"))
    parsed = df.select(*keep, F.coalesce(_parsed(text_col), bad).alias("__doc"))
    # outer: from an inner explode the optimizer infers a filter that parses again
    blocks = parsed.select(*keep, F.explode_outer("__doc").alias(outer, "__inner"))
    blocks = blocks.where(F.col(outer).isNotNull()).withColumn("__inner", F.coalesce("__inner", bad))
    leaves = blocks.select(*keep, outer, F.explode_outer("__inner").alias(inner, "__leaf"))
    leaves = leaves.where(F.col(inner).isNotNull())
    single = F.when(F.size("__leaf") == 1, F.element_at("__leaf", 1)).otherwise(
        F.raise_error(F.lit("a leaf of the literal is not a one-element array"))
    )
    return leaves.select(*keep, outer, inner, single.alias(value))


_MARK = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]', re.DOTALL)


def _pieces(text: str, most: int) -> Iterator[str | None]:
    """Literals of about ``most`` characters that together hold all leaves.

    Braces are counted outside quotes. A piece holds entries of one outer key
    and no inner key twice. A record that is not nested so ends with None.
    """
    depth, start, colon, closed = 0, 0, -1, 0
    outer, entries, keys, size, told = "", [], set(), 0, False

    def piece() -> str:
        return "{" + outer + "{" + ",".join(entries) + "}}"

    for mark in _MARK.finditer(text):
        at, sign = mark.start(), mark.group()
        if sign[0] == '"':
            continue
        if depth == 2 and sign in ",}":
            entry, key = text[start:at], text[start:colon].strip().strip('"')
            start = mark.end()
            if entry.strip() or sign == "," or entries:
                if entries and (size + len(entry) > most or key in keys or "\\" in key):
                    yield piece()
                    entries, keys, size, told = [], set(), 0, True
                entries.append(entry)
                keys.add(key)
                size += len(entry) + 1
            if sign == "}":
                if entries or not told:
                    yield piece()
                depth, closed = 1, mark.end()
        elif sign in "{[":
            depth += 1
            if depth <= 2 and sign == "[" or depth == 1 and text[:at].strip():
                break
            if depth == 2:
                outer, entries, keys, size, told = text[start:at], [], set(), 0, False
            if depth <= 2:
                start = mark.end()
        elif sign in "}]":
            depth -= 1
            if depth <= 0:
                empty = not text[start:at].strip() and not closed
                whole = sign == "}" and depth == 0 and not text[mark.end() :].strip()
                if whole and empty:
                    yield "{}"
                    return
                if whole and closed and not text[closed:at].strip():
                    return
                break
        elif sign == ",":
            if depth == 1:
                if not closed or text[closed:at].strip():
                    break
                start = closed = mark.end()
        elif depth == 2 and colon < start:
            colon = at
    yield None


def cut_literals(df: DataFrame, text_col: str, most: int = 1 << 16) -> DataFrame:
    """``df`` with every record cut into literals of about ``most`` characters.

    For records too long to be parsed at once: a row goes through one task as
    text, and its leaves go on in many small rows, which can be dealt out.
    Keys that a record repeats come into separate pieces, so none is lost.
    A record that is null or not nested as expected gives a null row, besides
    what was cut from it before; an empty object stays one.
    """
    schema, place = df.schema, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            pieces: list[str | None] = []
            held = 0

            def flush() -> pa.RecordBatch:
                columns = [c.take(pa.array(rows, pa.int64())) for c in batch.columns]
                columns[place] = pa.array(pieces, batch.schema.field(place).type)
                return pa.RecordBatch.from_arrays(columns, batch.schema.names)

            for i in range(batch.num_rows):
                text = batch.column(place)[i].as_py()
                for piece in [None] if text is None else _pieces(text, most):
                    rows.append(i)
                    pieces.append(piece)
                    held += len(piece or "")
                    if held > 1 << 20:
                        yield flush()
                        rows, pieces, held = [], [], 0
            if rows:
                yield flush()

    return df.mapInArrow(run, schema)


def flatten_long_literals(
    df: DataFrame,
    text_col: str,
    outer: str = "block",
    inner: str = "name",
    value: str = "value",
    most: int = 1 << 16,
) -> DataFrame:
    """``flatten_literals`` for records of any length that fits into a row.

    Of a repeated key every leaf counts. Records that do not read as a literal
    raise here too.
    """
    return flatten_literals(cut_literals(df, text_col, most), text_col, outer, inner, value)


def read_object_literals(
    spark: SparkSession, path: str | list[str], one_per_file: bool = False, **names: str
) -> DataFrame:
    """Read text files of object literals, one per line or one per file."""
    text = spark.read.text(path, wholetext=one_per_file)
    return flatten_literals(text.filter(F.length(F.trim("value")) > 0), "value", **names)
