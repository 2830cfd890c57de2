"""Tabular sources and sinks: delimited text, landed tables, inline rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How a missing value is spelled in delimited files.
NULL_TOKEN = "NA"
# Quotes inside a quoted field are doubled; blanks belong to a field.
_DIALECT = {
    "header": True,
    "nullValue": NULL_TOKEN,
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """Comma-separated files with a header, quoted as RFC 4180 has it.

    ``NA`` and empty fields are null, a quoted empty field (``""``) is empty
    text. The schema is declared, so the files are read once, and only the
    columns a query needs are parsed. Line breaks inside quotes need
    ``multi_line``, under which a file is one task; without them switch it off
    and large files are split.
    """
    reader = spark.read.schema(schema).options(**_DIALECT)
    return reader.option("emptyValue", "").option("multiLine", multi_line).csv(path)


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write comma-separated files with a header: nulls as ``NA``, empty text as
    ``""``. (A text that is ``NA`` cannot be told from a null when read.)"""
    df.write.mode(mode).options(**_DIALECT).option("emptyValue", '""').csv(path)


def read_landed(
    spark: SparkSession,
    path: str | list[str],
    renames: Mapping[str, str],
    file_format: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """A landed table whose headers (blanks, accents) are renamed on read."""
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        reader = reader.options(**_DIALECT).option("emptyValue", "").option("multiLine", True)
    return reader.load(path).withColumnsRenamed(dict(renames))


def drop_trailer(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """Drop the last ``n`` rows by a unique ordinal column.

    The tail is found by a top-n (each task keeps ``n`` rows), never by a
    global sort, and its ``n`` ordinals are removed by an anti join.
    """
    tail = (
        df.select(F.col(order_col).alias("__tail"))
        .orderBy(F.desc_nulls_last("__tail"))
        .limit(n)
    )
    return df.join(tail, F.col(order_col) == F.col("__tail"), "left_anti")


def read_without_trailers(
    spark: SparkSession, path: str | list[str], n: int, schema: StructType | str | None = None
) -> DataFrame:
    """Landed Parquet files, each without its last ``n`` rows.

    A row's place is its position in its file, which the scan itself knows, so
    no ordinal column is needed. The files' ends come from a scan of no column,
    combined per task. Files of ``n`` rows and fewer give none.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    landed = reader.parquet(*([path] if isinstance(path, str) else path))
    place = {"__file": F.col("_metadata.file_path"), "__at": F.col("_metadata.row_index")}
    ends = (
        landed.select(*(c.alias(name) for name, c in place.items()))
        .groupBy(F.col("__file").alias("__ended"))
        .agg(F.max("__at").alias("__last"))
    )
    rows = landed.select("*", *(c.alias(name) for name, c in place.items()))
    met = rows.join(ends, F.col("__file") == F.col("__ended"))
    return met.where(F.col("__at") <= F.col("__last") - n).select(*landed.columns)


def inline_table(
    spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[str]]
) -> DataFrame:
    """A hand-written table of strings."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r) for r in rows], schema)
