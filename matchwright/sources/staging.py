"""Stage tables: results that several later jobs read, written once.

A stage table is Parquet in the shared folder that the cluster names in
``spark.checkpoint.dir``. It cuts the lineage like a checkpoint and survives
lost executors, and unlike an RDD checkpoint it keeps columnar pruning, filter
pushdown and an exact size for the join planner.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_root(spark: SparkSession) -> str:
    """The shared stage folder, as the session names it."""
    root = spark.conf.get(SETTING, None)
    if not root:
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return root.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/matchwright/{spark.conf.get('spark.app.id', 'app')}"


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the stage folder."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back, with its schema declared."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stage_path = path
    return table


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each job's shuffle files go at its end, not when the driver next collects
    garbage: for steps whose jobs write stage tables, so that none is read twice."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_tables(*tables: DataFrame) -> None:
    """Delete stage tables that nothing reads any more."""
    for table in tables:
        _delete(table.sparkSession, table.stage_path)


def drop_stages(spark: SparkSession) -> None:
    """Delete all stage tables of this application; frames over them end with it."""
    _delete(spark, _application_folder(spark))
