"""Session settings the jobs are tuned for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Every broadcast in this library is Spark's own choice, made against
# autoBroadcastJoinThreshold on measured (AQE) or file-derived sizes; skewed
# shuffle partitions are split by AQE. Partition counts are left to AQE, which
# coalesces from whatever spark.sql.shuffle.partitions the cluster sets.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the joins on name signatures compute far more than they read
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cpus: int | str = "*",
    app_name: str = "matchwright",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session with the recommended settings, for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RECOMMENDED, **(extra or {})}.items():
        builder = builder.config(key, value)
    return name_stage_folder(builder.getOrCreate())


def name_stage_folder(spark: SparkSession) -> SparkSession:
    """Give a local session without a stage folder one of its own.

    On a cluster the folder must be shared, and so must be named by whoever
    sets the session up (``spark.checkpoint.dir``).
    """
    local = spark.conf.get("spark.master", "").startswith("local")
    if spark.conf.get("spark.checkpoint.dir", None) is None and local:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="matchwright-"))
    return spark
