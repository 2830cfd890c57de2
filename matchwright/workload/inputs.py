"""How the benchmark tables stand in for registries and imperfect sources.

The scalar expressions are plain SQL text that Spark and the checking engine
read alike, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.plans.matching import LinkColumns

LINK = LinkColumns(name="name", block="block", code="code", values=("value",))

# What is wrong with a customer's name in the source; most names are right.
DAMAGED_NAME = """CASE c_custkey % 50
    WHEN 0 THEN replace(c_name, '#0', '0#')
    WHEN 1 THEN replace(c_name, '#', '##')
    WHEN 2 THEN replace(replace(c_name, 'om', 'mo'), '#', '##')
    WHEN 3 THEN concat('XXXXX', substr(c_name, 6))
    WHEN 4 THEN concat('Legacy-', c_custkey)
    WHEN 5 THEN concat('XXXX', substr(c_name, 5))
    WHEN 6 THEN substr(c_name, 1, length(c_name) - 1)
    WHEN 7 THEN concat(substr(c_name, 1, length(c_name) - 1), 'X')
    ELSE c_name END"""
IS_LEGACY = "c_custkey % 50 = 4"

# The three coded sources: names and values as each of them has them.
S1_NAME = (
    "CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0"
    " THEN 'Legacy machinery account' ELSE c_name END"
)
S1_VALUE = "CASE WHEN c_acctbal < -900 THEN c_nationkey + 6 ELSE c_nationkey + 5 END"
S2_NAME = "c_name"
S2_VALUE = "CASE WHEN c_acctbal > 9900 THEN NULL ELSE c_nationkey + 5 END"
S3_NAME = "CASE WHEN c_mktsegment = 'FURNITURE' THEN upper(c_name) ELSE c_name END"
S3_VALUE = "CASE WHEN c_acctbal > 9000 THEN c_nationkey + 7 ELSE c_nationkey + 5 END"
CODED = {"s1": ("F", S1_NAME, S1_VALUE), "s2": ("O", S2_NAME, S2_VALUE), "s3": ("P", S3_NAME, S3_VALUE)}

# What the records of literals say: capitals, some with a sign too many.
LITERAL_NAME = "upper(CASE WHEN c_custkey % 20 = 3 THEN replace(c_name, '#', '##') ELSE c_name END)"
LITERAL_VALUE = "CASE WHEN c_acctbal > 9000 THEN c_nationkey + 7 ELSE c_nationkey + 5 END"

# A part's name written like a place name of a coded source.
SHOUTED_PART = (
    "concat(upper(replace(p_name, ' ', '-')), ' DO ', p_type, ' DA D''OESTE DE ', upper(p_brand))"
)
# Texts that a delimited file has to quote, keep or tell from null.
AWKWARD_TEXT = """CASE c_custkey % 8
    WHEN 0 THEN concat('say "', c_name, '" now')
    WHEN 1 THEN concat('a,b,', c_name)
    WHEN 2 THEN concat('line one', chr(10), c_name)
    WHEN 3 THEN concat('  ', c_name, '  ')
    WHEN 4 THEN concat('back', chr(92), c_name, chr(92))
    WHEN 5 THEN ''
    WHEN 6 THEN '"'
    ELSE c_name END"""
# Account balances as text of mixed quality.
BALANCE_TEXT = (
    "CASE WHEN c_acctbal < -500 THEN 'n/a' WHEN c_acctbal < 0 THEN ''"
    " WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_acctbal AS {text}) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, name, block, segment: every customer, spelled right."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("block"),
        F.col("c_mktsegment").alias("segment"),
    )


def _customers_with(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Customers with an order of that status, and the number of such orders."""
    orders = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == status)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).cast("int").alias("n_orders"))
    )
    return table(spark, sf_dir, "customer").join(orders, "c_custkey")


def name_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name (damaged), block, value: customers with pending orders, no key."""
    return _customers_with(spark, sf_dir, "P").select(
        F.expr(DAMAGED_NAME).alias("name"),
        F.col("c_nationkey").alias("block"),
        F.col("n_orders").alias("value"),
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, name_corr: the legacy names of customers and their real ones."""
    return table(spark, sf_dir, "customer").filter(IS_LEGACY).select(
        F.expr(DAMAGED_NAME).alias("name"), F.col("c_name").alias("name_corr")
    )


def coded_source(spark: SparkSession, sf_dir: str, tag: str) -> DataFrame:
    """code, name, block, value as source ``tag`` has them."""
    status, name, value = CODED[tag]
    return _customers_with(spark, sf_dir, status).select(
        F.col("c_custkey").alias("code"),
        F.expr(name).alias("name"),
        F.col("c_nationkey").alias("block"),
        F.expr(value).cast("int").alias("value"),
    )


def coded_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {tag: coded_source(spark, sf_dir, tag) for tag in CODED}
