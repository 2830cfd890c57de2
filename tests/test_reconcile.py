import pytest
from pyspark.sql import functions as F

from matchwright.operators.counts import multisets_equal
from matchwright.plans import quality, reconcile


@pytest.fixture
def sources(spark):
    schema = "code int, value int, name string"
    return {
        "s1": spark.createDataFrame(
            [(1, 10, "a"), (1, 11, "a"), (2, 20, "b"), (4, 40, "d"), (None, 5, "n"), (6, None, None), (7, 1, "g")], schema
        ),
        "s2": spark.createDataFrame(
            [(1, 10, "a"), (1, 10, "a"), (1, None, "a"), (2, 20, "B"), (4, 41, "d"), (4, 42, "D"), (None, 6, "n")], schema
        ),
        "s3": spark.createDataFrame(
            [(1, 10, "a"), (2, 21, "b"), (5, 50, "e"), (5, 51, "e"), (None, 5, "N"), (7, 1, "g"), (7, 2, "g")], schema
        ),
    }


def test_agreed_rows_come_as_often_as_the_joins_make_them(sources, rows):
    inner = reconcile.multi_source_inner(sources, "code", ["value"])
    want = inner.selectExpr("code", "value_s2 AS value")
    got = reconcile.agreed_rows(sources, "code", "value", "s2")
    assert multisets_equal(got, want)
    # code 1 is in 2 x 3 x 1 combinations; the null keys of all three meet
    assert rows(got).count((1, 10)) == 4 and (None, 6) in rows(got)


def test_value_conflicts_are_null_blind_and_whole(sources):
    inner = reconcile.multi_source_inner(sources, "code", ["value"])
    want = inner.filter("value_s1 != value_s2 OR value_s1 != value_s3")
    assert multisets_equal(reconcile.value_conflicts(sources, "code", "value"), want)


def test_gaps_wide_and_long_equal_the_full_join(sources, rows):
    full = reconcile.multi_source_full(sources, "code", ["value", "name"])
    wide = full.filter("code IN (4, 5, 6, 7)")
    assert multisets_equal(reconcile.gap_rows_wide(sources, "code", ["value", "name"]), wide)
    long = reconcile.gaps_to_long(wide, "code", ["value", "name"], ["s1", "s2", "s3"])
    got = reconcile.gap_rows_long(sources, "code", ["value", "name"])
    assert multisets_equal(got, long)
    assert rows(got.filter("code = 6")) == []


def test_conflict_reports(sources, rows):
    gaps = reconcile.gap_rows_long(sources, "code", ["value", "name"])
    assert rows(reconcile.conflict_report(gaps, "code", "name")) == [(4, "D", 2), (4, "d", 2)]
    assert rows(reconcile.conflict_report(gaps, "code", "value"), "code", "value") == [
        (4, 40), (4, 41), (4, 42), (5, 50), (5, 51), (7, 1), (7, 2),
    ]


def test_merge(spark, sources, rows):
    gaps = reconcile.corrected_gaps(
        reconcile.gap_rows_long(sources, "code", ["value", "name"]),
        [{"code": 5}, {"name": "D"}],
        "code",
        ["name", "value"],
    )
    assert rows(gaps) == [(4, "d", 40), (4, "d", 41), (7, "g", 1), (7, "g", 2)]
    dimension = spark.createDataFrame([(2, "Two", "x"), (7, "Seven", "y")], "code int, name string, block string")
    agreed = reconcile.agreed_rows(sources, "code", "value", "s2").filter("code = 2")
    merged = reconcile.merge_reconciled(agreed, gaps, dimension, "code", "value")
    assert merged.columns == ["code", "name", "block", "value"]
    assert rows(merged) == [
        (2, "Two", "x", 20), (4, None, None, 40), (4, None, None, 41), (7, "Seven", "y", 1), (7, "Seven", "y", 2),
    ]


def test_profiles_and_checks(spark, sources, rows):
    assert rows(quality.source_profile(sources, "value")) == [("s1", 7, 1), ("s2", 7, 1), ("s3", 7, 0)]
    assert rows(quality.any_null(sources["s3"], ["value"])) == [(False,)]
    assert rows(quality.any_null(sources["s3"])) == [(True,)]
    empty = sources["s3"].limit(0)
    assert rows(quality.any_null(empty)) == [(False,)]
    df = spark.createDataFrame(
        [(1, "a", "x", 0), (1, "a", "x", 4), (2, None, "x", None), (None, "c", "y", 1)],
        "code int, name string, block string, value int",
    )
    report = quality.quality_checks(
        df, "code", "value", [["code"], ["name", "block"]], df.selectExpr("code + 1 AS code"), ["code"]
    )
    assert {r["check"]: (r["n_bad"], r["sample"]) for r in report.collect()} == {
        "null_key": (1, None),
        "null_value": (1, "2"),
        "zero_value": (1, "1"),
        "any_null": (2, "2"),
        "duplicate_code": (2, "1"),
        "duplicate_name_block": (2, "a|x"),
        "not_covered": (1, "3"),
    }


def test_very_many_null_keys_are_counted(spark):
    rows = spark.range(60_000).selectExpr("CAST(NULL AS BIGINT) AS code", "1 AS value")
    sources = {t: rows for t in ("a", "b", "c")}
    got = reconcile.agreed_rows(sources, "code", "value", "a", counted="n")
    assert got.agg({"n": "sum"}).first()[0] == 60_000**3


def test_repeated_keys_are_spread_in_blocks(spark):
    one = spark.sql("SELECT 1 AS code, 5 AS value")
    many = spark.range(400).selectExpr("1 AS code", "5 AS value")
    assert reconcile.agreed_rows({"a": one, "b": many, "c": many}, "code", "value", "a").count() == 160_000


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_full_fold_of_hot_and_null_keys_is_dealt_out(spark):
    schema = "code int, value int"
    a = spark.createDataFrame([(1, i) for i in range(90)] + [(i, i) for i in range(2, 12)], schema)
    b = spark.createDataFrame([(1, 7), (1, 7), (3, 1), (50, 1)] + [(None, i) for i in range(40)], schema)
    c = spark.createDataFrame([(1, 8), (None, 1), (None, 1), (60, 2)], schema)
    fold = reconcile.multi_source_full({"a": a, "b": b, "c": c}, "code", ["value"], split_above=10)
    plain = (
        a.withColumnRenamed("value", "value_a").alias("a")
        .join(b.withColumnRenamed("value", "value_b").alias("b"), a.code.eqNullSafe(b.code), "full")
        .selectExpr("coalesce(a.code, b.code) AS code", "value_a", "value_b")
    )
    plain = plain.join(
        c.selectExpr("code AS code_c", "value AS value_c"), plain.code.eqNullSafe(F.col("code_c")), "full"
    ).selectExpr("coalesce(code, code_c) AS code", "value_a", "value_b", "value_c")
    assert fold.columns == ["code", "value_a", "value_b", "value_c"]
    assert multisets_equal(fold, plain)
    assert "FullOuter" not in _plan(fold)
    # the hot key's rows are many keys to the join
    dealt = reconcile._dealt_out(
        a.withColumnRenamed("value", "value_a"),
        spark.sql("SELECT 1 AS code, 9L AS __salts, 1 AS __largest"), "code", 1,
    )
    sizes = [r["count"] for r in dealt.where("code = 1").groupBy("__salt").count().collect()]
    assert sum(sizes) == 90 and len(sizes) >= 5 and max(sizes) <= 30


def test_full_fold_of_one_source_and_of_empty_ones(spark):
    one = spark.createDataFrame([(1, 2), (None, 3)], "code int, value int")
    fold = reconcile.multi_source_full({"a": one}, "code", ["value"])
    assert multisets_equal(fold, one.selectExpr("code", "value AS value_a"))
    fold = reconcile.multi_source_full({"a": one.limit(0), "b": one}, "code", ["value"])
    assert multisets_equal(fold, one.selectExpr("code", "CAST(NULL AS INT) AS value_a", "value AS value_b"))


def test_quality_checks_scan_once(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.sql("SELECT id % 7 AS code, id % 3 AS value, CAST(id % 5 AS STRING) AS name, 'x' AS n FROM range(50)").write.parquet(path)
    df = spark.read.parquet(path)
    report = quality.quality_checks(df, "code", "value", [["code"], ["name", "n"], ["code", "value", "name"]])
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r["check"]: (r["n_bad"], r["sample"]) for r in report.collect()}
    assert got["zero_value"] == (17, "0") and got["duplicate_code"] == (50, "0")
    assert got["duplicate_name_n"] == (50, "0|x") and got["duplicate_code_value_name"] == (0, None)


def test_coverage_of_other_names_types_and_nulls(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "code bigint, value int, name string")
    asked = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id int")
    report = quality.quality_checks(df, "code", "value", [["name"]], asked, [("id", "code")])
    got = {r["check"]: (r["n_bad"], r["sample"]) for r in report.collect()}
    assert got["not_covered"] == (3, "3") and got["null_key"] == (0, None) and got["duplicate_name"] == (0, None)
    empty = quality.quality_checks(df.limit(0), "code", "value", [["name"]], asked, [("id", "code")])
    assert {r["check"]: r["n_bad"] for r in empty.collect()}["not_covered"] == 4
