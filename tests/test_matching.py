import random
import warnings

import pytest
from pyspark.sql import functions as F

from matchwright.plans import matching
from matchwright.workload import inputs
from matchwright.workload.inputs import LINK


@pytest.fixture
def src(spark):
    return lambda data: spark.createDataFrame(data, "name string, block string, value int")


@pytest.fixture
def reg(spark):
    return lambda data: spark.createDataFrame(data, "code int, name string, block string")


def test_exact_match_matches_null_with_null(src, reg, rows):
    out = matching.exact_match(src([(None, "a", 1), ("x", "a", 2)]), reg([(7, None, "a"), (8, "x", "b")]))
    assert rows(out, "name", "code") == [(None, 7), ("x", None)]


def test_fanout_lists_rows_with_several_registry_rows(src, reg, rows):
    registry = reg([(1, "x", "a"), (2, "x", "a"), (3, "y", "a")])
    out = matching.exact_match_fanout(src([("x", "a", 5), ("y", "a", 6)]), registry)
    assert rows(out, "name", "code", "n") == [("x", 1, 2), ("x", 2, 2)]


SAME_NAME = [("abcd", "a", 1), ("abcd", "b", 2)]


@pytest.mark.parametrize("keys,left", [(None, [("abcd", "b", 2)]), (["name"], [])])
def test_residual_by_name_also_drops_the_other_block(src, reg, rows, keys, left):
    registry = reg([(1, "abce", "a"), (2, "zzzzzz", "b")])
    cascade = matching.match_cascade(src(SAME_NAME), registry, dists=(1,), residual_keys=keys)
    assert rows(cascade.unmatched) == left
    assert rows(cascade.stages[1], "name", "block", "code", "n_matches") == [("abcd", "a", 1, 1)]


def test_two_inputs_may_take_one_code_in_a_stage_but_not_in_the_next(src, reg, rows):
    source = src([("abcX", "a", 1), ("abcY", "a", 2), ("abcXYd", "a", 3)])
    cascade = matching.match_cascade(source, reg([(1, "abcd", "a")]), dists=(1, 2))
    assert rows(cascade.stages[1], "name", "code") == [("abcX", 1), ("abcY", 1)]
    # within two edits of code 1, which the first stage has used
    assert rows(cascade.stages[2]) == []
    assert rows(cascade.unmatched, "name") == [("abcXYd",)]


def test_ambiguous_hits_are_kept_warned_about_or_dropped(src, reg, rows):
    registry = reg([(1, "abcd", "a"), (2, "abce", "a"), (3, "pqrs", "a")])
    source = src([("abcX", "a", 1), ("pqrX", "a", 2)])
    stage = matching.fuzzy_stage(source, registry, k=1)
    assert rows(stage, "name", "code", "n_matches") == [("abcX", 1, 2), ("abcX", 2, 2), ("pqrX", 3, 1)]
    with pytest.warns(UserWarning, match="several"):
        assert matching.fuzzy_clean(stage, warn=True).count() == 3
    assert rows(matching.fuzzy_clean(stage, ambiguous="drop"), "name") == [("pqrX",)]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        matching.fuzzy_clean(stage.filter("n_matches = 1"), warn=True)
    cascade = matching.match_cascade(source, registry, dists=(1,), ambiguous="drop")
    assert rows(cascade.unmatched, "name") == [("abcX",)]


def test_repeated_source_rows_count_as_matches(src, reg, rows):
    stage = matching.fuzzy_stage(src([("abcX", "a", 1), ("abcX", "a", 2)]), reg([(1, "abcd", "a")]))
    assert rows(stage, "value", "n_matches") == [(1, 2), (2, 2)]


def test_name_standing_on_a_taken_and_a_free_row(src, reg, rows):
    registry = reg([(1, "abcd", "a"), (2, "abcd", "a")])
    consumed = registry.filter("code = 1").select("code")
    assert rows(matching.fuzzy_stage(src([("abcX", "a", 1)]), registry, consumed), "code") == [(2,)]


def test_crosswalk_keeps_unhit_corrections(spark, src, reg, rows):
    corrections = spark.createDataFrame(
        [("old", "new"), ("lost", "new"), ("odd", "nowhere")], "name string, name_corr string"
    )
    unmatched = src([("old", "a", 1), ("old", "b", 2), ("odd", "a", 3), ("rest", "a", 4)])
    registry = reg([(10, "new", "a"), (11, "other", "b")])
    out = matching.apply_crosswalk(corrections, unmatched, registry)
    assert rows(out, "name", "name_corr", "block", "value", "code") == [
        ("lost", "new", None, None, None),
        ("odd", "nowhere", "a", 3, None),
        ("old", "new", "a", 1, 10),
        ("old", "new", "b", 2, None),
    ]
    assert matching.apply_crosswalk(corrections, unmatched, registry, drop_unhit=True).count() == 3


def test_candidate_report_names_only_unique_candidates(src, reg, rows):
    registry = reg([(1, "abcdefgh", "a"), (2, "mnopqr", "a"), (3, "mnopqs", "a")])
    unmatched = src([("XXXXXfgh", "a", 1), ("mnopXX", "a", 2), ("?", "b", 3)])
    report = matching.candidate_report(unmatched, registry, None)
    assert report.columns == ["name", "block", "name_candidate", "code_candidate"]
    assert rows(report) == [("?", "b", None, None), ("XXXXXfgh", "a", "abcdefgh", 1), ("mnopXX", "a", None, None)]


def test_assembled_names_and_registry_spelling(src, reg, rows):
    registry = reg([(1, "Abcd", "a"), (2, "Efgh", "a")])
    capitals = registry.withColumn("name", F.upper("name"))
    cascade = matching.match_cascade(src([("ABCD", "a", 1), ("EFGX", "a", 2)]), capitals)
    stages = list(cascade.stages.values())
    plain = matching.assemble_matches(cascade.exact, stages)
    assert plain.columns == ["name", "name_data_orig", "code", "block", "value"]
    assert rows(plain, "name", "name_data_orig", "code") == [("ABCD", "ABCD", 1), ("EFGH", "EFGX", 2)]
    spelled = matching.assemble_matches(cascade.exact, stages, respell_from=registry)
    assert rows(spelled, "name", "name_data_orig") == [("Abcd", "ABCD"), ("Efgh", "EFGX")]
    summary = matching.match_summary(matching.provenance(cascade.exact, stages))
    assert rows(summary) == [(False, False, 1), (True, True, 1)]


def test_cascade_totals_on_damaged_customers(spark):
    """Totals known beforehand from a brute-force distance."""
    customers = inputs.table(spark, "/root/testdata/sf0.01", "customer")
    source = customers.filter("c_custkey % 10 <> 9").select(
        F.expr(inputs.DAMAGED_NAME).alias("name"),
        F.col("c_nationkey").alias("block"),
        F.expr("CAST(c_custkey % 28 AS INT)").alias("value"),
    )
    registry = inputs.registry(spark, "/root/testdata/sf0.01")
    cascade = matching.match_cascade(source, registry, LINK)
    assert cascade.exact.count() == 1110
    assert cascade.stages[1].count() == 144
    assert cascade.stages[1].filter("n_matches > 1").select("name").distinct().count() == 18
    assert cascade.stages[2].count() == 28
    assert cascade.unmatched.count() == 92
    far = matching.fuzzy_stage(cascade.unmatched, registry, cascade.consumed, LINK, k=5)
    assert far.count() == 79
    names = far.groupBy("name", "block").agg(F.max("n_matches").alias("n"))
    assert names.filter("n > 1").count() == 6
    assert 92 - names.count() == 35
    # every input name ends in exactly one place; no code is used in two stages
    hit = cascade.matched().select("name", "block").distinct()
    assert hit.join(cascade.unmatched, ["name", "block"]).count() == 0
    assert hit.count() + cascade.unmatched.count() == 1350
    assert cascade.stages[1].join(cascade.stages[2], "code").count() == 0
    assert cascade.exact.join(cascade.stages[1], "code").count() == 0


def test_report_in_rings_equals_the_whole_search(spark, rows):
    rnd = random.Random(11)
    pool = sorted({"".join(rnd.choices("abcd", k=rnd.randint(4, 12))) for _ in range(60)})
    names = sorted({"".join(rnd.choices("abcd", k=rnd.randint(4, 14))) for _ in range(60)})
    names += [p + "wxyz" for p in pool[:10]] + [names[0], None]
    src = spark.createDataFrame([(n, i % 2, i) for i, n in enumerate(names)], "name string, block int, value int")
    src = src.union(spark.createDataFrame([("alone", None, 1)], src.schema))
    registry = spark.createDataFrame([(i, n, i % 2) for i, n in enumerate(pool)], "code int, name string, block int")
    cols = matching.LinkColumns(name="name", block="block", code="code", values=("value",))
    whole = matching.fuzzy_stage(src, registry, None, cols, 5).filter("n_matches = 1")
    want = {(r["name"], r["block"]): r["code"] for r in whole.collect()}
    got = matching.candidate_report(src, registry, None, cols, 5).collect()
    assert len(got) == src.count() and want
    for r in got:
        assert r.code_candidate == want.get((r["name"], r["block"]))
