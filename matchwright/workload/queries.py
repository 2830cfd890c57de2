"""One query per operator, over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.functions.columns import (
    as_integer,
    columns_containing,
    columns_matching,
    map_columns,
    move_first,
    move_last,
)
from matchwright.functions.distance import osa_distance
from matchwright.functions.names import normalize_names, title_case
from matchwright.operators.counts import (
    add_group_count,
    find_duplicates,
    multiset_difference,
    ranged_difference,
)
from matchwright.operators.filters import (
    apply_exclusion_table,
    apply_exclusions,
    drop_all_null,
    regex_lookup,
    split_by_null,
)
from matchwright.operators.joins import lookup, null_safe_join, without
from matchwright.operators.reshape import (
    pivot_longer_multi,
    smallest_values,
    sort_nulls_last,
    stack_rows,
)
from matchwright.operators.similarity import fuzzy_join
from matchwright.plans import matching, quality, reconcile
from matchwright.plans.coded import clean_coded_source
from matchwright.sources.literals import flatten_literals, flatten_long_literals
from matchwright.sources.staging import stage_path, stage_table
from matchwright.sources.tables import (
    drop_trailer,
    inline_table,
    read_delimited,
    read_landed,
    read_without_trailers,
    write_delimited,
)
from matchwright.workload import inputs
from matchwright.workload.inputs import LINK, table

Query = Callable[[SparkSession, str], DataFrame]

# Exclusion rules and corrections written by hand, as a user would keep them.
RULES = [{"value": 0, "name": "Customer#000000007"}, {"code": 11}, {"name": "Customer#000000013"}]
INLINE_CORRECTIONS = [
    ("Legacy-4", "Customer#000000004"),
    ("Legacy-54", "Customer#000000054"),
    ("legacy-104", "Customer#000000104"),
    ("Legacy-none", "Customer#000000001"),
]


# --- scans and sinks ------------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out = table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(f"CASE WHEN c_acctbal < 0 THEN NULL ELSE {inputs.S3_NAME} END").alias("c_name"),
        F.expr(inputs.AWKWARD_TEXT).alias("note"),
        "c_nationkey",
        F.expr("CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END").alias("c_acctbal"),
    )
    path = stage_path(spark, "csv")
    write_delimited(out, path)
    return read_delimited(spark, path, out.schema)


def scan_rename_headers(spark: SparkSession, sf: str) -> DataFrame:
    landed = table(spark, sf, "supplier").withColumnsRenamed(
        {"s_name": "Município", "s_acctbal": "MF (há)", "s_nationkey": "UF", "s_suppkey": "Codigo"}
    )
    path = stage_path(spark, "landed")
    landed.write.parquet(path)
    renames = {"Município": "name", "MF (há)": "value", "UF": "block", "Codigo": "code"}
    return read_landed(spark, path, renames, schema=landed.schema)


def drop_trailer_rows(spark: SparkSession, sf: str) -> DataFrame:
    return drop_trailer(table(spark, sf, "orders"), "o_orderkey", 2)


def drop_trailer_by_file(spark: SparkSession, sf: str) -> DataFrame:
    # one file a month, its last two rows taken for notes
    orders = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    path = stage_path(spark, "landed")
    dealt = orders.repartition("month").sortWithinPartitions("month", "o_orderkey")
    dealt.write.partitionBy("month").parquet(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, month string"
    return read_without_trailers(spark, path, 2, schema)


def object_literal_flatten(spark: SparkSession, sf: str) -> DataFrame:
    # {click: {"user 8": ["69"]}} with a bare outer key, one record per event
    text = F.concat(
        F.lit("{"), "event_type", F.lit(':{"user '), F.col("user_id").cast("string"),
        F.lit('":["'), F.get_json_object("props", "$.k"), F.lit('"]}}'),
    )
    records = table(spark, sf, "events").select("event_id", text.alias("record"))
    flat = flatten_literals(records, "record")
    return flat.withColumn("value", as_integer("value"))


def object_literal_long(spark: SparkSession, sf: str) -> DataFrame:
    # one record an order, its items as leaves; a part met twice repeats its key
    leaf = F.expr("""concat('"part ', l_partkey, '":["', CAST(l_quantity AS INT), '"]')""")
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag")
    inner = items.agg(F.concat_ws(",", F.collect_list(leaf)).alias("leaves"))
    entry = F.expr("concat(l_returnflag, ':{', leaves, '}')")
    records = inner.groupBy("l_orderkey").agg(
        F.concat(F.lit("{"), F.concat_ws(",", F.collect_list(entry)), F.lit("}")).alias("record")
    )
    flat = flatten_long_literals(records, "record", most=64)
    return flat.withColumn("value", as_integer("value"))


def inline_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    corrections = map_columns(
        inline_table(spark, ["name", "name_corr"], INLINE_CORRECTIONS), F.upper
    )
    source = inputs.name_source(spark, sf).withColumn("name", F.upper("name"))
    return null_safe_join(source, corrections, "name", "left")


# --- projections and expressions ------------------------------------------


def project_keep_drop(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").drop("p_retailprice", "absent_column")
    return move_last(move_first(parts, "p_brand", "p_type"), "p_partkey")


def select_by_name_pattern(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    wanted = ["l_orderkey", *columns_containing(items, "SHIP"), *columns_matching(items, "^l_.*status$")]
    return items.select(*wanted)


def derive_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.upper("o_orderpriority").alias("priority"),
        (F.col("o_orderstatus") == "F").alias("is_final"),
        (F.col("o_custkey") + 1).alias("next_customer"),
    )


def upper_all_columns(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents").select("text", "lang", "source")
    return map_columns(texts, F.upper)


def lenient_int_cast(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(inputs.BALANCE_TEXT.format(text="STRING"))
    return table(spark, sf, "customer").select("c_custkey", as_integer(text).alias("whole"))


# --- filters ----------------------------------------------------------------


def filter_compound(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    keep = ((F.col("l_quantity") > 45) & (F.col("l_returnflag") != "N")) | ~(
        (F.col("l_tax") > 0) | (F.col("l_discount") == 0)
    )
    return items.filter(keep).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def split_matched_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    joined = matching.exact_match(inputs.name_source(spark, sf), inputs.registry(spark, sf), LINK)
    matched, unmatched = split_by_null(joined, LINK.code)
    return stack_rows(
        [matched.withColumn("part", F.lit("matched")), unmatched.withColumn("part", F.lit("unmatched"))]
    )


def regex_search(spark: SparkSession, sf: str) -> DataFrame:
    found = regex_lookup(
        table(spark, sf, "part"),
        "p_name",
        "widget|^hot|g[a-z]+r$",
        isin={"p_type": ["ECONOMY", "PROMO", "LARGE"]},
        or_equals={"p_brand": "Brand#2"},
    )
    return found.select("p_partkey", "p_name", "p_type", "p_brand")


def _sparse_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.expr("CASE WHEN c_acctbal < 3000 THEN NULL ELSE c_nationkey END").alias("value"),
        F.expr("CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL ELSE c_name END").alias(
            "name"
        ),
    )


def drop_all_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return drop_all_null(_sparse_customers(spark, sf), ["value", "name"])


def exclusion_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.coded_source(spark, sf, "s3")
    kept = apply_exclusions(rows.withColumn("value", F.col("value") - 5), RULES)
    closed = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("code"), F.col("s_nationkey").alias("block")
    )
    return apply_exclusion_table(kept, closed, ["code", "block"])


# --- joins --------------------------------------------------------------------


def exact_match_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return matching.exact_match(inputs.name_source(spark, sf), inputs.registry(spark, sf), LINK)


def exact_match_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' line names against parts, whose (name, type) keys repeat."""
    cols = matching.LinkColumns("name", "block", "code", ("value",))
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("code"), F.col("p_name").alias("name"), F.col("p_type").alias("block")
    )
    wanted = table(spark, sf, "part").groupBy(
        F.col("p_name").alias("name"), F.col("p_type").alias("block")
    ).agg(F.max("p_size").alias("value"))
    return matching.exact_match_fanout(wanted, parts, cols)


def left_join_renamed_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name")
    return null_safe_join(orders, customers, [("o_custkey", "c_custkey")], "left")


def dimension_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return lookup(suppliers, nations, "n_nationkey").select("s_suppkey", "n_nationkey", "n_name", "n_regionkey")


def registry_pool_anti(spark: SparkSession, sf: str) -> DataFrame:
    joined = matching.exact_match(inputs.name_source(spark, sf), inputs.registry(spark, sf), LINK)
    matched, _ = split_by_null(joined, LINK.code)
    return without(inputs.registry(spark, sf), matched, LINK.code)


def unmatched_anti_by_name(spark: SparkSession, sf: str) -> DataFrame:
    official = inputs.registry(spark, sf).withColumnRenamed("name", "official_name")
    return without(inputs.name_source(spark, sf), official, [("name", "official_name")])


def multi_source_inner(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.multi_source_inner(inputs.coded_sources(spark, sf), "code", ["value"])


def multi_source_full(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.multi_source_full(inputs.coded_sources(spark, sf), "code", ["value", "name"])


def _fuzzy(k: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        pool = inputs.registry(spark, sf).drop("segment")
        return fuzzy_join(inputs.name_source(spark, sf), pool, k)

    return query


def fuzzy_join_mixed_block(spark: SparkSession, sf: str) -> DataFrame:
    """As ``fuzzy_join_k1``, the registry's blocks in a wider type."""
    pool = inputs.registry(spark, sf).drop("segment")
    pool = pool.withColumn("block", F.col("block").cast("bigint"))
    source = inputs.name_source(spark, sf)
    return fuzzy_join(source.withColumn("block", F.col("block").cast("int")), pool, 1)


def osa_distance_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        osa_distance(F.expr(inputs.DAMAGED_NAME), F.col("c_name")).alias("distance"),
    )


# --- counting, duplicates, order, sets ------------------------------------------


def group_count(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    return add_group_count(items, ["l_suppkey", "l_returnflag"])


def duplicate_keys_single(spark: SparkSession, sf: str) -> DataFrame:
    return find_duplicates(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name")


def duplicate_keys_composite(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return find_duplicates(items, ["l_orderkey", "l_linenumber"])


def distinct_projection(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


def sort_with_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    return sort_nulls_last(_sparse_customers(spark, sf), "name", "value", "c_custkey")


def smallest_values_topk(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return smallest_values(orders, ["o_totalprice", "o_orderkey"], 20)


def multiset_surplus(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    shipped = items.select(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("flag"))
    parts = items.select(F.col("l_partkey").alias("key"), F.col("l_returnflag").alias("flag"))
    return multiset_difference(shipped, parts)


def multiset_surplus_ranged(spark: SparkSession, sf: str) -> DataFrame:
    # a few orders of a copy are changed, one is doubled
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = orders.withColumn(
        "o_orderstatus", F.expr("CASE WHEN o_orderkey % 1013 <> 0 THEN o_orderstatus END")
    )
    return ranged_difference(orders, changed.unionByName(orders.where("o_orderkey = 7")))


def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("block"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("block"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("supplier")
    )
    return stack_rows([customers, suppliers])


def union_strict(spark: SparkSession, sf: str) -> DataFrame:
    sources = inputs.coded_sources(spark, sf)
    return stack_rows([sources["s1"].select("code", "value"), sources["s2"].select("value", "code")], strict=True)


def pivot_longer(spark: SparkSession, sf: str) -> DataFrame:
    wide = reconcile.multi_source_full(inputs.coded_sources(spark, sf), "code", ["value", "name"])
    return pivot_longer_multi(wide, "code", "([a-z]+)_(s[1-3])")


# --- names --------------------------------------------------------------------


def title_case_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", title_case(F.expr(inputs.SHOUTED_PART)).alias("name"))


def normalized_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", normalize_names(F.expr(inputs.SHOUTED_PART)).alias("name")
    )


def coded_source_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").cast("double").alias("Codigo"),
        F.col("p_type").alias("UF"),
        F.expr(inputs.SHOUTED_PART).alias("Municipio"),
        F.col("p_size").alias("MF (há)"),
    )
    return clean_coded_source(
        raw, {"Codigo": "code", "UF": "block", "Municipio": "name", "MF (há)": "value"}, "name", "code"
    )


# --- matching cascade ------------------------------------------------------------


def _cascade(spark: SparkSession, sf: str) -> matching.Cascade:
    return matching.match_cascade(inputs.name_source(spark, sf), inputs.registry(spark, sf), LINK)


def _manual(spark: SparkSession, sf: str, cascade: matching.Cascade) -> DataFrame:
    return matching.apply_crosswalk(
        inputs.crosswalk(spark, sf), cascade.unmatched, inputs.registry(spark, sf), LINK
    )


def _first_stage(spark: SparkSession, sf: str) -> DataFrame:
    source, official = inputs.name_source(spark, sf), inputs.registry(spark, sf)
    matched, unmatched = split_by_null(matching.exact_match(source, official, LINK), LINK.code)
    return matching.fuzzy_stage(unmatched, official, matched, LINK, k=1)


def fuzzy_clean(spark: SparkSession, sf: str) -> DataFrame:
    return matching.fuzzy_clean(_first_stage(spark, sf), LINK)


def ambiguous_match_check(spark: SparkSession, sf: str) -> DataFrame:
    return matching.has_ambiguous(_first_stage(spark, sf))


def match_cascade(spark: SparkSession, sf: str) -> DataFrame:
    cascade = _cascade(spark, sf)
    stage_rows = [
        rows.withColumn("stage", F.lit(f"k{k}")).drop("n_matches") for k, rows in cascade.stages.items()
    ]
    return stack_rows(
        [
            cascade.exact.withColumn("stage", F.lit("exact")),
            *stage_rows,
            cascade.unmatched.withColumn("stage", F.lit("unmatched")),
        ]
    )


def candidate_report(spark: SparkSession, sf: str) -> DataFrame:
    cascade = _cascade(spark, sf)
    return matching.candidate_report(
        cascade.unmatched, inputs.registry(spark, sf), cascade.consumed, LINK
    )


def crosswalk_match(spark: SparkSession, sf: str) -> DataFrame:
    return _manual(spark, sf, _cascade(spark, sf))


def match_provenance(spark: SparkSession, sf: str) -> DataFrame:
    cascade = _cascade(spark, sf)
    return matching.provenance(
        cascade.exact, list(cascade.stages.values()), _manual(spark, sf, cascade), LINK
    )


def match_summary_counts(spark: SparkSession, sf: str) -> DataFrame:
    return matching.match_summary(match_provenance(spark, sf), LINK)


def coalesce_name(spark: SparkSession, sf: str) -> DataFrame:
    cascade = _cascade(spark, sf)
    return matching.assemble_matches(
        cascade.exact, list(cascade.stages.values()), _manual(spark, sf, cascade), LINK
    )


# --- reconciliation ----------------------------------------------------------------


def rows_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return quality.source_profile(inputs.coded_sources(spark, sf), "value").select("source", "n_rows")


def nulls_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return quality.source_profile(inputs.coded_sources(spark, sf), "value").select("source", "n_nulls")


def reconcile_agreed(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.agreed_rows(inputs.coded_sources(spark, sf), "code", "value", "s2")


def reconcile_agreed_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Agreed rows of sources that repeat codes and lack some, counted."""
    code = F.expr("CASE WHEN code % 50 <> 0 THEN code DIV 2 END")
    sources = {
        tag: rows.withColumn("code", code) for tag, rows in inputs.coded_sources(spark, sf).items()
    }
    return reconcile.agreed_rows(sources, "code", "value", "s2", counted="n")


def reconcile_value_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.value_conflicts(inputs.coded_sources(spark, sf), "code", "value")


def reconcile_gaps_wide(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.gap_rows_wide(inputs.coded_sources(spark, sf), "code", ["value", "name"])


def reconcile_gaps_long(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.gap_rows_long(inputs.coded_sources(spark, sf), "code", ["value", "name"])


def _conflict(by: str, over: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        gaps = stage_table(reconcile_gaps_long(spark, sf), "gaps")
        return reconcile.conflict_report(gaps, by, over)

    return query


def reconcile_final(spark: SparkSession, sf: str) -> DataFrame:
    gaps = reconcile.corrected_gaps(
        reconcile_gaps_long(spark, sf), RULES[1:], "code", ["name", "value"]
    )
    dimension = inputs.registry(spark, sf).select("code", "name", "block")
    return reconcile.merge_reconciled(reconcile_agreed(spark, sf), gaps, dimension, "code", "value")


def _from_names(spark: SparkSession, sf: str) -> DataFrame:
    """The source without codes: cascade, crosswalk, registry's names."""
    return coalesce_name(spark, sf).filter(F.col("code").isNotNull())


def _from_literals(spark: SparkSession, sf: str) -> DataFrame:
    """Names in capitals out of literals, matched and respelled."""
    records = table(spark, sf, "customer").select(
        F.concat(
            F.lit('{"'), F.col("c_nationkey").cast("string"), F.lit('":{"'),
            F.expr(inputs.LITERAL_NAME), F.lit('":["'),
            F.expr(inputs.LITERAL_VALUE).cast("string"), F.lit('"]}}'),
        ).alias("record")
    )
    rows = flatten_literals(records, "record")
    rows = rows.withColumn("value", as_integer("value")).withColumn("block", as_integer("block"))
    official = inputs.registry(spark, sf)
    capitals = official.withColumn("name", F.upper("name"))
    cascade = matching.match_cascade(rows, capitals, LINK, dists=(1,))
    settled = matching.assemble_matches(
        cascade.exact, list(cascade.stages.values()), cols=LINK, respell_from=official
    )
    return settled.filter(F.col("code").isNotNull())


def whole_job(spark: SparkSession, sf: str) -> DataFrame:
    # a source of names, a coded one and one of literals, from scan to merged rows
    columns = ["code", "name", "block", "value"]
    sources = {
        "s1": stage_table(_from_names(spark, sf).select(columns), "cleaned"),
        "s2": inputs.coded_source(spark, sf, "s2").select(columns),
        "s3": stage_table(_from_literals(spark, sf).select(columns), "cleaned"),
    }
    gaps = reconcile.corrected_gaps(
        reconcile.gap_rows_long(sources, "code", ["value", "name"]), RULES[1:], "code", ["name", "value"]
    )
    agreed = reconcile.agreed_rows(sources, "code", "value", preferred="s2")
    dimension = inputs.registry(spark, sf).select("code", "name", "block")
    return reconcile.merge_reconciled(agreed, gaps, dimension, "code", "value")


def any_null_check(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        quality.any_null(rows).withColumn("source", F.lit(tag))
        for tag, rows in inputs.coded_sources(spark, sf).items()
    ]
    return stack_rows(checks, strict=True)


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_checks(
        inputs.coded_source(spark, sf, "s2").withColumn("value", F.col("value") - 5),
        "code",
        "value",
        duplicate_keys=[["code"], ["name", "block"], ["block"]],
        input_rows=inputs.coded_source(spark, sf, "s1"),
        coverage_on=["code"],
    )


def queries() -> dict[str, Query]:
    return {
        "csv_roundtrip": csv_roundtrip,
        "scan_rename_headers": scan_rename_headers,
        "drop_trailer_rows": drop_trailer_rows,
        "drop_trailer_by_file": drop_trailer_by_file,
        "object_literal_flatten": object_literal_flatten,
        "object_literal_long": object_literal_long,
        "inline_crosswalk": inline_crosswalk,
        "project_keep_drop": project_keep_drop,
        "select_by_name_pattern": select_by_name_pattern,
        "derive_columns": derive_columns,
        "upper_all_columns": upper_all_columns,
        "lenient_int_cast": lenient_int_cast,
        "filter_compound": filter_compound,
        "split_matched_unmatched": split_matched_unmatched,
        "regex_lookup": regex_search,
        "drop_all_null": drop_all_null_rows,
        "exclusion_rules": exclusion_rules,
        "exact_match_left_join": exact_match_left_join,
        "exact_match_fanout": exact_match_fanout,
        "left_join_renamed_key": left_join_renamed_key,
        "dimension_lookup": dimension_lookup,
        "registry_pool_anti": registry_pool_anti,
        "unmatched_anti_by_name": unmatched_anti_by_name,
        "multi_source_inner": multi_source_inner,
        "multi_source_full": multi_source_full,
        "fuzzy_join_k1": _fuzzy(1),
        "fuzzy_join_k2": _fuzzy(2),
        "fuzzy_join_k5": _fuzzy(5),
        "fuzzy_join_mixed_block": fuzzy_join_mixed_block,
        "osa_distance_pairs": osa_distance_pairs,
        "add_group_count": group_count,
        "duplicate_keys_single": duplicate_keys_single,
        "duplicate_keys_composite": duplicate_keys_composite,
        "distinct_projection": distinct_projection,
        "sort_nulls_last": sort_with_nulls_last,
        "smallest_values_topk": smallest_values_topk,
        "multiset_difference": multiset_surplus,
        "multiset_difference_ranged": multiset_surplus_ranged,
        "union_missing_columns": union_missing_columns,
        "union_strict": union_strict,
        "pivot_longer_multi": pivot_longer,
        "title_case_names": title_case_names,
        "normalize_names": normalized_names,
        "clean_coded_source": coded_source_cleaned,
        "fuzzy_stage_k1": _first_stage,
        "fuzzy_clean": fuzzy_clean,
        "ambiguous_match_check": ambiguous_match_check,
        "match_cascade": match_cascade,
        "candidate_report": candidate_report,
        "crosswalk_match": crosswalk_match,
        "match_provenance": match_provenance,
        "match_summary_counts": match_summary_counts,
        "coalesce_name": coalesce_name,
        "rows_per_source": rows_per_source,
        "nulls_per_source": nulls_per_source,
        "reconcile_agreed": reconcile_agreed,
        "reconcile_agreed_repeated": reconcile_agreed_repeated,
        "reconcile_value_conflicts": reconcile_value_conflicts,
        "reconcile_gaps_wide": reconcile_gaps_wide,
        "reconcile_gaps_long": reconcile_gaps_long,
        "conflict_values": _conflict("code", "value"),
        "conflict_names": _conflict("code", "name"),
        "conflict_codes": _conflict("name", "code"),
        "reconcile_final": reconcile_final,
        "whole_job": whole_job,
        "any_null_check": any_null_check,
        "quality_report": quality_report,
    }
