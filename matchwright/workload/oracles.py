"""The same queries as SQL for the checking engine, written independently of
how the Spark operators work (brute-force pairs, window counts, full joins)."""

from __future__ import annotations

from matchwright.workload import inputs
from matchwright.workload.queries import INLINE_CORRECTIONS


def _osa(a: str, b: str) -> str:
    """Optimal string alignment: fold over rows, each row a fold over columns."""
    cell = (
        f"least(st.p1[j+1] + 1, r[j] + 1,"
        f" st.p1[j] + CASE WHEN substr({a}, i, 1) = substr({b}, j, 1) THEN 0 ELSE 1 END,"
        f" CASE WHEN i > 1 AND j > 1 AND substr({a}, i, 1) = substr({b}, j-1, 1)"
        f" AND substr({a}, i-1, 1) = substr({b}, j, 1) THEN st.p2[j-1] + 1 ELSE 99999 END)"
    )
    first = f"CAST(range(0, length({b}) + 1) AS BIGINT[])"
    row = (
        f"list_reduce(CAST(range(1, length({b}) + 1) AS BIGINT[]),"
        f" lambda r, j: list_append(r, {cell}), [i])"
    )
    return (
        f"list_reduce(CAST(range(1, length({a}) + 1) AS BIGINT[]),"
        f" lambda st, i: {{'p2': st.p1, 'p1': {row}}},"
        f" {{'p2': {first}, 'p1': {first}}}).p1[length({b}) + 1]"
    )


def _near(left: str, right: str, k: int) -> str:
    """Distinct name pairs of two relations within k, block by block.

    The engine's unrestricted distance never exceeds the wanted one and the
    names are ASCII, so it only thins out the pairs; the exact one decides.
    """
    return f"""(SELECT block, left_name, right_name, CAST({_osa('left_name', 'right_name')} AS INTEGER) AS distance
      FROM (SELECT DISTINCT l.block, l.name AS left_name, r.name AS right_name
            FROM {left} l JOIN {right} r ON l.block = r.block
            WHERE damerau_levenshtein(l.name, r.name) <= {k})
      WHERE {_osa('left_name', 'right_name')} <= {k})"""


_INPUTS = f"""
registry AS (SELECT c_custkey AS code, c_name AS name, c_nationkey AS block, c_mktsegment AS segment FROM customer),
src AS (SELECT {inputs.DAMAGED_NAME} AS name, c_nationkey AS block, n AS value
        FROM customer JOIN (SELECT o_custkey, CAST(count(*) AS INTEGER) AS n FROM orders
                            WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON o_custkey = c_custkey),
crosswalk AS (SELECT {inputs.DAMAGED_NAME} AS name, c_name AS name_corr FROM customer WHERE {inputs.IS_LEGACY})"""

_CODED = ",\n".join(
    f"""{tag} AS (SELECT c_custkey AS code, {name} AS name, c_nationkey AS block, CAST({value} AS INTEGER) AS value
        FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = '{status}'))"""
    for tag, (status, name, value) in inputs.CODED.items()
)

_EXACT = _INPUTS + """,
exact AS (SELECT s.name, s.block, s.value, r.code FROM src s
          LEFT JOIN registry r ON s.name IS NOT DISTINCT FROM r.name AND s.block IS NOT DISTINCT FROM r.block),
matched0 AS (SELECT * FROM exact WHERE code IS NOT NULL),
un0 AS (SELECT name, block, value FROM exact WHERE code IS NULL),
pool0 AS (SELECT * FROM registry r WHERE NOT EXISTS (SELECT 1 FROM matched0 m WHERE m.code = r.code))"""


def _stage(n: int, k: int, rest: str, pool: str) -> str:
    return f"""
near{n} AS MATERIALIZED {_near(rest, pool, k)},
stage{n} AS (SELECT u.name, u.block, u.value, p.code, h.right_name AS name_match, h.distance,
                    count(*) OVER (PARTITION BY u.name, u.block) AS n_matches
             FROM {rest} u JOIN near{n} h ON h.block = u.block AND h.left_name = u.name
             JOIN {pool} p ON p.block = h.block AND p.name = h.right_name)"""


_STAGE1 = _EXACT + "," + _stage(1, 1, "un0", "pool0")
_CASCADE = (
    _STAGE1
    + """,
un1 AS (SELECT * FROM un0 u WHERE NOT EXISTS (SELECT 1 FROM stage1 h WHERE h.name = u.name AND h.block = u.block)),
pool1 AS (SELECT * FROM pool0 r WHERE NOT EXISTS (SELECT 1 FROM stage1 h WHERE h.code = r.code)),"""
    + _stage(2, 2, "un1", "pool1")
    + """,
un2 AS (SELECT * FROM un1 u WHERE NOT EXISTS (SELECT 1 FROM stage2 h WHERE h.name = u.name AND h.block = u.block)),
pool2 AS (SELECT * FROM pool1 r WHERE NOT EXISTS (SELECT 1 FROM stage2 h WHERE h.code = r.code))"""
)
_MANUAL = (
    _CASCADE
    + """,
manual AS (SELECT c.name, c.name_corr, u.block, u.value, r.code FROM crosswalk c
           LEFT JOIN un2 u ON u.name = c.name
           LEFT JOIN registry r ON r.name = c.name_corr AND r.block IS NOT DISTINCT FROM u.block)"""
)
_PROVENANCE = (
    _MANUAL
    + """,
prov AS (SELECT name, block, code, value, true AS is_direct_match, NULL AS name_corrected FROM matched0
         UNION ALL SELECT name, block, code, value, false, name_match FROM stage1
         UNION ALL SELECT name, block, code, value, false, name_match FROM stage2
         UNION ALL SELECT name, block, code, value, false, name_corr FROM manual)"""
)
_FULL = (
    _CODED
    + """,
s12 AS (SELECT coalesce(s1.code, s2.code) AS code, s1.value AS value_s1, s1.name AS name_s1,
               s2.value AS value_s2, s2.name AS name_s2 FROM s1 FULL JOIN s2 ON s1.code = s2.code),
fulls AS (SELECT coalesce(s12.code, s3.code) AS code, value_s1, name_s1, value_s2, name_s2,
                 s3.value AS value_s3, s3.name AS name_s3 FROM s12 FULL JOIN s3 ON s12.code = s3.code),
inners AS (SELECT s1.code, s1.value AS value_s1, s2.value AS value_s2, s3.value AS value_s3
           FROM s1 JOIN s2 ON s1.code = s2.code JOIN s3 ON s1.code = s3.code)"""
)
_GAPS = (
    _FULL
    + """,
wide AS (SELECT * FROM fulls WHERE code NOT IN (SELECT code FROM inners)),
long AS (SELECT * FROM (
           SELECT code, 's1' AS source, value_s1 AS value, name_s1 AS name FROM wide
           UNION ALL SELECT code, 's2', value_s2, name_s2 FROM wide
           UNION ALL SELECT code, 's3', value_s3, name_s3 FROM wide)
         WHERE NOT (value IS NULL AND name IS NULL))"""
)

_WHOLE = (
    _PROVENANCE
    + f""",
{_CODED},
capitals AS (SELECT code, upper(name) AS name, block FROM registry),
told AS (SELECT {inputs.LITERAL_NAME} AS name, c_nationkey AS block, CAST({inputs.LITERAL_VALUE} AS INTEGER) AS value
         FROM customer),
direct AS (SELECT t.name, t.block, t.value, r.code FROM told t
           LEFT JOIN capitals r ON t.name = r.name AND t.block = r.block),
left3 AS (SELECT name, block, value FROM direct WHERE code IS NULL),
pool3 AS (SELECT * FROM capitals r WHERE NOT EXISTS (SELECT 1 FROM direct d WHERE d.code = r.code)),"""
    + _stage(3, 1, "left3", "pool3")
    + """,
w1 AS (SELECT code, coalesce(name_corrected, name) AS name, value FROM prov WHERE code IS NOT NULL),
w2 AS (SELECT code, name, value FROM s2),
w3 AS (SELECT x.code, r.name, x.value FROM (
         SELECT code, value FROM direct WHERE code IS NOT NULL UNION ALL SELECT code, value FROM stage3) x
       JOIN registry r ON r.code = x.code),
in_all AS (SELECT w2.code, w2.value FROM w1 JOIN w2 ON w1.code = w2.code JOIN w3 ON w1.code = w3.code),
gap AS (SELECT DISTINCT code, name, value
         FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)
         WHERE code NOT IN (SELECT code FROM in_all) AND code <> 11 AND name <> 'Customer#000000013')"""
)


def _fuzzy(k: int, left: str = "src", pool: str = "registry") -> str:
    return f"""WITH {_EXACT}, near AS MATERIALIZED {_near(left, pool, k)}
    SELECT s.name, s.block, s.value, h.right_name AS name_match, r.code, h.distance
    FROM {left} s JOIN near h ON h.block = s.block AND h.left_name = s.name
    JOIN {pool} r ON r.block = h.block AND r.name = h.right_name"""


def _conflict(by: str, over: str) -> str:
    return f"""WITH {_GAPS}, d AS (SELECT DISTINCT {by}, {over} FROM long)
    SELECT * FROM (SELECT {by}, {over}, count(*) OVER (PARTITION BY {by}) AS n FROM d) WHERE n > 1"""


_TITLED = (
    "list_aggregate(list_transform(range(1, length(t) + 1), lambda i:"
    " CASE WHEN i = 1 OR substr(t, i-1, 1) IN (' ', '-', '#') THEN upper(substr(t, i, 1))"
    " ELSE lower(substr(t, i, 1)) END), 'string_agg', '')"
)
_PART_TITLED = f"""WITH p AS (SELECT *, {inputs.SHOUTED_PART} AS t FROM part),
titled AS (SELECT *, {_TITLED} AS name FROM p)"""
_CONNECTED = (
    "replace(replace(replace(replace(name, ' Do ', ' do '), ' Da ', ' da '), ' De ', ' de '),"
    " 'D''oeste', 'D''Oeste')"
)
_SPARSE = """SELECT c_custkey, CASE WHEN c_acctbal < 3000 THEN NULL ELSE c_nationkey END AS value,
    CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL ELSE c_name END AS name FROM customer"""
_INLINE = ", ".join(f"('{a}', '{b}')" for a, b in INLINE_CORRECTIONS)
_BALANCE = inputs.BALANCE_TEXT.format(text="VARCHAR")


def oracle_sql() -> dict[str, str]:
    return {
        "csv_roundtrip": f"""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE {inputs.S3_NAME} END AS c_name,
            {inputs.AWKWARD_TEXT} AS note, c_nationkey, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer""",
        "scan_rename_headers": """SELECT s_suppkey AS code, s_name AS name, s_nationkey AS block,
            s_acctbal AS value FROM supplier""",
        "drop_trailer_rows": """SELECT * FROM orders WHERE o_orderkey NOT IN
            (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 2)""",
        "drop_trailer_by_file": """SELECT o_orderkey, o_custkey, o_orderstatus, month FROM (
            SELECT *, row_number() OVER (PARTITION BY month ORDER BY o_orderkey DESC) AS place
            FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders)) WHERE place > 2""",
        "object_literal_flatten": """SELECT event_id, event_type AS block, concat('user ', user_id) AS name,
            CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS value FROM events""",
        "object_literal_long": """SELECT l_orderkey, l_returnflag AS block, concat('part ', l_partkey) AS name,
            CAST(l_quantity AS INTEGER) AS value FROM lineitem""",
        "inline_crosswalk": f"""WITH {_INPUTS}, fix(a, b) AS (VALUES {_INLINE})
            SELECT upper(s.name) AS name, s.block, s.value, upper(f.b) AS name_corr
            FROM src s LEFT JOIN fix f ON upper(s.name) = upper(f.a)""",
        "project_keep_drop": "SELECT p_brand, p_type, p_name, p_size, p_partkey FROM part",
        "select_by_name_pattern": "SELECT l_orderkey, l_shipdate, l_linestatus FROM lineitem",
        "derive_columns": """SELECT o_orderkey, upper(o_orderpriority) AS priority, o_orderstatus = 'F' AS is_final,
            o_custkey + 1 AS next_customer FROM orders""",
        # full Unicode mapping: sharp s becomes SS, which the checking engine's upper does not do
        "upper_all_columns": """SELECT upper(replace(text, 'ß', 'ss')) AS text, upper(lang) AS lang,
            upper(source) AS source FROM documents""",
        "lenient_int_cast": f"""SELECT c_custkey, CAST(trunc(TRY_CAST({_BALANCE} AS DOUBLE)) AS INTEGER) AS whole
            FROM customer""",
        "filter_compound": """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
            WHERE (l_quantity > 45 AND l_returnflag <> 'N') OR NOT (l_tax > 0 OR l_discount = 0)""",
        "split_matched_unmatched": f"""WITH {_EXACT}
            SELECT *, CASE WHEN code IS NULL THEN 'unmatched' ELSE 'matched' END AS part FROM exact""",
        "regex_lookup": """SELECT p_partkey, p_name, p_type, p_brand FROM part
            WHERE (regexp_matches(p_name, 'widget|^hot|g[a-z]+r$') AND p_type IN ('ECONOMY', 'PROMO', 'LARGE'))
               OR p_brand = 'Brand#2'""",
        "drop_all_null": f"SELECT * FROM ({_SPARSE}) WHERE NOT (value IS NULL AND name IS NULL)",
        "exclusion_rules": f"""WITH {_CODED}, rows AS (SELECT code, name, block, value - 5 AS value FROM s3)
            SELECT * FROM rows WHERE NOT (value = 0 AND name = 'Customer#000000007') AND code <> 11
            AND name <> 'Customer#000000013'
            AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = code AND s_nationkey = block)""",
        "exact_match_left_join": f"WITH {_EXACT} SELECT * FROM exact",
        "exact_match_fanout": """WITH want AS (SELECT p_name AS name, p_type AS block, max(p_size) AS value
                FROM part GROUP BY ALL)
            SELECT * FROM (SELECT name, block, value, p_partkey AS code, count(*) OVER (PARTITION BY name, block) AS n
                FROM want JOIN part ON p_name = name AND p_type = block) WHERE n > 1""",
        "left_join_renamed_key": """SELECT o_orderkey, o_custkey, o_totalprice, c_name FROM orders
            LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
        "dimension_lookup": """SELECT s_suppkey, s_nationkey AS n_nationkey, n_name, n_regionkey FROM supplier
            LEFT JOIN nation ON s_nationkey = n_nationkey""",
        "registry_pool_anti": f"WITH {_EXACT} SELECT * FROM pool0",
        "unmatched_anti_by_name": f"WITH {_INPUTS} SELECT * FROM src WHERE name NOT IN (SELECT name FROM registry)",
        "multi_source_inner": f"WITH {_FULL} SELECT * FROM inners",
        "multi_source_full": f"WITH {_FULL} SELECT * FROM fulls",
        "fuzzy_join_k1": _fuzzy(1),
        "fuzzy_join_k2": _fuzzy(2),
        "fuzzy_join_mixed_block": _fuzzy(1),
        "fuzzy_join_k5": _fuzzy(5),
        "osa_distance_pairs": f"""SELECT c_custkey, CAST({_osa('a', 'b')} AS INTEGER) AS distance
            FROM (SELECT c_custkey, {inputs.DAMAGED_NAME} AS a, c_name AS b FROM customer)""",
        "add_group_count": """SELECT l_orderkey, l_suppkey, l_returnflag,
            count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n FROM lineitem""",
        "duplicate_keys_single": """SELECT * FROM (SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) AS n
            FROM part) WHERE n > 1""",
        "duplicate_keys_composite": """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey,
            count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""",
        "distinct_projection": "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
        "sort_nulls_last": f"SELECT * FROM ({_SPARSE}) ORDER BY name NULLS LAST, value NULLS LAST, c_custkey",
        "smallest_values_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20",
        "multiset_difference": """WITH a AS (SELECT l_suppkey AS key, l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY ALL),
            b AS (SELECT l_partkey AS key, l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY ALL)
            SELECT * FROM (SELECT coalesce(a.key, b.key) AS key, coalesce(a.flag, b.flag) AS flag,
                CAST(coalesce(a.n, 0) - coalesce(b.n, 0) AS BIGINT) AS surplus
                FROM a FULL JOIN b ON a.key = b.key AND a.flag = b.flag) WHERE surplus <> 0""",
        "multiset_difference_ranged": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(sum(n) AS BIGINT) AS surplus FROM (
            SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS n FROM orders
            UNION ALL SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1013 <> 0 THEN o_orderstatus END, -1 FROM orders
            UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, -1 FROM orders WHERE o_orderkey = 7)
            GROUP BY ALL HAVING sum(n) <> 0""",
        "union_missing_columns": """SELECT c_name AS name, c_nationkey AS block, c_mktsegment AS segment,
            NULL::BIGINT AS supplier FROM customer
            UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier""",
        "union_strict": f"WITH {_CODED} SELECT code, value FROM s1 UNION ALL SELECT code, value FROM s2",
        "pivot_longer_multi": f"""WITH {_FULL} SELECT code, 's1' AS source, value_s1 AS value, name_s1 AS name FROM fulls
            UNION ALL SELECT code, 's2', value_s2, name_s2 FROM fulls
            UNION ALL SELECT code, 's3', value_s3, name_s3 FROM fulls""",
        "title_case_names": f"{_PART_TITLED} SELECT p_partkey, name FROM titled",
        "normalize_names": f"{_PART_TITLED} SELECT p_partkey, {_CONNECTED} AS name FROM titled",
        "clean_coded_source": f"""{_PART_TITLED} SELECT {_CONNECTED} AS name, CAST(p_partkey AS INTEGER) AS code,
            p_type AS block, p_size AS value FROM titled""",
        "fuzzy_stage_k1": f"WITH {_STAGE1} SELECT * FROM stage1",
        "fuzzy_clean": f"WITH {_STAGE1} SELECT name, block, code, name_match, value FROM stage1",
        "ambiguous_match_check": f"""WITH {_STAGE1} SELECT coalesce(bool_or(n_matches > 1), false) AS ambiguous,
            count(*) FILTER (n_matches > 1) AS ambiguous_rows FROM stage1""",
        "match_cascade": f"""WITH {_CASCADE}
            SELECT name, block, value, code, 'exact' AS stage, NULL AS name_match, NULL::INTEGER AS distance FROM matched0
            UNION ALL SELECT name, block, value, code, 'k1', name_match, distance FROM stage1
            UNION ALL SELECT name, block, value, code, 'k2', name_match, distance FROM stage2
            UNION ALL SELECT name, block, value, NULL, 'unmatched', NULL, NULL FROM un2""",
        "candidate_report": f"""WITH {_CASCADE}, {_stage(5, 5, 'un2', 'pool2')},
            far AS (SELECT * FROM stage5 WHERE n_matches = 1)
            SELECT u.name, u.block, f.name_match AS name_candidate, f.code AS code_candidate
            FROM un2 u LEFT JOIN far f ON f.name = u.name""",
        "crosswalk_match": f"WITH {_MANUAL} SELECT * FROM manual",
        "match_provenance": f"WITH {_PROVENANCE} SELECT * FROM prov",
        "match_summary_counts": f"""WITH {_PROVENANCE} SELECT is_direct_match, name_corrected IS NULL AS no_correction,
            count(*) AS n FROM prov GROUP BY ALL""",
        "coalesce_name": f"""WITH {_PROVENANCE} SELECT coalesce(name_corrected, name) AS name,
            name AS name_data_orig, code, block, value FROM prov""",
        "rows_per_source": f"""WITH {_CODED} SELECT 's1' AS source, count(*) AS n_rows FROM s1
            UNION ALL SELECT 's2', count(*) FROM s2 UNION ALL SELECT 's3', count(*) FROM s3""",
        "nulls_per_source": f"""WITH {_CODED} SELECT 's1' AS source, count(*) - count(value) AS n_nulls FROM s1
            UNION ALL SELECT 's2', count(*) - count(value) FROM s2
            UNION ALL SELECT 's3', count(*) - count(value) FROM s3""",
        "reconcile_agreed": f"WITH {_FULL} SELECT code, value_s2 AS value FROM inners",
        "reconcile_agreed_repeated": f"""WITH {_FULL}, {", ".join(
            f"r_{t} AS (SELECT CASE WHEN code % 50 <> 0 THEN code // 2 END AS code, value FROM {t})"
            for t in ("s1", "s2", "s3"))}, n1 AS (SELECT code, count(*) AS n FROM r_s1 GROUP BY code),
            n3 AS (SELECT code, count(*) AS n FROM r_s3 GROUP BY code)
            SELECT r.code, r.value, n1.n * n3.n AS n FROM r_s2 r
            JOIN n1 ON r.code IS NOT DISTINCT FROM n1.code JOIN n3 ON r.code IS NOT DISTINCT FROM n3.code""",
        "reconcile_value_conflicts": f"""WITH {_FULL} SELECT * FROM inners
            WHERE value_s1 <> value_s2 OR value_s1 <> value_s3""",
        "reconcile_gaps_wide": f"WITH {_GAPS} SELECT * FROM wide",
        "reconcile_gaps_long": f"WITH {_GAPS} SELECT * FROM long",
        "conflict_values": _conflict("code", "value"),
        "conflict_names": _conflict("code", "name"),
        "conflict_codes": _conflict("name", "code"),
        "whole_job": f"""WITH {_WHOLE}
            SELECT b.code, r.name, r.block, b.value
            FROM (SELECT code, value FROM in_all UNION ALL SELECT code, value FROM gap) b
            LEFT JOIN registry r ON r.code = b.code""",
        "reconcile_final": f"""WITH {_INPUTS}, {_GAPS},
            fixed AS (SELECT DISTINCT code, name, value FROM long WHERE code <> 11 AND name <> 'Customer#000000013'),
            both_rows AS (SELECT code, value_s2 AS value FROM inners UNION ALL SELECT code, value FROM fixed)
            SELECT b.code, r.name, r.block, b.value FROM both_rows b LEFT JOIN registry r ON r.code = b.code""",
        "any_null_check": f"""WITH {_CODED} SELECT 's1' AS source, count(*) > count(value) AS any_null FROM s1
            UNION ALL SELECT 's2', count(*) > count(value) FROM s2
            UNION ALL SELECT 's3', count(*) > count(value) FROM s3""",
        "quality_report": f"""WITH {_CODED}, t AS (SELECT code, name, block, value - 5 AS value FROM s2),
            dup AS (SELECT code, count(*) AS n FROM t GROUP BY ALL HAVING count(*) > 1),
            dup_name AS (SELECT name, block, count(*) AS n FROM t GROUP BY ALL HAVING count(*) > 1),
            dup_block AS (SELECT block, count(*) AS n FROM t GROUP BY ALL HAVING count(*) > 1)
            SELECT 'null_key' AS "check", count(*) FILTER (code IS NULL) AS n_bad, NULL AS sample FROM t
            UNION ALL SELECT 'null_value', count(*) FILTER (value IS NULL),
                min(CAST(code AS VARCHAR)) FILTER (value IS NULL) FROM t
            UNION ALL SELECT 'zero_value', count(*) FILTER (value = 0),
                min(CAST(code AS VARCHAR)) FILTER (value = 0) FROM t
            UNION ALL SELECT 'any_null', count(*) FILTER (value IS NULL OR code IS NULL OR name IS NULL OR block IS NULL),
                min(CAST(code AS VARCHAR)) FILTER (value IS NULL OR code IS NULL OR name IS NULL OR block IS NULL) FROM t
            UNION ALL SELECT 'duplicate_code', CAST(coalesce(sum(n), 0) AS BIGINT), min(CAST(code AS VARCHAR)) FROM dup
            UNION ALL SELECT 'duplicate_name_block', CAST(coalesce(sum(n), 0) AS BIGINT),
                min(concat(name, '|', block)) FROM dup_name
            UNION ALL SELECT 'duplicate_block', CAST(coalesce(sum(n), 0) AS BIGINT), min(CAST(block AS VARCHAR)) FROM dup_block
            UNION ALL SELECT 'not_covered', count(*), min(CAST(code AS VARCHAR)) FROM s1
                WHERE code NOT IN (SELECT code FROM t)""",
    }
