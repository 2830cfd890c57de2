import pytest
from pyspark.sql import functions as F

from matchwright.functions.columns import as_integer, columns_containing, map_columns, move_last
from matchwright.functions.names import normalize_names, squish, title_case
from matchwright.operators import counts, filters, joins, reshape


@pytest.fixture
def frame(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


def test_null_keys_match_in_joins(frame, rows):
    a = frame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = frame([(None, 10), ("x", 20), ("z", 30)], "k string, b int")
    assert rows(joins.null_safe_join(a, b, "k")) == [(None, 1, 10), ("x", 2, 20)]
    assert rows(joins.without(a, b, "k")) == [("y", 3)]
    assert rows(joins.within(a, b, "k")) == [(None, 1), ("x", 2)]
    assert rows(joins.null_safe_join(a, b, "k", "full")) == [
        (None, 1, 10), ("x", 2, 20), ("y", 3, None), ("z", None, 30),
    ]


def test_join_suffixes_and_renamed_keys(frame, rows):
    a = frame([(1, "p")], "id int, v string")
    b = frame([(1, "q")], "key int, v string")
    out = joins.null_safe_join(a, b, [("id", "key")], suffixes=("_1", "_2"))
    assert out.columns == ["id", "v_1", "v_2"]
    assert joins.null_safe_join(a, a, "id").columns == ["id", "v", "v_right"]


def test_three_valued_exclusions(frame, rows):
    df = frame([(1, "a"), (2, "b"), (None, "c"), (3, None)], "code int, name string")
    assert rows(filters.apply_exclusions(df, [{"code": 1}])) == [(2, "b"), (3, None)]
    assert rows(filters.apply_exclusions(df, [{"name": "b"}])) == [(None, "c"), (1, "a")]
    # undecided only where the decided half does not settle it
    both = filters.apply_exclusions(df, [{"code": 3, "name": "a"}])
    assert rows(both) == [(None, "c"), (1, "a"), (2, "b")]
    table = frame([(None,), (2,)], "code int")
    assert rows(filters.apply_exclusion_table(df, table, "code")) == [(1, "a"), (3, None)]


def test_regex_lookup(frame, rows):
    df = frame([("Tacima", "PB", 1), ("Santana", "RS", 2), ("Other", "PB", 3)], "n string, uf string, c int")
    assert rows(filters.regex_lookup(df, "n", "Tacima|Santana", {"uf": "PB"}), "c") == [(1,)]
    assert rows(filters.regex_lookup(df, "n", "Joca", or_equals={"c": 3}), "c") == [(3,)]
    assert rows(filters.regex_lookup(df, "n", "a", isin={"uf": ["RS", "SC"]}), "c") == [(2,)]


def test_group_counts_treat_null_as_a_group(frame, rows):
    df = frame([(None, 1), (None, 2), ("x", 3)], "k string, v int")
    assert rows(counts.add_group_count(df, "k")) == [(None, 1, 2), (None, 2, 2), ("x", 3, 1)]
    assert rows(counts.find_duplicates(df, "k")) == [(None, 1, 2), (None, 2, 2)]


def test_several_values_counts_null_as_a_value(frame, rows):
    df = frame(
        [(1, "a"), (1, "a"), (2, "a"), (2, None), (3, None), (3, None), (4, "a"), (4, "b"), (None, "x"), (None, "y")],
        "k int, v string",
    )
    assert rows(counts.several_values(df, "k", "v")) == [
        (None, "x", 2), (None, "y", 2), (2, None, 2), (2, "a", 2), (4, "a", 2), (4, "b", 2),
    ]


def test_multisets(frame, rows):
    a = frame([("x", 1), ("x", 1), (None, 2)], "k string, v int")
    b = frame([(1, "x"), (2, None), (2, None)], "v int, k string")
    assert rows(counts.multiset_difference(a, b)) == [(None, 2, -1), ("x", 1, 1)]
    assert not counts.multisets_equal(a, b)
    assert counts.multisets_equal(a, a.orderBy("v"))


def test_ranged_difference(frame, rows):
    a = frame([(1, None), (None, 1), (2, 0)], "x int, y int")
    assert not counts.multisets_equal(a, frame([(1, None), (1, None), (2, 0)], "x int, y int"))
    assert rows(counts.ranged_difference(a, frame([(1, None), (2, 0), (2, 0)], "x int, y int"))) == [
        (None, 1, 1), (2, 0, -1),
    ]
    # other types, as a union has them, and a negative zero
    assert counts.multisets_equal(a, frame([(0, 2), (1, None), (None, 1)], "y long, x int"))
    assert counts.multisets_equal(frame([(0.0,)], "d double"), frame([(-0.0,)], "d double"))
    nested = frame([([1, None],)], "l array<int>")
    assert not counts.multisets_equal(nested, frame([([None, 1],)], "l array<int>"))
    assert counts.multisets_equal(a.limit(0), a.where("false"))


def test_ranges_that_differ(spark):
    many = spark.range(50_000).selectExpr("id", "CAST(id AS STRING) AS s")
    assert counts.differing_ranges(many, many.orderBy("s")) == []
    other = many.withColumn("s", F.expr("IF(id = 77, 'x', s)"))
    assert 1 <= len(counts.differing_ranges(many, other)) <= 2
    found = counts.ranged_difference(many, other).collect()
    assert sorted(map(tuple, found)) == [(77, "77", 1), (77, "x", -1)]


def test_unions(frame):
    a, b = frame([(1, "x")], "i int, s string"), frame([("y", 2.0)], "s string, d double")
    assert [tuple(r) for r in reshape.stack_rows([a, b]).collect()] == [(1, "x", None), (None, "y", 2.0)]
    with pytest.raises(Exception, match="Cannot resolve column"):
        reshape.stack_rows([a, b], strict=True).collect()


def test_sorting_puts_nulls_last_and_knows_accents(frame):
    df = frame([("b",), ("Á",), (None,), ("a",), ("Z",)], "s string")
    plain = [r[0] for r in reshape.sort_nulls_last(df, "s").collect()]
    assert plain == ["Z", "a", "b", "Á", None]
    unicode_order = [r[0] for r in reshape.sort_nulls_last(df, "s", collation="UNICODE").collect()]
    assert unicode_order == ["a", "Á", "b", "Z", None]
    assert [r[0] for r in reshape.smallest_values(df, ["s"], 2).collect()] == ["Z", "a"]


def test_pivot_longer_multi(frame, rows):
    wide = frame([(1, 5, 7.5, "a", None)], "code int, Mod_ha_s1 int, Mod_ha_s2 double, NAME_s1 string, NAME_s3 string")
    out = reshape.pivot_longer_multi(wide, "code", "([aA-zZ]+)_(s[1-3])")
    assert out.columns == ["code", "source", "Mod_ha", "NAME"]
    assert rows(out) == [(1, "s1", 5.0, "a"), (1, "s2", 7.5, None), (1, "s3", None, None)]
    assert rows(filters.drop_all_null(out, ["Mod_ha", "NAME"]), "source") == [("s1",), ("s2",)]


def test_lenient_integer(frame, rows):
    df = frame([("12.5",), ("abc",), ("",), (None,), ("-7",), ("99999999999",)], "x string")
    assert [r[0] for r in df.select(as_integer("x")).collect()] == [12, None, None, None, -7, None]


def test_casing_rules(frame):
    names = [
        ("XIQUE-XIQUE", "Xique-Xique", "Xique-Xique"),
        ("PINGO-D'ÁGUA", "Pingo-D'água", "Pingo-D'água"),
        ("SANTA BÁRBARA D'OESTE", "Santa Bárbara D'oeste", "Santa Bárbara D'Oeste"),
        ("SÃO JOÃO DO PIAUÍ", "São João Do Piauí", "São João do Piauí"),
        ("X DOS Y", "X Dos Y", "X Dos Y"),
        (None, None, None),
    ]
    df = frame([(n[0],) for n in names], "x string").select(title_case("x").alias("t"), normalize_names("x").alias("n"))
    assert df.schema["t"].dataType.simpleString() == "string"
    assert [tuple(r) for r in df.collect()] == [n[1:] for n in names]
    assert frame([("GAVIÃO   PEIXOTO ",)], "x string").select(squish("x")).first()[0] == "GAVIÃO PEIXOTO"


def test_column_helpers(frame):
    df = frame([(1, "a", "b")], "id int, MUN_NAME_s1 string, other string")
    assert columns_containing(df, "mun_n") == ["MUN_NAME_s1"]
    assert move_last(df, "id").columns == ["MUN_NAME_s1", "other", "id"]
    assert map_columns(df.drop("id"), F.upper).first()["other"] == "B"


