import pytest

from matchwright.session import name_stage_folder
from matchwright.sources import staging
from matchwright.sources.literals import (
    cut_literals,
    flatten_literals,
    flatten_long_literals,
    read_object_literals,
    rejected_literals,
)
from matchwright.sources.tables import (
    drop_trailer,
    inline_table,
    read_delimited,
    read_landed,
    read_without_trailers,
    write_delimited,
)


def test_csv_roundtrip_keeps_nulls_and_accents(spark, rows, tmp_path):
    df = spark.createDataFrame(
        [(1, "São, João", 2.5), (2, None, None), (None, 'say "x"', 0.0)], "code int, name string, value double"
    )
    write_delimited(df, str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), df.schema)) == rows(df)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "code,name,value" in text and "2,NA,NA" in text


def test_empty_and_na_fields_are_null(spark, rows, tmp_path):
    (tmp_path / "in.csv").write_text("code,name\n1,NA\n2,\n3,x\n")
    assert rows(read_delimited(spark, str(tmp_path / "in.csv"), "code int, name string")) == [
        (1, None), (2, None), (3, "x"),
    ]


def test_landed_headers(spark, tmp_path):
    (tmp_path / "in.csv").write_text("UF,Módulo fiscal (ha)\nSP,10\n")
    df = read_landed(
        spark, str(tmp_path / "in.csv"), {"UF": "block", "Módulo fiscal (ha)": "value"}, "csv",
        "`UF` string, `Módulo fiscal (ha)` double",
    )
    assert [r.asDict() for r in df.collect()] == [{"block": "SP", "value": 10.0}]


def test_drop_trailer(spark):
    df = spark.range(10).withColumnRenamed("id", "row").repartition(3)
    assert sorted(r[0] for r in drop_trailer(df, "row", 2).collect()) == list(range(8))


def test_object_literal(spark, rows, tmp_path):
    text = '{AC:{"ASSIS BRASIL":["100"],BUJARI:["70"]},SÃO PAULO:{"D\'OESTE":["5"]}}'
    (tmp_path / "x.js").write_text(text)
    want = [("AC", "ASSIS BRASIL", "100"), ("AC", "BUJARI", "70"), ("SÃO PAULO", "D'OESTE", "5")]
    for whole in (True, False):
        assert rows(read_object_literals(spark, str(tmp_path / "x.js"), one_per_file=whole)) == want
    df = spark.createDataFrame([(1, text), (2, '{B:{C:["1"]}}')], "id int, t string")
    assert flatten_literals(df, "t").columns == ["id", "block", "name", "value"]
    assert flatten_literals(df, "t").count() == 4


def test_leaf_with_several_values_is_refused(spark):
    df = spark.createDataFrame([('{A:{B:["1","2"]}}',)], "t string")
    with pytest.raises(Exception, match="one-element"):
        flatten_literals(df, "t").collect()


def test_inline_table(spark, rows):
    assert rows(inline_table(spark, ["a", "b c"], [("x", "y")])) == [("x", "y")]


def test_stage_table_reads_back_the_same(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(staging.stage_table(df)) == rows(df)


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf(conf)


def test_stage_root_is_the_clusters_folder():
    session = _Session(**{"spark.checkpoint.dir": "hdfs://shared/ck/", "spark.master": "yarn"})
    assert staging.stage_root(session) == "hdfs://shared/ck"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.stage_root(_Session(**{"spark.master": "yarn"}))
    local = _Session(**{"spark.master": "local[2]"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.stage_root(local)
    assert staging.stage_root(name_stage_folder(local)) == local.conf["spark.checkpoint.dir"]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.stage_root(name_stage_folder(_Session(**{"spark.master": "yarn"})))


def test_csv_keeps_quotes_breaks_blanks_and_empty_text(spark, rows, tmp_path):
    values = ['say "hi"', "a,b", "one\ntwo", "  pad ", "back\\slash\\", "", '"', "x\\,y", None]
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    write_delimited(df, str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_csv_written_by_hand(spark, rows, tmp_path):
    (tmp_path / "in.csv").write_text('id,t,u\n1,"say ""hi"" now",x\n2,"one\ntwo", y\n3,"",\n')
    got = rows(read_delimited(spark, str(tmp_path / "in.csv"), "id int, t string, u string"))
    assert got == [(1, 'say "hi" now', "x"), (2, "one\ntwo", " y"), (3, "", None)]


@pytest.mark.parametrize("bad", ["{A:{B:[", "no literal", None, "{A:null}"])
def test_unreadable_literals_raise_or_are_told(spark, bad):
    df = spark.createDataFrame([(1, '{A:{B:["1"]}}'), (2, bad), (3, "{}")], "id int, t string")
    with pytest.raises(Exception, match="readable literal"):
        flatten_literals(df, "t").collect()
    assert [r.id for r in rejected_literals(df, "t").collect()] == [2]
    assert flatten_literals(df.where("id <> 2"), "t").count() == 1


def test_literals_are_parsed_once(spark):
    df = spark.createDataFrame([('{A:{B:["1"]}}',)], "t string")
    plan = flatten_literals(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_trailers_by_position_in_the_file(spark, tmp_path):
    path = str(tmp_path / "landed")
    for low, high in ((0, 10), (10, 13), (20, 22), (30, 31)):
        spark.range(low, high, 1, 1).write.mode("append").parquet(path)
    spark.range(0).write.mode("append").parquet(path)
    kept = read_without_trailers(spark, path, 2, "id long")
    assert sorted(r.id for r in kept.collect()) == [*range(8), 10]
    assert kept.columns == ["id"]
    assert read_without_trailers(spark, [path], 0).count() == 16


def test_long_literals_are_cut(spark, rows):
    text = '{A : {"x, }{":["1"], Y:["2"],Y:["3"],"q\\"":["4"]} ,B:{},A:{Y:["5"]}}'
    df = spark.createDataFrame([(1, text), (2, "{}"), (3, ' {C:{"c, d":["6"]}} ')], "id int, t string")
    cut = cut_literals(df, "t", 1)
    assert cut.columns == ["id", "t"]
    assert sorted(r.t for r in cut.where("id = 1").collect()) == sorted(
        ['{A : {"x, }{":["1"]}}', '{A : { Y:["2"]}}', '{A : {Y:["3"]}}', '{A : {"q\\"":["4"]}}', "{B:{}}", '{A:{Y:["5"]}}']
    )
    want = [
        (1, "A", "Y", "2"), (1, "A", "Y", "3"), (1, "A", "Y", "5"), (1, "A", 'q"', "4"),
        (1, "A", "x, }{", "1"), (3, "C", "c, d", "6"),
    ]
    for most in (1, 30, 1 << 16):
        got = flatten_long_literals(df, "t", most=most).selectExpr("id", "trim(block)", "trim(name)", "value")
        assert rows(got) == sorted(want, key=lambda t: [(True, str(v)) for v in t])


@pytest.mark.parametrize(
    "text", [None, "", "{A:{B:[\"1\"]}", "{A:[1]}", "{A:{B:[\"1\"]} x,}", "{A:null}", "{A:{B:[\"1\"]}}}", "x{}", "{A:{B:[\"1\"}]}"]
)
def test_cutting_hides_no_bad_record(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="not a readable literal"):
        flatten_long_literals(df, "t").collect()


def test_cut_of_many_leaves(spark):
    inner = ",".join(f'"N {i}":["{i % 100}"]' for i in range(20_000))
    df = spark.createDataFrame([("{" + f"SP:{{{inner}}},AC:{{{inner}}}" + "}",)], "t string")
    assert cut_literals(df, "t", 10_000).selectExpr("max(length(t))").first()[0] < 11_000
    found = flatten_long_literals(df, "t", most=10_000)
    assert found.selectExpr("count(*)", "count(DISTINCT block, name)", "sum(value)").first()[:] == (
        40_000, 40_000, 2 * 200 * sum(range(100)),
    )
