"""Edges of the operators: clashing names, long pages, unmarked pages, large products, SQL."""

import random
import time

import duckdb
import pytest

from matchwright.llm import catalog, html_text
from matchwright.llm.substrings import remove_repeats, without_repeats
from matchwright.llm.topk import top_products

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op5_exact_topk", "op8_substring_dedup", "op9_jaccard_join"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = catalog.queries()[name](spark, SF_DIR)
    want = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_columns_named_like_the_marks(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, passage, 5, "a"), (2, "x " + passage + " y", 6, "b"), (3, passage, 7, "c"), (None, passage, 8, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __spans int, __COPY string")
    out = without_repeats(docs)
    assert out.columns == docs.columns
    found = {r.doc_id: (r.text, r["__spans"], r["__COPY"]) for r in out.collect()}
    assert found == {1: (passage, 5, "a"), 2: ("x y", 6, "b"), 3: ("", 7, "c"), None: (passage, 8, "d")}
    keyed = docs.select("text", docs.doc_id.alias("__k"))
    assert {r["__k"]: r.n_removed for r in remove_repeats(keyed, "__k").collect()} == {1: 0, 2: 20, 3: 20, None: 0}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        remove_repeats(spark.createDataFrame([("k", "a")], "doc_id string, text string")).collect()


def test_products_beyond_64_bits_raise(spark):
    for large in (1e300, 1e9):
        df = spark.createDataFrame([(1, [large, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
        with pytest.raises(OverflowError, match="64 bits"):
            top_products(df)
    df = spark.createDataFrame([(20, [4e7, 1.0]), (2, [4e7, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_products(df).collect()] == [(20, 1, 2, (64 * 40_000_000) ** 2 + 64 * 128)]


@pytest.mark.parametrize(
    "source",
    ["<a b='c' " * 100_000, "<a b='c' " * 100_000 + "x='>", "<!" * 400_000, "<div>" * 150_000,
     "<div>" * 5_000 + "<li></li>" * 60_000, "<p>" * 150_000, "<a\"" * 200_000 + ">"],
)
def test_long_pages_take_time_in_proportion(source):
    start = time.process_time()
    html_text.main_texts([source], None)
    assert time.process_time() - start < 30


def brute_end(source, at):
    quote = ""
    while at < len(source):
        sign = source[at]
        if quote:
            quote = "" if sign == quote else quote
        elif sign in "\"'":
            quote = sign
        elif sign == ">":
            return at
        at += 1
    return -1


def test_tag_ends_equal_a_plain_reading():
    rng = random.Random(8)
    for _ in range(400):
        source = "".join(rng.choices("<a>\"' ", weights=[3, 4, 1, 2, 2, 1], k=rng.randint(0, 60)))
        ends = html_text.TagEnds(source)
        for at in sorted(rng.choices(range(len(source) + 1), k=12)):
            assert ends.after(at) == brute_end(source, at)


def test_pages_without_marks_lose_their_menus(spark):
    page = (
        "<html><body><nav><li>Home</li></nav><header><p>Site</p></header><div class='post'><p>The text.</p></div>"
        "<div class='comments'><p>No!</p></div><footer>c</footer></body></html>"
    )
    df = spark.createDataFrame([(1, "u", page), (2, "u", None)], "page_id long, url string, html string")
    trees = html_text.fit_pages(df)
    assert trees is None
    assert {r.page_id: r.text for r in html_text.extract_main(df, trees).collect()} == {1: "The text.", 2: ""}


def test_sample_holds_marked_pages_alone(spark):
    marked = "<body><nav>Menu</nav><ARTICLE><p>Some words, said here.</p></article><footer>f</footer>"
    rows = [(i, "u", f"<body><div>{i}</div>") for i in range(50)] + [(99, "u", marked)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_text.fit_pages(df, trained=1) is not None
