"""The Jaccard join where sets are large and where buckets are crowded."""

import os
import random

import numpy as np
from test_llm_operators import brute_components

from matchwright.llm import near_join
from matchwright.llm.near_join import PartEnum, near_components
from matchwright.sources import staging


def _counted(monkeypatch):
    """Rows of the stage tables written from now on, by label."""
    rows, write = [], near_join.stage_table

    def counting(df, label):
        table = write(df, label)
        rows.append((label, table.count()))
        return table

    monkeypatch.setattr(near_join, "stage_table", counting)
    return rows


def test_whole_sets_of_large_texts_travel_only_where_similar(spark, monkeypatch):
    rng = random.Random(5)
    shared = [f"s{k}" for k in range(600)]
    texts = []
    for i in range(6):
        words = [f"w{rng.randrange(10**9)}" for _ in range(2600)]
        texts.append(" ".join(words + shared))
    # near copies, one of them over the border of cells
    words = [f"c{k}" for k in range(2100)]
    texts += [" ".join(words), " ".join(words[:2000] + ["x"]), " ".join(words[100:])]
    rows = list(enumerate(texts))
    seen = _counted(monkeypatch)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, 5, 80).collect()}
    assert got == brute_components(rows, 5, 80)
    assert got[7][1] == got[8][1] == 6
    assert sum(n for label, n in seen if label == "near") <= 3


def test_second_sketches_fold(spark):
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 9000, dtype=np.uint64)
    sets = {"small": pool[:2000], "wider": pool[:2200], "other": pool[3000:5200]}
    marks = {k: near_join.wide_sketch(v) for k, v in sets.items()}
    assert len(marks["wider"]) == 2 * len(marks["small"])
    assert near_join.wide_sketch(pool[:100]) is None
    rows = [
        (f"{a} {b}", marks[a].tolist(), len(sets[a]), marks[b].tolist(), len(sets[b]))
        for a in marks
        for b in marks
    ]
    df = spark.createDataFrame(
        rows, "pair string, a_wide array<long>, a_n long, b_wide array<long>, b_n long"
    )
    kept = {r.pair for r in df.where(near_join.wide_possible("a_", "b_", 80)).collect()}
    assert kept == {f"{a} {b}" for a in marks for b in marks if (a == "other") == (b == "other")}


def test_crowded_buckets_are_left_and_no_link_is_lost(spark, monkeypatch):
    monkeypatch.setattr(near_join, "CROWD", 3)
    rng = random.Random(7)
    common, rows = [f"p{k}" for k in range(30)], []
    for i in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)] + common
        for copy in range(2):
            at = rng.randrange(len(words) - 4)
            rows.append((2 * i + copy, " ".join(words[:at] + [f"v{i}{copy}"] + words[at + copy :])))
    rows += [(1000 + k, " ".join(common + [f"e{k}"])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = _counted(monkeypatch)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, 5, 80).collect()}
    assert got == brute_components(rows, 5, 80)
    counts = dict(seen)
    assert counts["members"] < counts["buckets"]


def test_groups_to_spare_are_no_fewer_than_what_may_be_left():
    scheme = PartEnum(80)
    for n in range(1, 3000):
        asked, left = scheme.groups(scheme.band(n))
        k = 2 * n * 20 // 180
        assert (k // 2 + 1) // scheme.share <= left or not asked
    assert PartEnum(85).leaves() == "0"


def test_large_sets_that_share_nothing_share_no_signature():
    rng = np.random.default_rng(11)
    for percent in (80, 85):
        sizes = rng.integers(1000, 4500, 120)
        sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in sizes]
        sigs, many = PartEnum(percent).signed(sets)
        assert len(sigs) == many.sum() and many.all()
        assert len(np.unique(sigs)) == len(sigs)


def test_similar_sets_share_a_signature_that_is_not_of_empty_parts():
    rng = np.random.default_rng(12)
    for percent in (80, 85, 95):
        scheme = PartEnum(percent)
        for size in [*range(4, 70), 200, 701, 1500]:
            base = rng.integers(0, 2**63, size, dtype=np.uint64)
            # the most that may be left out, the most that may be added, and both
            out = size * (100 - percent) // 100
            more = size * 100 // percent - size
            some = 2 * size * (100 - percent) // (100 + percent) // 2
            for gone, new in ((out, 0), (0, more), (some, some)):
                other = np.r_[base[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)]
                if gone + new and 100 * (size - gone) >= percent * (size + new):
                    a, b = (scheme.signatures(np.unique(x)) for x in (base, other))
                    assert np.intersect1d(a, b).size > scheme.groups(scheme.band(size))[1], size


def test_sets_of_a_slice_are_signed_as_one_by_one_and_by_their_own_size():
    rng = np.random.default_rng(13)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (0, 1, 5, 90, 0, 800, 7)]
    scheme = PartEnum(85)
    sigs, many = scheme.signed(sets)
    assert (sigs == np.concatenate([scheme.signatures(s) for s in sets])).all()
    assert many.tolist() == [len(scheme.signatures(s)) for s in sets]
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in range(300, 1500, 7)]
    assert len(scheme.signed(sets)[0]) < 0.42 * sum(map(len, sets))


def test_words_are_those_of_split_and_lower():
    odd = [b"", b" \t", b"A b\x0bC", b"\xc3\x84 b\xc2\xa0c d", b"x" * 700 + b" Y", b"\x00 \x1c z"]
    data = b" " + b" ".join(odd) + b" "
    starts, hashes = near_join.word_hashes(np.frombuffer(data, np.uint8))
    words = data.lower().split()
    assert [data[s:].lower().split(None, 1)[0] for s in starts] == words
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_tables_that_nothing_reads_any_more_are_deleted(spark, monkeypatch):
    made, write = [], near_join.stage_table
    monkeypatch.setattr(
        near_join, "stage_table", lambda df, label: made.append((label, write(df, label))) or made[-1][1]
    )
    before = spark.conf.get(staging.CLEANUP)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(words[:-1] + [f"v{rng.randrange(30)}"])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs, 5, 80).collect()}
    assert got == brute_components(rows, 5, 80)
    assert spark.conf.get(staging.CLEANUP) == before
    left = {label for label, table in made if os.path.exists(table.stage_path.replace("file:", "", 1))}
    assert left == {"sets", "classes", "links"}
