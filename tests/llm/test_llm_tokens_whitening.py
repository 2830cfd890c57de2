"""Prefix counts, alignment of two tokenizers, whitening: against the libraries and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from matchwright.llm import catalog
from matchwright.llm.batches import table
from matchwright.llm.byte_level import letter_bytes, token_bytes
from matchwright.llm.cross_tokens import align_documents, overlaps, piece_bytes, shared_cuts
from matchwright.llm.prefix_counts import (
    PrefixCounter,
    load_merges,
    longest_prefix,
    n_tokens,
    prefix_counts,
    tokens_between,
)
from matchwright.llm.whitening import (
    components,
    fit_whitening,
    integer_vectors,
    orthogonal_columns,
    pivoted_cholesky,
    whiten,
)

SF_DIR = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BITS = (
    "foo don't 's 'll ' a aaaa Hello 1234 ½ !! ; </s> <0x41> <|endoftext|> <|endof é 日本語 ՘ 😀"
    " ---- x\x00y ▁ an an. an,".split(" ")
    + [" ", "  ", "\n", "\n\n", "\t", "\r", "\r\n", " ;\r", "　", " 　", "\x85", "\x1c", "    "]
)


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 10))) for _ in range(n)]


def tables(spark, texts):
    rows = [(i, t, "z", 1) for i, t in enumerate(texts)]
    rows += [(None, "null key", "z", 1), (3, texts[3], "z", 1), (3, texts[3], "z", 1), (9999, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, slice int").repartition(3)


# --- prefix counts -----------------------------------------------------------------------


def test_every_prefix_has_the_librarys_count():
    library, counter = Tokenizer.from_file(BYTES), PrefixCounter(BYTES)
    texts = odd_texts(400, 5)
    counts, starts = counter.counts(texts)
    for k, text in enumerate(texts):
        want = [len(library.encode(text[: i + 1], add_special_tokens=False).ids) for i in range(len(text))]
        assert counts[starts[k] : starts[k + 1]].tolist() == want, text


def test_counts_of_tokens_in_any_order():
    library, counter = Tokenizer.from_file(BYTES), PrefixCounter(BYTES)
    rng = random.Random(2)
    texts = [library.decode([rng.randrange(50256) for _ in range(rng.randint(1, 5))]) for _ in range(2000)]
    counts, starts = counter.counts(texts)
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert (int(counts[starts[k + 1] - 1]) if texts[k] else 0) == len(e.ids)


def test_neighbours_keep_their_place_just_if_their_bytes_encode_so():
    merges, library = load_merges(BYTES), Tokenizer.from_file(BYTES)
    letters, rng = letter_bytes(), random.Random(4)
    vocabulary = {token_bytes(t, letters): i for t, i in library.get_vocab(with_added_tokens=False).items()}
    plain = [t for t in vocabulary if t.isalpha() and t.isascii()]
    ranks = {t: i for t, i in zip(vocabulary, vocabulary.values()) if len(t) > 1}
    for _ in range(2000):
        left, right = rng.sample(plain, 2)
        if left in ranks and right in ranks:
            got = library.encode((left + right).decode(), add_special_tokens=False).ids
            assert merges.keeps(ranks[left], ranks[right]) == (got == [ranks[left], ranks[right]])


def test_prefix_counts_of_awkward_tables(spark):
    texts = [*odd_texts(40, 6), "word " * 60_000, "\n" * 3000, "x" * 20_000]
    df = tables(spark, texts)
    library = Tokenizer.from_file(BYTES)
    found = prefix_counts(df, BYTES)
    rows = found.select("doc_id", "n_bytes", F.size("counts").alias("size"), n_tokens().alias("n")).collect()
    assert len(rows) == df.count()
    for r in rows:
        text = "null key" if r.doc_id is None else "" if r.doc_id == 9999 else texts[r.doc_id]
        assert (r.n_bytes, r.size) == (len(text.encode()), len(text))
        assert r.n == len(library.encode(text, add_special_tokens=False).ids)
    assert prefix_counts(df.limit(0), BYTES).count() == 0


def test_truncation_and_budget_need_no_encoding(spark):
    texts = odd_texts(40, 7)
    library = Tokenizer.from_file(BYTES)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = prefix_counts(df, BYTES).select(
        "doc_id",
        longest_prefix(5).alias("chars"),
        tokens_between(F.lit(2), F.lit(6)).alias("between"),
    )
    for r in cut.collect():
        text = texts[r.doc_id]
        size = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert r.chars == max(i for i, n in enumerate(size) if n <= 5)
        assert r.between == (size[6] - size[2] if len(text) >= 6 else None)


def test_op11_counts_like_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    got = {r.doc_id: r for r in catalog.op11_token_counts(spark, SF_DIR).collect()}
    docs = table(spark, SF_DIR, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), n, n > 512)


# --- alignment ---------------------------------------------------------------------------


def test_groups_are_the_shared_ends():
    rng = random.Random(1)
    ends_a, ends_b, parts_a, parts_b, done = [], [], [], [], 0
    for _ in range(500):  # intervals of one row of bytes
        size = rng.randint(1, 40)
        for ends, parts in ((ends_a, parts_a), (ends_b, parts_b)):
            own = sorted({*rng.sample(range(1, size + 1), rng.randint(0, size)), size})
            ends += [done + e for e in own]
            parts.append(len(ends))
        done += size
    a, b = np.array(ends_a), np.array(ends_b)
    shared = set(ends_a) & set(ends_b)
    for parts in ((parts_a, parts_b), ([len(a)], [len(b)])):
        cut_a, cut_b = shared_cuts(a, b, *map(np.array, parts))
        assert [x in shared for x in ends_a] == cut_a.tolist()
        assert [x in shared for x in ends_b] == cut_b.tolist()
    got = set(zip(*(x.tolist() for x in overlaps(a, b))))
    spans = [list(zip([0, *x], x)) for x in (ends_a, ends_b)]
    want = {(i, j) for i, p in enumerate(spans[0]) for j, q in enumerate(spans[1]) if p[0] < q[1] and q[0] < p[1]}
    assert got == want


def brute_alignment(rows):
    a_tok, b_tok = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a_tok.encode_special_tokens = True
    letters = letter_bytes()
    names = {i: token_bytes(t, letters) for t, i in a_tok.get_vocab(with_added_tokens=False).items()}
    found = []
    for _, text in rows:
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_tok.encode(text or "")
        raw_a, raw_b = [names[i] for i in a], [piece_bytes(b_tok.id_to_piece(i)) for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            found.append(None)
            continue
        ends = [np.cumsum(list(map(len, raw))).tolist() for raw in (raw_a, raw_b)]
        groups, i0, j0 = [], 0, 0
        for c in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0].index(c) + 1, ends[1].index(c) + 1
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            i0, j0 = i, j
        starts = [[0, *e] for e in ends]
        links = [
            (a[i], b[j])
            for i in range(len(a))
            for j in range(len(b))
            if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
        ]
        found.append((len(a), len(b), groups, links))
    held = Counter(p for f in found if f for p in set(f[3]))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (key, _), f in zip(rows, found):
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = f
            scores = sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links)
            out.append((key, a, b, len(groups), len(links), *scores, ";".join(groups)))
    return out


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_alignment_of_awkward_tables(spark):
    texts = [*odd_texts(120, 8), "x" * 3000, "one two " * 300, " ", "  "]
    df = tables(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = by_key(brute_alignment(rows))
    assert by_key(map(tuple, align_documents(df, BYTES, PIECES).collect())) == want
    digests = by_key(map(tuple, align_documents(df, BYTES, PIECES, with_groups=False).collect()))
    for w, d in zip(want, digests):
        assert d[-1] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "")
    assert any(w[1] == 0 and w[0] not in (None, 9999) and texts[w[0]] for w in want)
    assert align_documents(df.limit(0), BYTES, PIECES).count() == 0


def test_op13_over_a_whole_table(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").where("length(text) < 3000 OR text IS NULL")
    want = by_key(brute_alignment([tuple(r) for r in docs.collect()]))
    assert by_key(map(tuple, align_documents(docs, BYTES, PIECES).collect())) == want
    query = catalog.op13_cross_tokenizer(spark, SF_DIR)
    assert query.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert query.count() == table(spark, SF_DIR, "documents").count()


# --- whitening ---------------------------------------------------------------------------


@pytest.mark.parametrize("size,rank", [(1, 1), (2, 2), (7, 7), (12, 5), (33, 33)])
def test_cholesky_and_jacobi(size, rank):
    rng = np.random.default_rng(size)
    half = rng.normal(size=(size, rank))
    a = half @ half.T
    factor, order = pivoted_cholesky(a)
    assert factor.shape == (size, rank)
    assert np.allclose(np.triu(factor[:rank], 1), 0)
    assert np.allclose(factor @ factor.T, a[order][:, order])
    turned = orthogonal_columns(factor)
    assert np.allclose(turned @ turned.T, factor @ factor.T)
    off = turned.T @ turned
    assert np.abs(off - np.diag(off.diagonal())).max() < 1e-12 * off.max()
    values, vectors = components(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9)
    assert np.allclose(a @ vectors, vectors * values) and np.allclose(vectors.T @ vectors, np.eye(rank))


def vectors_frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.selectExpr("*", "'z' AS x", "1 AS size", "2 AS n").repartition(3)


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    copies = [(1000 + i, rows[7][1]) for i in range(150)]
    odd = [(None, rows[0][1]), (2000, None), (2001, [None] * 20), (2002, [float("nan")] * 20)]
    odd += [(2003, [float("inf")] * 20), (2004, [1.0, 2.0]), (2005, []), (5, rows[5][1])]
    df = vectors_frame(spark, rows + copies + odd)
    kept = [(k, v) for k, v in rows + copies + odd if v and len(v) == 20 and None not in v and np.isfinite(v).all()]
    x = {k: np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000 for k, v in kept}
    fit = np.unique(list(x.values()), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    scatter = centred.T @ centred / n
    values, axes = np.linalg.eigh(scatter)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    got = whiten(df).collect()
    assert len(got) == 16 * len(kept)
    sign = {}
    for r in got:
        own = x[r.vec_id]
        assert r.n == n and int(r.deviation) == int(((n * own - total) ** 2).sum())
        want = (own - total / n) @ axes[:, r.component - 1] / np.sqrt(values[r.component - 1])
        s = sign.setdefault(r.component, np.sign(r.whitened * want))
        assert abs(r.whitened - s * want) < 1e-8
        assert abs(r.explained / (values[r.component - 1] / scatter.trace()) - 1) < 1e-9
        assert r.identity_error < 1e-9


def test_whitening_of_awkward_tables(spark):
    empty = vectors_frame(spark, [(1, [1.0, 2.0])]).limit(0)
    assert whiten(empty).count() == 0 and whiten(empty).columns[0] == "vec_id"
    assert whiten(vectors_frame(spark, [(1, None), (2, [])])).count() == 0
    # one distinct vector has no component; two have one; a constant dimension adds none
    assert whiten(vectors_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whiten(vectors_frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9))) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]
    assert [r.explained for r in two] == [1.0, 1.0]
    # far from zero: sums past a long, deviations past a long
    far = [(i, [1e15 + 1e6 * i, -1e15 * (i % 3)]) for i in range(40)]
    rows = whiten(vectors_frame(spark, far)).collect()
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in far], object)
    total = x.sum(axis=0)
    for r in rows:
        assert int(r.deviation) == sum((40 * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], total))
    with pytest.raises(Exception, match="too large"):
        whiten(vectors_frame(spark, [(1, [1e300]), (2, [2.0])])).count()


def test_equal_eigenvalues_have_one_basis(spark):
    corners = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2)]) for i in range(8)]
    fit = fit_whitening(integer_vectors(vectors_frame(spark, corners), "vec_id", "embedding"))
    assert np.allclose(fit.eigenvalues, fit.eigenvalues[0])
    assert fit.identity_error < 1e-12 and np.allclose(fit.explained, 1 / 3)


def test_op12_over_a_whole_table(spark):
    got = catalog.op12_embedding_whitening(spark, SF_DIR)
    assert dict(got.dtypes)["deviation"] == "bigint"
    assert got.count() == 16 * table(spark, SF_DIR, "embeddings").count()
