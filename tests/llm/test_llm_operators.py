"""Operators on training data against brute force, and on awkward tables."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from matchwright.llm import html_text, toxicity
from matchwright.llm.byte_bpe import encode_texts
from matchwright.llm.chat import chat_windows, read_windows
from matchwright.llm.components import smallest_reachable
from matchwright.llm.near_join import NearJoin, PartEnum, Shingler, near_components, sketch
from matchwright.llm.packing import BITS, DIMS, cut_pieces, hilbert_keys, pack_documents
from matchwright.llm.quality_classifier import classify, keep_good
from matchwright.llm.quality_rules import apply_rules, keep_by_rules, rule_counts
from matchwright.llm.substrings import remove_repeats, without_repeats
from matchwright.llm.topk import top_products

SYLLABLES = "an be ci do fu ga he il ko lu ma ne or pi ra su te um vo we".split()


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def corpus():
    """(doc_id, text): copies, near copies, shared passages, empty and null texts."""
    rng = random.Random(3)
    passage = words(rng, 60)
    docs = []
    for i in range(60):
        own = words(rng, rng.randint(0, 160))
        if i % 4 == 0:
            at = rng.randint(0, len(own))
            own[at:at] = passage[rng.randint(0, 5) :]
        docs.append(own)
    for i in range(20):
        near = docs[i][:]
        if near:
            near[rng.randrange(len(near))] = "changed"
        docs.append(near)
    docs += [docs[3][:], docs[3][:], words(rng, 3), words(rng, 12), words(rng, 13), ["a"] * 500]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    rows = [(i, rng.choice([" ", "  ", "\n"]).join(d)) for i, d in zip(ids, docs)]
    return [*rows, (1000, ""), (1001, None), (1002, " \t\n"), (1003, "Ünï cödé " * 30)]


CLASHING = (
    "doc_id long, text string, key string, h string, n string, class string, kept string,"
    " score string, anchor string, curve string, lang string, n_chars long"
)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *"abcdefghi", len(t or "")) for i, t in corpus()]
    return spark.createDataFrame(rows, CLASHING).repartition(3).cache()


@pytest.fixture(scope="module")
def awkward(docs):
    """Repeated rows and rows without a key as well."""
    one = docs.where("doc_id IN (5, 1000, 1001)")
    return docs.union(one).union(docs.where("doc_id = 7").selectExpr("CAST(NULL AS LONG)", *docs.columns[1:]))


def split(text):
    return (text or "").encode().split()


# --- chat ----------------------------------------------------------------------------


def test_chat_windows_read_back(spark):
    rng = random.Random(1)
    marks = ["<|im_end|>", "<|im_start|>user", "<\\|x", "<\\\\|", "|>", "é", "\n"]
    rows = []
    for c in range(12):
        for t in range(rng.randint(1, 30)):
            role = "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, " ".join(rng.choices(marks + SYLLABLES, k=rng.randint(0, 40)))))
    rows += [(20, 0, None, None), (20, 0, "assistant", None), (None, 1, "a%\nb<|", "x"), (21, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS window", "'z' AS tokens")
    windows = chat_windows(df, budget=60, history=20)
    got = {r.conv_id: r for r in read_windows(windows).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = sorted(turns)
        assert got[c].turns == "".join(f"{r}\n{x}\n" for _, r, x in turns)
        assert got[c].loss == "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
    for w in windows.collect():
        if w.n_tokens > 60:  # beside what is repeated, one turn longer than what is left
            system = w.window == 0 and w.formatted.startswith("<|im_start|>system\n")
            assert w.n_turns - w.n_repeated - system == 1
    assert read_windows(chat_windows(df.limit(0))).count() == 0


# --- rules and classifier ----------------------------------------------------------------


def brute_counts(text):
    ws = (text or "").encode().split()
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    cover = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return (
        len(ws),
        sum(len(w.decode()) for w in ws),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(cover),
    )


def test_rule_counts(spark, awkward):
    got = apply_rules(awkward, awkward.where("doc_id < 20").select("doc_id")).collect()
    texts = dict(corpus())
    assert len(got) == awkward.count()
    for r in got:
        text = texts[7 if r.doc_id is None else r.doc_id]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute_counts(text)
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r.base_failed and r.kept)
    text = "a b c d e f g h i\n" * 3 + "# $\n\nx\nx"
    found = rule_counts([text.encode(), b""])
    assert tuple(int(v[0]) for v in found.values()) == brute_counts(text)


def test_rules_and_classifier_drop_junk_and_keep_prose(spark):
    rng = random.Random(8)
    prose = [" ".join(words(rng, 60)).capitalize() + ". " + " ".join(words(rng, 40)) + "." for _ in range(150)]
    junk = [" ".join(w + rng.choice(["%%%", "$$$", "&&&", "###"]) for w in words(rng, 80)) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(prose + junk)), "doc_id long, text string")
    trusted = df.where("doc_id < 70").select("doc_id")
    kept = {r.doc_id for r in keep_by_rules(df, trusted).collect()}
    assert kept == set(range(150))
    kept = {r.doc_id for r in keep_good(df).collect()}
    assert kept == set(range(150))


def test_classifier_on_awkward_tables(awkward):
    rows = classify(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.25) for r in rows)
    assert classify(awkward.limit(0)).count() == 0
    assert keep_good(awkward).columns == awkward.columns
    assert apply_rules(awkward.limit(0), awkward.select("doc_id")).count() == 0


# --- toxicity ----------------------------------------------------------------------------


def brute_kernel(a, b):
    def weights(s):
        out = defaultdict(float)
        c = toxicity.codes([s])[0]
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, len(s)):
                    out[c[i], c[j], c[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    return sum(v * y[u] for u, v in x.items())


def test_kernel_equals_its_definition():
    ws = ["^abcab", "^aaaaaa", "^xyzzyx"]
    own = toxicity.self_kernel(ws[:1] + ["^idiot"])
    assert np.allclose(own, [brute_kernel(w, w) for w in (ws[0], "^idiot")])
    unit = toxicity.explicit(ws)
    for i, a in enumerate(ws):
        for j, b in enumerate(ws):
            want = brute_kernel(a, b) / np.sqrt(brute_kernel(a, a) * brute_kernel(b, b))
            assert abs(unit[i] @ unit[j] - want) < 1e-4


def test_toxicity_finds_gapped_insults(spark):
    rng = random.Random(4)
    insults = ["blorghead", "snivelrat", "mudbrained"]
    rows = []
    for i in range(600):
        text = words(rng, 40)
        if i % 5 == 0:
            text[rng.randrange(40)] = rng.choice(insults)
            text[rng.randrange(40)] = rng.choice(insults)
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    base = words(rng, 40)
    told = [
        ("plain", base), ("inserted", [*base, "blo-rgh.ead", "mudxbrained"]),
        ("spaced", [*base, *"snivelrat", "blorghead"]), ("empty", []),
    ]
    asked = spark.createDataFrame([(k, " ".join(t)) for k, t in told] + [("null", None)], "doc_id string, text string")
    score = {r.doc_id: r for r in toxicity.score_toxicity(asked, model).collect()}
    assert score["inserted"].score > score["plain"].score and score["spaced"].score > score["plain"].score
    assert score["inserted"].predicted == score["spaced"].predicted == 1
    assert score["plain"].predicted == score["empty"].predicted == score["null"].predicted == 0
    assert toxicity.fit(df.select("doc_id", "text").limit(0), df.select("doc_id", "toxic")) is None
    assert toxicity.score_toxicity(asked, None).count() == 5


# --- products ----------------------------------------------------------------------------


def test_top_products(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in rng.normal(size=40) * rng.choice([0.2, 1, 3])]) for i in range(300)]
    vectors[7] = (7, vectors[20][1])  # ties
    vectors += [vectors[5], (400, None), (401, [1.0, None]), (402, [float("nan")] * 40), (403, [float("inf")] * 40), (None, [1.0] * 40), (404, [2.0] * 3), (405, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "2 AS rank")
    got = defaultdict(list)
    for r in top_products(df, k=5, block=40).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    held = {i: np.floor(64 * np.array([*v, *[0] * (40 - len(v))])).astype(int) for i, v in vectors if i is not None and i not in (400, 401, 402, 403)}
    assert set(got) == {i for i in held if i % 20 == 0}
    for q, rows in got.items():
        best = sorted(((-int(held[q] @ v), i) for i, v in held.items() if i != q))[:5]
        assert sorted(rows) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    few = df.where("vec_id IN (0, 3, 20)").select("vec_id", "embedding")
    assert top_products(few).count() == 4
    assert top_products(df.limit(0)).count() == 0


# --- packing and encoding ------------------------------------------------------------------


def test_hilbert_neighbours_differ_by_one_step():
    cells = np.stack(np.meshgrid(*[np.arange(4)] * 3), axis=-1).reshape(-1, 3)
    keys = hilbert_keys(cells, 2)
    assert sorted(keys) == list(range(64))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert BITS * DIMS < 63


def test_pieces_fill_sequences():
    rows = [("a", np.arange(5000)), ("b", np.arange(1)), ("c", np.arange(1237))]
    pieces = list(cut_pieces(iter(rows), 0, 2048))
    total = defaultdict(int)
    for key, start, part, whole, sequence, offset in pieces:
        assert offset == total[sequence] and len(part)
        total[sequence] += len(part)
    assert all(n & (n - 1) == 0 for n in total.values())
    for key, ids in rows:
        assert np.array_equal(np.concatenate([p[2] for p in pieces if p[0] == key]), ids)


def test_packed_documents(awkward):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = pack_documents(awkward, path).collect()
    lengths = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        lengths[r.sequence_id].append((r.offset, r.length))
    for parts in lengths.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 2048
    texts = dict(corpus())
    for i in (0, 1000, 1001, 1003, 11):
        want = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted((r.start, bytes(r.ids)) for r in rows if r.doc_id == i)
        copies = 2 if i in (1000, 1001) else 1
        assert sum(len(b) for _, b in own) == copies * len(want) * 4
        if copies == 1:
            assert b"".join(b for _, b in own) == want.tobytes()
    assert pack_documents(awkward.limit(0), path).count() == 0


def test_packed_ids_are_the_plain_calls(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    bits = ["a", "<|endoftext|>", "<|startoftext|>", "<|endof", "Ünï", "\u3000", " ", "\n", "!!", "日本"]
    rng = random.Random(9)
    texts = ["a <|endoftext|> b", *("".join(rng.choices(bits, k=rng.randint(1, 9))) for _ in range(200))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(list)
    for r in pack_documents(df, path).collect():
        got[r.doc_id].append((r.start, bytes(r.ids)))
    for i, text in enumerate(texts):
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert b"".join(b for _, b in sorted(got[i])) == want, text


def test_byte_bpe_equals_the_library(spark, awkward):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["  ", "\n\n a  b\t c\x1c d\u0085e  ", "x" * 3000, "ab" * 900, "it's 'll I", "日本語。 تجربة 123", "\x00 é́", "　 a"]
    more = spark.createDataFrame([(2000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    texts = dict(corpus()) | {2000 + i: t for i, t in enumerate(odd)}
    rows = encode_texts(awkward.select("doc_id", "text").union(more), path, public_tokenizers.PATTERN).collect()
    assert len(rows) == awkward.count() + len(odd)
    for r in rows:
        text = texts[7 if r.doc_id is None else r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.ids, r.n_tokens, bytes(r.decoded)) == (",".join(map(str, ids)), len(ids), text.encode())


# --- pages ----------------------------------------------------------------------------------


def test_pages(spark):
    rng = random.Random(5)
    pages = []
    for i in range(40):
        paras = [" ".join(words(rng, 30)).capitalize() + "." for _ in range(rng.randint(2, 6))]
        body = "".join(f"<p>{p} &amp; more\n  text</p>" for p in paras)
        pages.append(
            (i, f"u{i}", f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Home</a><li><a>B</a></ul></nav>"
             f"<div class=\"ad\">Buy this now.</div><article><h1>Title {i}</h1>{body}</article><script>var t='</p>';</script><footer>&copy; x</footer>",
             "\n\n".join([f"Title {i}", *[f"{p} & more text" for p in paras]]))
        )
    df = spark.createDataFrame([*pages, (90, None, None, ""), (91, "u", "", ""), (None, "u", "<p", "")], "page_id long, url string, html string, want string")
    trees = html_text.fit_pages(df)
    got = {r.page_id: r for r in html_text.extract_main(df, trees).collect()}
    assert all(got[i].text == want and got[i].n_chars == len(want) for i, _, _, want in pages)
    assert got[90].text == got[91].text == "" and got[90].n_chars == 0
    bare = pages[0][2].replace("<article>", '<div class="post">').replace("</article>", '</div><div class="comments"><p>I liked this.</p></div>')
    assert html_text.main_texts([bare], trees) == [pages[0][3]]
    assert html_text.extract_main(df.limit(0), None).count() == 0


def test_calls_never_contradict():
    rng = np.random.default_rng(6)
    for _ in range(30):
        parent = [-1] + [int(rng.integers(i)) for i in range(1, 12)]
        odds = rng.normal(size=12) * 3
        found = html_text.decode(parent, odds)
        for i in range(1, 12):
            assert not found[parent[i]] or found[i]


# --- copies ---------------------------------------------------------------------------------


def brute_components(rows, n=4, percent=85):
    sets = {}
    for i, text in rows:
        ws = [w for w in (text or "").encode().lower().split()]
        sets[i] = {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_components(awkward):
    got = near_components(awkward).collect()
    want = brute_components(corpus())
    assert len(got) == awkward.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert near_components(awkward.limit(0)).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(9)
    scheme = PartEnum(85)
    for size in [*range(7, 60), 150, 400, 1500]:
        for _ in range(6):
            base = rng.integers(1 << 63, size=size, dtype=np.uint64)
            drop = int(rng.integers(0, size * 15 // 100 + 1))
            add = int((size - drop) / 0.85 - size) if drop < size * 15 // 200 else 0
            other = np.concatenate([base[drop:], rng.integers(1 << 63, size=max(0, add), dtype=np.uint64)])
            both = size - drop
            if drop + add == 0 or 100 * both < 85 * (size + max(0, add)):
                continue
            a, b = (scheme.signatures(np.unique(s)) for s in (base, other))
            assert np.intersect1d(a, b).size, (size, drop, add)


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(3)
    for size in (0, 1, 40, 900, 5000):
        base = rng.integers(1 << 63, size=size, dtype=np.uint64)
        for drop in (0, size // 20, size // 2):
            other = np.r_[base[drop:], rng.integers(1 << 63, size=drop, dtype=np.uint64)]
            bits = np.unpackbits((sketch(base) ^ sketch(other)).view(np.uint8)).sum()
            assert bits <= 2 * drop
            assert size != 40 or bits >= 2 * drop - 8  # nearly all of them where there is room


def test_copies_just_below_the_limit(spark):
    # 300 copies of 80 words, two of them changed: few links, no crowd of candidates
    rng, words = np.random.default_rng(4), [f"w{i}" for i in range(80)]
    rows = []
    for i in range(300):
        own = list(words)
        for at in rng.choice(80, 2, replace=False):
            own[at] = f"x{rng.integers(10**9)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs).collect()}
    assert got == want
    join = NearJoin(docs, 4, 85, "doc_id", "text")
    none = spark.createDataFrame([], "node long, root long")
    met = join.across(join.mixed(join.members(), none))
    assert join.links(met).count() <= met.count() <= 300


def test_shingles_of_short_texts():
    a, b, c, d = Shingler().sets([b"", b"A b", b"a  B", b"a b c d a b c d"])
    assert len(a) == 0 and len(b) == 1 and (b == c).all() and len(d) == 4


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 300), (300, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in smallest_reachable(df).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {300: 200}
    assert got == want
    assert smallest_reachable(df.limit(0)).count() == 0


def brute_removal(rows):
    first, out = {}, {}
    rows = sorted((i, split(t)) for i, t in rows)
    for i, ws in rows:
        for k in range(len(ws) - 12):
            first.setdefault(tuple(ws[k : k + 13]), i)
    for i, ws in rows:
        gone = {k + j for k in range(len(ws) - 12) if first[tuple(ws[k : k + 13])] < i for j in range(13)}
        out[i] = (len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode())
    return out


def test_removed_passages(awkward):
    got = remove_repeats(awkward).collect()
    want = brute_removal(corpus())
    assert len(got) == awkward.count() and sum(n for _, n, _ in want.values()) > 500
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id]
    assert remove_repeats(awkward.limit(0)).count() == 0


def test_rows_without_repeats_keep_their_columns(docs):
    texts, want = dict(corpus()), brute_removal(corpus())
    out = without_repeats(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        _, removed, kept = want[r.doc_id]
        assert r.text == (kept if removed else texts[r.doc_id])
        assert r.n_chars == len(r.text or "")
        assert hashlib.sha256((r.text or "").encode()).hexdigest()
