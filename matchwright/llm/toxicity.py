"""Toxicity by a subsequence string kernel.

The kernel counts common subsequences of three letters, each weighted by
``DECAY`` to the power of the stretch it spans, so that gaps and inserted
characters lower the likeness of two strings but do not end it. A support
vector machine is trained on Nyström features: kernel values against landmark
strings, whitened by the landmarks' own kernel.

What the labels mark is found first: strings of labelled sentences that go
with toxic documents beyond chance, near copies counted once. A document
scores by the margins of its most toxic strings and its length.

A trained machine is linear in the kernel's own feature space, so landmarks
and weights are folded into one weight per subsequence; scoring a string is
exact under the kernel and does not depend on the number of landmarks.
"""

from __future__ import annotations

import gc
import re
from collections import Counter
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8
from matchwright.sources.staging import stage_table

DECAY = 0.7
#: a to z, the start of a word, and classes of all other letters.
ALPHABET = 40
LANDMARKS = 128
#: Labelled rows that train the machine, at most: those of the least hashed key.
TRAINED = 20_000
#: Rows of one label are near copies from this share of common words on.
COPY = 0.8
#: Bands of minima that find them.
BANDS, MINIMA = 10, 3
#: Strings that train it, at most, of either kind.
STRINGS = 4_000
PIECE, STEP = 21, 10
#: Strings of a document that count as evidence.
TOP = 3
CACHED = 400_000
PREDICTED_FROM = 0.7
_SPACED = re.compile(r"(?<!\S)\S(?:[ .*_-]\S(?!\S)){2,}")


def letters(word: str) -> str:
    """A mark of the start, and a lower-case word's letters and digits."""
    return "^" + (word if word.isalnum() else "".join(filter(str.isalnum, word)))


def strings_of(text: str) -> list[str]:
    """Lower-case strings of a text; letters spaced out are joined as well."""
    low = text.lower()
    found = low.split()
    if " " in low:
        found += [m.replace(" ", "") for m in _SPACED.findall(low)]
    return found


def codes(words: list[str]) -> np.ndarray:
    """Letters of equally long words as numbers below ``ALPHABET``."""
    points = np.array([[ord(c) for c in w] for w in words], np.int64)
    rest = np.where(points == ord("^"), 26, 27 + points % (ALPHABET - 27))
    return np.where((points >= 97) & (points <= 122), points - 97, rest)


@lru_cache(maxsize=64)
def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3).T
    return at, DECAY ** (at[2] - at[0] + 1.0)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers of equally long words, and their weights."""
    at, weight = _places(len(words[0]))
    c = codes(words)
    return (c[:, at[0]] * ALPHABET + c[:, at[1]]) * ALPHABET + c[:, at[2]], weight


def self_kernel(words: list[str]) -> np.ndarray:
    """Kernel of each of equally long words with itself."""
    c = codes(words)
    n = c.shape[1]
    same = c[:, :, None] == c[:, None, :]
    below = np.ones((n + 1, n + 1, len(words)))
    for _ in range(2):
        level = np.zeros_like(below)
        for a in range(1, n + 1):
            run = np.zeros(len(words))
            for b in range(1, n + 1):
                run = DECAY * run + DECAY**2 * same[:, a - 1, b - 1] * below[a - 1, b - 1]
                level[a, b] = DECAY * level[a - 1, b] + run
        below = level
    return DECAY**2 * np.einsum("wab,abw->w", same, below[:n, :n])


def by_length(words: list[str]) -> dict[int, list[int]]:
    """Places of words of three letters and more, by their length."""
    out: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if len(word) >= 3:
            out.setdefault(len(word), []).append(i)
    return out


def explicit(words: list[str]) -> np.ndarray:
    """Unit vectors of words in the kernel's feature space (few words only)."""
    out = np.zeros((len(words), ALPHABET**3), np.float32)
    for places in by_length(words).values():
        index, weight = subsequences([words[i] for i in places])
        for i, row in zip(places, index):
            np.add.at(out[i], row, weight)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def applied(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Normalised kernel expansion of each word: one column per column of ``weights``."""
    out = np.zeros((len(words), weights.shape[1]))
    for n, places in by_length(words).items():
        step = max(1, 2_000_000 // (len(_places(n)[1]) * weights.shape[1]))
        for start in range(0, len(places), step):
            part = places[start : start + step]
            own = [words[i] for i in part]
            index, weight = subsequences(own)
            value = np.einsum("wsk,s->wk", weights[index], weight)
            out[part] = value / np.sqrt(self_kernel(own))[:, None]
    return out


def pieces(word: str) -> list[str]:
    """A word, or overlapping pieces of a long one."""
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - STEP, STEP)]


class Model:
    """Folded machine and the map from its margin to a probability."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32).reshape(-1, 1), bias
        self.evidence = np.array([2.0, 1.0, 0.5, 0.0, 0.0])

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each string, the largest of its pieces."""
        clean = [letters(w) for w in words]
        cut = [pieces(w) for w in clean]
        flat = [p for ps in cut for p in ps]
        value = applied(flat, self.weights)[:, 0] + self.bias
        if len(flat) == len(words):
            return value
        ends = np.cumsum([len(ps) for ps in cut])
        return np.maximum.reduceat(value, ends - [len(ps) for ps in cut])


def train_machine(toxic: list[str], clean: list[str]) -> Model:
    """Squared-hinge machine on Nyström features of the strings."""
    landmarks = toxic[: LANDMARKS * 3 // 4]
    landmarks += clean[: LANDMARKS - len(landmarks)]
    basis = explicit(landmarks)
    own = (basis @ basis.T).astype(np.float64)
    value, vector = np.linalg.eigh(own)
    used = value > 1e-4
    whiten = vector[:, used] / np.sqrt(value[used])
    folded = basis.T @ whiten.astype(np.float32)
    strings = toxic + clean
    x = np.hstack([applied(strings, folded), np.ones((len(strings), 1))])
    y = np.repeat([1.0, -1.0], [len(toxic), len(clean)])
    cost = np.where(y > 0, 1 / len(toxic), 2 / len(clean))
    w = np.zeros(x.shape[1])
    for _ in range(40):  # Newton steps over the strings inside the margin
        inside = y * (x @ w) < 1
        xs, cs = x[inside], cost[inside]
        hessian = (xs * cs[:, None]).T @ xs + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(hessian, xs.T @ (cs * y[inside])) - w
        if np.abs(step).max() < 1e-6:
            break
        w += step
    return Model(folded @ w[:-1].astype(np.float32), float(w[-1]))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(toxic, text) of at most ``TRAINED`` labelled rows, near copies once."""
    chosen = (
        labels.select(F.col(key).alias("key"), F.col(label).alias("label"))
        .na.drop()
        .groupBy("key")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(TRAINED)
    )
    rows = (
        docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
        .join(F.broadcast(chosen), "key")
        .select((F.col("label") == 1).alias("toxic"), "text")
    )

    return _without_near_copies(rows.distinct().withColumn("id", F.xxhash64("text")))


def _without_near_copies(rows: DataFrame) -> DataFrame:
    """(toxic, text) of (toxic, text, id), bounded, without later near copies.

    A row goes if a row of its label that stays has ``COPY`` of their words in
    common. Minima of hashed words in bands name the pairs to compare; the
    whole sets of words decide.
    """

    def make():
        salts = np.random.default_rng(7).integers(1 << 62, size=BANDS * MINIMA, dtype=np.uint64)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, bands = [], []
            for text in batch.column("text").to_pylist():
                own = np.array([xxhash.xxh64_intdigest(w) for w in set(text.split())] or [0], np.uint64)
                least = np.full(len(salts), ~np.uint64(0))
                for start in range(0, len(own), 4096):
                    mixed = (own[start : start + 4096, None] ^ salts) * np.uint64(0x9E3779B97F4A7C15)
                    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
                    least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0))
                words.append(own.view(np.int64))
                bands.append([
                    f"{k}:{xxhash.xxh64_intdigest(band.tobytes())}"
                    for k, band in enumerate(least.reshape(BANDS, MINIMA))
                ])
            kinds = (pa.list_(pa.int64()), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("toxic", "text", "id")),
                    *(pa.array(c, kind) for c, kind in zip((words, bands), kinds)),
                ],
                ["toxic", "text", "id", "words", "bands"],
            )

        return work

    schema = "toxic boolean, text binary, id long, words array<long>, bands array<string>"
    marked = stage_table(map_slices(rows, "text", schema, make), "labelled")
    met = marked.select("toxic", "id", F.explode("bands").alias("band"))
    least = met.groupBy("toxic", "band").agg(F.min("id").alias("one"))
    pairs = met.join(F.broadcast(least), ["toxic", "band"]).where("id <> one")
    pairs = pairs.select("toxic", "one", "id").distinct()
    one = marked.select("toxic", F.col("id").alias("one"), F.col("words").alias("one_words"))
    both = pairs.join(marked.select("toxic", "id", "words").hint("merge"), ["toxic", "id"]).join(
        one.hint("merge"), ["toxic", "one"]
    )
    common = "size(array_intersect(words, one_words))"
    near = both.where(f"{common} >= {COPY}D * (size(words) + size(one_words) - {common})")
    gone: set[tuple[bool, int]] = set()
    for r in sorted(near.select("toxic", "id", "one").collect()):  # least ids first
        if (r.toxic, r.one) not in gone:
            gone.add((r.toxic, r.id))
    kind = "toxic boolean, id long"
    left = rows.sparkSession.createDataFrame(sorted(gone), kind)
    return marked.join(F.broadcast(left), ["toxic", "id"], "left_anti").select("toxic", "text")


def string_counts(sample: DataFrame) -> DataFrame:
    """(word, n_toxic, n_clean): documents of the sample that hold a string."""

    def run(batches):
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "text"))):
                found = {letters(s) for s in strings_of(text.decode("utf-8", "replace"))}
                seen[not toxic].update(w for w in found if 3 <= len(w) <= PIECE)
        words = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.string()),
                *(pa.array([s[w] for w in words], pa.int64()) for s in seen),
            ],
            ["word", "n_toxic", "n_clean"],
        )

    counts = sample.mapInArrow(run, "word string, n_toxic long, n_clean long")
    return counts.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n_toxic", "n_clean")))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model | None:
    """The trained machine; None where no labels of both kinds teach anything."""
    sample = _sample(docs, labels, key, text, label).repartition(8).cache()
    try:
        sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
        if len(sizes) < 2:
            return None
        share = sizes[True] / (sizes[True] + sizes[False])
        counts = string_counts(sample).withColumn(
            "gain", F.expr(f"n_toxic * ln(n_toxic / ((n_toxic + n_clean) * {share}D))")
        )
        marked = counts.where("n_toxic >= 4 AND n_toxic >= 9 * n_clean AND gain > 9")
        toxic = [r.word for r in marked.orderBy(F.desc("gain"), "word").limit(STRINGS).collect()]
        if not toxic:
            return None
        other = counts.where("n_clean >= 1 AND n_toxic <= 2 * n_clean")
        common = other.orderBy(F.desc("n_clean"), "word").limit(STRINGS)
        any_ = other.orderBy(F.xxhash64("word"), "word").limit(4 * STRINGS)
        clean = [r.word for r in common.unionByName(any_).select("word").distinct().collect()]
        clean = sorted(clean) or ["^aaa"]
        rng = np.random.default_rng(5)
        clean = [clean[i] for i in rng.permutation(len(clean))]
        model = train_machine(toxic, clean)
        _calibrate(model, sample)
        return model
    finally:
        sample.unpersist()


def _evidence(top: list, n_words: np.ndarray) -> np.ndarray:
    """Top margins, the logarithm of the length, and one."""
    return np.column_stack([np.array(top).reshape(-1, TOP), np.log1p(n_words), np.ones(len(top))])


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Logistic map of the sample's evidence to its labels (smoothed)."""
    found = document_margins(sample, model, ["toxic"]).toPandas()
    y = found.toxic.to_numpy(bool)
    x = _evidence(found.top.tolist(), found.n_words.to_numpy())
    goal = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - goal) + 0.1 * w)
    if np.isfinite(w).all():
        model.evidence = w


def document_margins(df: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, the largest margins of each row's ``text`` (binary)
    over its different strings, and the number of those."""

    def make():
        known: dict[str, float] = {}
        gc.disable()  # many short-lived lists, no cycles
        none = [model.bias] * TOP

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            found = [set(strings_of(t.decode("utf-8", "replace"))) for t in texts]
            fresh = list(set().union(*found).difference(known))
            known.update(zip(fresh, model.margins(fresh).tolist()))
            get = known.__getitem__
            top = [sorted([*map(get, words), *none], reverse=True)[:TOP] for words in found]
            if len(known) > CACHED:  # what came first is commonest and stays
                for word in fresh:
                    del known[word]
            columns = [
                *(batch.column(c) for c in keep),
                pa.array(top, pa.list_(pa.float64())),
                pa.array(list(map(len, found)), pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, [*keep, "top", "n_words"])

        return work

    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, "top array<double>, n_words long"])
    return map_slices(df.select(*keep, "text"), "text", schema, make)


def score_toxicity(
    docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score, predicted), one row per row of ``docs``.

    Null and empty texts score as a string without subsequences; null keys and
    repeated rows are rows like any other; words of any length are read whole,
    in overlapping pieces; other columns are dropped; an empty table gives an
    empty one. Without a model every score is 0.
    """
    if model is None:
        return docs.select(key, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    spread = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
    margins = document_margins(spread, model, ["key"])
    *by_rank, by_length, shift = map(float, model.evidence)
    odds = F.log1p("n_words") * by_length + shift
    for rank, weight in enumerate(by_rank):
        odds = odds + F.col("top")[rank] * weight
    score = F.lit(1.0) / (1 + F.exp(-odds))
    return margins.select(F.col("key").alias(key), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= PREDICTED_FROM).cast("int")
    )
