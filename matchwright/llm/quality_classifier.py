"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document. The votes are
counted by pattern over the whole corpus, and expectation maximisation on
these counts estimates each labeller's accuracy, with no labels given. Neither
class is taken to be the larger, and labellers are taken to err independently
of each other given the class. The posteriors of a bounded sample then train
a linear scorer on hashed byte n-grams, which scores every document.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import gram_codes, map_slices, utf8

#: The first eight can only call a document bad, the others only good.
LABELLERS = (
    "symbols", "symbol_words", "capitals", "shouts", "repeats", "echoes", "same_lines", "fences",
    "letters", "sentences", "variety",
)
GRAM, BITS = 3, 13
#: Documents that train the scorer, at most: those of the least hashed text.
TRAINED = 3000
KEPT_FROM = 0.25
_SYMBOLS = b"#*$%&|<>"
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)


def votes(texts: list[bytes]) -> np.ndarray:
    """One row per text, one column per labeller: 0 abstain, 1 good, 2 bad."""
    rows = np.zeros((len(texts), 11))
    for i, text in enumerate(texts):
        words = text.split()
        n, size = len(words), max(1, len(text))
        capitals = len(text.translate(None, _NOT_CAPITAL))
        lower = len(text.translate(None, _NOT_LOWER))
        lines = [line for line in text.split(b"\n") if line.strip()]
        rows[i] = (
            n,
            (len(text) - len(text.translate(None, _SYMBOLS))) / size,
            sum(w[-1] in _SYMBOLS for w in words) / max(1, n),
            capitals / max(1, capitals + lower),
            text.count(b"!!") / max(1, n),
            1 - len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 0,
            sum(map(bytes.__eq__, words, words[1:])) / max(1, n - 1),
            1 - len(set(lines)) / max(1, len(lines)),
            words.count(b"|") / max(1, n),
            sum(w[-1] in b".,;:?!" for w in words) / max(1, n),
            len(set(words)) / max(1, n),
        )
    n, symbols, on_words, capitals, shouts, repeats, echoes, lines, fences, marked, kinds = rows.T
    enough = n >= 10
    plain = (symbols < 0.003) & (capitals < 0.15) & (shouts < 0.01)
    flowing = (repeats < 0.1) & (echoes < 0.05)
    bad = [
        symbols > 0.02,
        on_words > 0.2,
        enough & (capitals > 0.5),
        enough & (shouts > 0.2),
        enough & (repeats > 0.4),
        enough & (echoes > 0.2),
        enough & (lines > 0.4),
        fences > 0.1,
    ]
    good = [
        enough & plain & flowing,
        enough & (marked > 0.02) & (marked < 0.5) & (symbols < 0.003) & flowing,
        enough & (kinds > 0.3) & (shouts < 0.01) & flowing & (on_words < 0.05),
    ]
    return np.stack([2 * c for c in bad] + [1 * c for c in good], axis=1).astype(np.int64)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Callable:
    """Fit accuracies by expectation maximisation; returns the posterior of good.

    A labeller that votes is right with its accuracy; abstaining says nothing,
    and neither class is favoured beforehand. Overlapping labellers confirm
    or contradict each other; smoothed counts keep accuracies off 0 and 1.
    """
    good, bad = patterns == 1, patterns == 2
    accuracy = np.full(patterns.shape[1], 0.9)

    def posterior(p: np.ndarray) -> np.ndarray:
        odds = ((p == 1) * 1.0 - (p == 2)) @ (np.log(accuracy) - np.log(1 - accuracy))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    for _ in range(rounds):
        is_good = posterior(patterns)
        right = (counts * is_good) @ good + (counts * (1 - is_good)) @ bad
        accuracy = np.maximum((right + 9) / (counts @ (good | bad) + 10), 0.55)
    return posterior


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of each text and the square roots of their shares."""
    codes, starts = gram_codes(texts, GRAM, BITS)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        counts = np.bincount(codes[a:b], minlength=1 << BITS)
        at = np.flatnonzero(counts)
        out.append((at, np.sqrt(counts[at] / max(1, b - a))))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], goal: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels, classes weighted alike; bias last."""
    dense = np.zeros((len(rows), (1 << BITS) + 1), np.float32)
    for i, (at, x) in enumerate(rows):
        dense[i, at] = x
        dense[i, -1] = 1
    # documents that no labeller speaks for or against teach nothing
    spoken = np.abs(goal - 0.5) > 0.1
    weight = goal / max((goal * spoken).sum(), 1e-9)
    weight = spoken * (weight + (1 - goal) / max(((1 - goal) * spoken).sum(), 1e-9))
    # few bad documents, or none: their side must not outweigh what it holds
    weight = np.minimum(weight, 20 / max(1, len(goal))).astype(np.float32)
    w = np.zeros(dense.shape[1], np.float32)
    velocity = np.zeros_like(w)
    for _ in range(300):
        p = 1 / (1 + np.exp(-(dense @ w)))  # -dense would be a second matrix
        gradient = dense.T @ (weight * (p - goal).astype(np.float32)) + 1e-4 * w
        velocity = 0.9 * velocity - 2.0 * gradient
        w += velocity
    return w.astype(np.float64)


def fit_scorer(docs: DataFrame, text: str) -> np.ndarray:
    """Weights of the scorer, from the corpus alone.

    Vote patterns of all documents reach the driver as counts (3^labellers at
    most); features of the sample, ``TRAINED`` rows at most, reach one task,
    and its weights the driver.
    """
    texts = docs.select(utf8(text).alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cast = votes(batch.column("text").to_pylist())
            code = cast @ 3 ** np.arange(cast.shape[1])
            found, n = np.unique(code, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pattern", "n"])

        return work

    counted = map_slices(texts, "text", "pattern long, n long", make)
    counted = counted.groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    codes = counted.pattern.to_numpy(np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    posterior = estimate(patterns, counted.n.to_numpy(np.float64))

    # hashes first, texts after: the sort carries no texts
    keys = docs.select(F.xxhash64(F.col(text)).alias("h")).where("h IS NOT NULL").distinct()
    chosen = keys.orderBy("h").limit(TRAINED)
    sample = texts.withColumn("h", F.xxhash64(F.col("text").cast("string")))
    sample = sample.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("h", "text")

    def featurise():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = batch.column("text").to_pylist()
            rows = features(raw)
            columns = [
                batch.column("h"),
                pa.array([a.astype(np.int32) for a, _ in rows], pa.list_(pa.int32())),
                pa.array([x.astype(np.float32) for _, x in rows], pa.list_(pa.float32())),
                pa.array(posterior(votes(raw)), pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["h", "at", "x", "good"])

        return work

    kind = "h long, at array<int>, x array<float>, good double"
    rows = map_slices(sample, "text", kind, featurise)
    # the least hash first, so that sums are the same however rows were dealt
    ordered = rows.repartition(1).sortWithinPartitions("h")
    found = ordered.mapInArrow(_trained, "weight array<double>").toArrow()
    if not found.num_rows:
        return np.zeros((1 << BITS) + 1)
    return np.asarray(found["weight"][0].values)


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row, the weights of ``train`` on all rows (at, x, good); none for none."""
    rows, goal = [], []
    for batch in batches:
        rows += [
            (np.asarray(a.values), np.asarray(x.values))
            for a, x in zip(batch.column("at"), batch.column("x"))
        ]
        goal.append(batch.column("good").to_numpy())
    if rows:
        weights = train(rows, np.concatenate(goal))
        # the worker outlives its task
        rows = goal = batch = None
        gc.collect()
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.list_(pa.float64()))], ["weight"])


def scores(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Probability of good for each whole text."""
    return np.array(
        [1 / (1 + np.exp(-(weights[at] @ x + weights[-1]))) for at, x in features(texts)]
    )


def classify(
    docs: DataFrame, kept_from: float = KEPT_FROM, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score, kept), one row per row of ``docs``.

    Null and empty texts have the bias alone for a score; null keys, repeated
    rows and very long texts are rows like any other; other columns are
    dropped. An empty table gives an empty one.
    """
    weights = fit_scorer(docs, text)
    spread = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            score = scores(batch.column("text").to_pylist(), weights)
            columns = [batch.column("key"), pa.array(score), pa.array(score >= kept_from)]
            return pa.RecordBatch.from_arrays(columns, ["key", "score", "kept"])

        return work

    kind = spread.schema["key"].dataType.simpleString()
    schema = f"key {kind}, score double, kept boolean"
    return map_slices(spread, "text", schema, make).withColumnRenamed("key", key)


def keep_good(docs: DataFrame, kept_from: float = KEPT_FROM, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` keeps."""
    weights = fit_scorer(docs, text)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
            return batch.filter(pa.array(scores(texts, weights) >= kept_from))

        return work

    return map_slices(docs, text, docs.schema, make)
