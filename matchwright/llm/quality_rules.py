"""Quality rules: counts of words, lines and symbols, and a likelihood ratio.

Two multinomials over hashed byte n-grams are counted on all data: one of the
trusted texts, one of the raw corpus. A text's score is the mean over its
n-grams of the logarithm of their ratio, so length does not move it. Weights
are rounded to fixed point and summed as integers: a text's score, and its
side of the threshold, do not depend on what is read beside it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import gram_codes, map_slices, utf8

GRAM = 3
BITS = 14
FIXED = 1 << 20
# nats per n-gram below which a text is unlike the trusted ones
THRESHOLD = -0.3
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CHAR = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def labelled_good(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Keys that every label of theirs calls good."""
    worst = labels.groupBy(key).agg(F.min(label).alias("worst"))
    return worst.where("worst = 1").select(key)


def gram_counts(marked: DataFrame) -> DataFrame:
    """(bucket, raw, target) summed over (text, trusted); combined per task."""

    def run(batches):
        raw = np.zeros(1 << BITS, np.int64)
        target = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            codes, starts = gram_codes(batch.column("text").to_pylist(), GRAM, BITS)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            raw += np.bincount(codes, minlength=1 << BITS)
            target += np.bincount(codes[np.repeat(trusted, np.diff(starts))], minlength=1 << BITS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
            ["bucket", "raw", "target"],
        )

    counts = marked.mapInArrow(run, "bucket long, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def ratio_weights(docs: DataFrame, trusted: DataFrame, key: str, text: str) -> np.ndarray:
    """Fixed-point log ratio per bucket; ``trusted`` holds keys.

    Counts cover all of ``docs``. 2^BITS rows reach the driver at most. Without
    trusted texts all weights are zero.
    """
    ids = trusted.select(F.col(key).alias("key")).na.drop().distinct()
    marked = (
        docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
        # both sides grow with the corpus: shuffled at every size
        .join(ids.withColumn("trusted", F.lit(True)).hint("merge"), "key", "left")
        .select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    )
    found = gram_counts(marked).toPandas()
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    raw[found.bucket], target[found.bucket] = found.raw, found.target
    if not target.any():
        return np.zeros(1 << BITS, np.int64)

    def logs(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + 1) / (counts.sum() + len(counts)))

    return np.rint((logs(target) - logs(raw)) * FIXED).astype(np.int64)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, the runs given by their ends."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends]
    return np.diff(total, prepend=0)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that are found twice or more, compared exactly."""
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    times = Counter(windows)
    cover = np.zeros(len(words) + 1, np.int64)
    for at, window in enumerate(windows):
        if times[window] > 1:
            cover[at] += 1
            cover[at + WINDOW] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _maybe_repeating(words: list[list[bytes]]) -> np.ndarray:
    """Indices of texts that may repeat a window: all that do, by hashes."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    hashes = np.fromiter((hash(w) for ws in words for w in ws), np.int64, sizes.sum())
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    mixed = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    code = owner[:n].astype(np.uint64)
    for k in range(WINDOW):
        code = (code ^ mixed[k : n + k]) * np.uint64(0xD6E8FEB86659FD93)
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    code = code[inside]
    order = np.argsort(code)
    same = code[order[1:]] == code[order[:-1]]
    return np.unique(owner[inside[order[1:][same]]])


def rule_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of every whole text, by column name."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    words = [text.split() for text in texts]
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    repeats = np.zeros(len(texts), np.int64)
    for i in _maybe_repeating(words):
        repeats[i] = repeated_words(words[i])
    return {
        "n_words": np.fromiter(map(len, words), np.int64, len(texts)),
        "word_chars": _sums(_CHAR[joined] & ~_BLANK[joined], ends),
        "n_symbols": _sums(_SYMBOL[joined], ends),
        "n_dup_lines": np.fromiter((len(x) - len(set(x)) for x in lines), np.int64, len(texts)),
        "n_repeat_words": repeats,
    }


def judge(texts: list[bytes], weights: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    """Counts, mean log ratio and verdicts of whole texts."""
    found = rule_counts(texts)
    codes, starts = gram_codes(texts, GRAM, BITS)
    total = _sums(weights[codes], starts[1:])
    grams = np.diff(starts)
    found["log_ratio"] = total / FIXED / np.maximum(grams, 1)
    n_words = found["n_words"]
    found["base_failed"] = (n_words < MIN_WORDS) | (
        100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words
    )
    below = total < np.rint(threshold * FIXED).astype(np.int64) * grams
    found["kept"] = ~found["base_failed"] & ~below
    return found


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " log_ratio double, base_failed boolean, kept boolean"
)
_NAMES = [part.split()[0] for part in RESULT.split(", ")]


def apply_rules(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, counts, log_ratio, base_failed, kept), one row per row of ``docs``.

    Null and empty texts have no words and fail; null keys are never trusted;
    repeated rows are counted and judged each; very long texts are read whole;
    other columns are dropped; an empty table gives an empty one.
    """
    weights = ratio_weights(docs, trusted, key, text)
    spread = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = judge(batch.column("text").to_pylist(), weights, threshold)
            return pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(found[n]) for n in _NAMES)], ["key", *_NAMES]
            )

        return work

    kind = spread.schema["key"].dataType.simpleString()
    return map_slices(spread, "text", f"key {kind}, {RESULT}", make).withColumnRenamed("key", key)


def keep_by_rules(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``apply_rules`` keeps."""
    weights = ratio_weights(docs, trusted, key, text)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
            return batch.filter(pa.array(judge(texts, weights, threshold)["kept"]))

        return work

    return map_slices(docs, text, docs.schema, make)
