"""Packing: documents into token sequences, neighbours along a Hilbert curve.

A document's tokens are hashed into a count vector, which a fixed projection
takes to a few coordinates; the Hilbert key of their grid cell puts documents
with like words near each other. Rows are range-partitioned and sorted by that
key (and the document's own, so that copies can be split), and each partition
fills its sequences in this order without gaps. What is left at a partition's
end is cut into sequences of powers of two, so nothing is padded at all.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8
from matchwright.sources.staging import stage_table

LENGTH = 2048
HASHED = 1024
DIMS, BITS = 4, 12
CACHED_BYTES = 224 << 20
SEED = 7


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of each row of integer coordinates in [0, 2^bits).

    Skilling's transposition (AIP Conf. Proc. 707, 2004), on all rows at once.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(dims):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    fold = np.zeros_like(x[0])
    q = top
    while q > 1:
        fold ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= fold
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


_NORMAL = np.array([0.5 * (1 + erf(z / 64 / sqrt(2))) for z in range(-256, 257)])


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(HASHED, DIMS))


def curve_keys(rows: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document's hashed and projected token counts."""
    counts = np.zeros((len(rows), HASHED))
    for i, ids in enumerate(rows):
        counts[i] = np.bincount((ids * 40503 >> 6) % HASHED, minlength=HASHED)
    vectors = np.sqrt(counts)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    # rounded, so that a key does not hang on the order of additions
    at = np.rint(vectors @ _projection() * 64).astype(np.int64)
    share = _NORMAL[np.clip(at, -256, 256) + 256]
    return hilbert_keys(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def _plain_parts(word: bytes) -> tuple[bytes, ...]:
    """ASCII letters without case, and the one mark after them."""
    if word.isalpha():
        return (word.lower(),)
    if word[-1:] in b",.;:!?" and word[:-1].isalpha():
        return word[:-1].lower(), word[-1:]
    return (word,)


class WordTokenizer:
    """Ids of texts under a tokenizer that drops white space: word by word.

    Such a tokenizer never joins what white space parts, and no string of an
    added token holds any, so each distinct word is encoded once, as the plain
    call does it. The table of words is kept for the worker's next tasks; its
    bytes are bounded.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.narrow = max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        self.type = np.dtype("<u2" if self.narrow else "<u4")
        self.end = self.type.type(end_id).tobytes()
        self.words: dict[bytes, bytes] = {}
        self.held = 0
        # whether it works on the plain parts of words, as its marks show
        probe = ("Ab,", "ab", ",", "aB!", "!", "ab.", ".", "Ab")
        of = {t: self.tokenizer.encode(t, add_special_tokens=False).ids for t in probe}
        self.folds = of["Ab"] == of["ab"] and all(
            of[t] == of["ab"] + of[t[-1]] for t in ("Ab,", "aB!", "ab.")
        )

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text, the end id last."""
        cut = [text.split() for text in texts]
        fresh = set().union(*cut).difference(self.words)
        # case is dropped, and a mark after letters is a token's start
        plain = {w: _plain_parts(w) for w in fresh} if self.folds else {}
        fresh.update(*plain.values())
        single = list(fresh.difference(w for w, parts in plain.items() if parts != (w,)))
        single = [w for w in single if w not in self.words]
        found = self.tokenizer.encode_batch_fast(
            [w.decode() for w in single], add_special_tokens=False
        )
        ids = [coded.ids for coded in found]
        flat = np.fromiter(chain.from_iterable(ids), self.type).tobytes()
        ends = (np.cumsum(list(map(len, ids))) * self.type.itemsize).tolist()
        fresh = {w for w in fresh if w not in self.words}
        self.words.update((w, flat[a:b]) for w, a, b in zip(single, [0, *ends], ends))
        get = self.words.__getitem__
        for word, parts in plain.items():
            if parts != (word,):
                self.words[word] = b"".join(map(get, parts))
        out = [b"".join(map(get, words)) + self.end for words in cut]
        own = 3 * sum(map(len, fresh)) + 170 * len(fresh)
        if self.held + own > CACHED_BYTES:  # what came first is commonest and stays
            for word in fresh:
                del self.words[word]
        else:
            self.held += own
        return out


@lru_cache(maxsize=1)
def load_words(path: str, end_id: int) -> WordTokenizer:
    """One per worker."""
    return WordTokenizer(path, end_id)


def token_rows(df: DataFrame, path: str, end_id: int, key: str, text: str) -> DataFrame:
    """(key, curve, narrow, ids): whole texts as ids, with the place on the curve."""
    spread = df.select(F.col(key).alias("key"), utf8(text).alias("text"))

    def make():
        tokenizer = load_words(path, end_id)
        gc.disable()  # many short-lived lists, no cycles

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = tokenizer.encode(batch.column("text").to_pylist())
            curve = curve_keys([np.frombuffer(i, tokenizer.type).astype(np.int64) for i in ids])
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(curve, pa.int64()),
                    pa.array([tokenizer.narrow] * len(ids), pa.bool_()),
                    pa.array(ids, pa.binary()),
                ],
                ["key", "curve", "narrow", "ids"],
            )

        return work

    kind = spread.schema["key"].dataType.simpleString()
    return map_slices(
        spread, "text", f"key {kind}, curve long, narrow boolean, ids binary", make
    )


def cut_pieces(
    documents: Iterator[tuple], first_sequence: int, length: int = LENGTH
) -> Iterator[tuple]:
    """(key, start, ids, doc_tokens, sequence, offset) for (key, ids) in order.

    Sequences are filled one after another; the last, if short, is cut anew
    into sequences of powers of two.
    """
    sequence, held, filled = first_sequence, [], 0
    for key, ids in documents:
        start = 0
        while start < len(ids):
            part = ids[start : start + length - filled]
            held.append((key, start, part, len(ids)))
            start += len(part)
            filled += len(part)
            if filled == length:
                yield from _placed(held, sequence)
                sequence, held, filled = sequence + 1, [], 0
    while filled:
        room = 1 << (filled.bit_length() - 1)
        own, rest, used = [], [], 0
        for key, start, part, total in held:
            take = min(len(part), room - used)
            if take:
                own.append((key, start, part[:take], total))
            if take < len(part):
                rest.append((key, start + take, part[take:], total))
            used += take
        yield from _placed(own, sequence)
        sequence, held, filled = sequence + 1, rest, filled - room


def _placed(held: list[tuple], sequence: int) -> Iterator[tuple]:
    offset = 0
    for key, start, part, total in held:
        yield key, start, part, total, sequence, offset
        offset += len(part)


def pack_documents(
    df: DataFrame,
    path: str,
    end_id: int = 1,
    length: int = LENGTH,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    One row per piece; ``ids`` are little-endian 32-bit, and so is what the
    checksum is of. Null and empty texts are their end id alone; null keys and
    repeated rows are documents of their own; texts of any length are cut over
    as many sequences as they need; equal keys on the curve go by document
    key; other columns are dropped; an empty table gives an empty one.
    ``sequence_id`` is unique, not consecutive, over partitions.
    """
    rows = token_rows(df, path, end_id, key, text)
    # the row number parts even copies under one key
    tokens = stage_table(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")
    order = ["curve", "key", "row"]
    ranged = tokens.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = ranged.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long" + (", ids binary" if with_ids else "")
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = next(batches, None)
        if start is None:
            return
        types = pa.schema(
            [
                start.schema.field("key"),
                *(pa.field(n, pa.binary() if n == "ids" else pa.int64()) for n in names[1:]),
            ]
        )

        def documents():
            for batch in chain([start], batches):
                columns = [batch.column(c).to_pylist() for c in ("key", "narrow", "ids")]
                for doc, narrow, ids in zip(*columns):
                    yield doc, np.frombuffer(ids, "<u2" if narrow else "<u4")

        def rows():
            first = TaskContext.get().partitionId() << 36
            for doc, start, part, total, sequence, offset in cut_pieces(
                documents(), first, length
            ):
                raw = part.astype("<u4").tobytes()
                row = (doc, start, len(part), zlib.crc32(raw), total, sequence, offset)
                yield (*row, raw) if with_ids else row

        block = []
        for row in rows():
            block.append(row)
            if len(block) == 4096:
                yield _batch(block, types)
                block = []
        if block:
            yield _batch(block, types)

    return ranged.select("key", "narrow", "ids").mapInArrow(run, schema).withColumnRenamed("key", key)


def _batch(block: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*block), types)]
    return pa.RecordBatch.from_arrays(columns, schema=types)
