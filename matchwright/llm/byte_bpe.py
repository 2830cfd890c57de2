"""Byte-level BPE: encoding by ranks, and decoding.

A text is cut by the tokenizer's pattern; each match is merged on its own. A
segment tree over the byte positions of a match holds, at each leaf, the rank
of the pair that starts there, and at the root the leftmost pair of the least
rank. A merge updates three leaves (the pair, its dead right half and the live
neighbour before it), each along one path to the root. Trees of equal size are
kept as rows of one array, so that all of them take their next merge together.

Matches are encoded once per task and kept in a table of bounded size.
"""

from __future__ import annotations

import base64
import gc
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from matchwright.llm.batches import map_slices, utf8

NONE = np.int64(1) << np.int64(40)
CACHED = 400_000
BANK_CELLS = 1 << 16
FEW_ROWS = 12
_RUNS = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


class Ranks:
    """A rank file: token bytes by id, and the id of each joined pair."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = {rank: token for token, rank in self.ids.items()}
        self.joined: dict[tuple[int, int], int] = {}
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    self.joined[left, right] = rank
        keys = np.array([a << 32 | b for a, b in self.joined], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.fromiter(self.joined.values(), np.int64, len(keys))[order]
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.decimal = {rank: str(rank) for rank in self.bytes}
        self.by_decimal = {str(rank): token for rank, token in self.bytes.items()}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs, ``NONE`` where no token joins them."""
        wanted = left << np.int64(32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], NONE)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


def merge_one(word: bytes, ranks: Ranks) -> list[int]:
    """Ids of one match, by a segment tree in plain lists."""
    n = len(word)
    size = 1 << max(0, n - 1).bit_length()
    none = int(NONE)
    symbol = [int(ranks.byte_ids[b]) for b in word]
    after = [*range(1, n), -1]
    before = [*range(-1, n - 1)]
    joined = ranks.joined
    tree = [none] * (2 * size)

    def rank_at(i: int) -> int:
        j = after[i]
        found = joined.get((symbol[i], symbol[j])) if j >= 0 else None
        return none if found is None else found * size + i

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        while i > 1:
            i >>= 1
            least = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == least:
                break
            tree[i] = least

    for i in range(n):
        tree[size + i] = rank_at(i)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while tree[1] < none:
        rank, i = divmod(tree[1], size)
        dead = after[i]
        symbol[i], symbol[dead] = rank, -1
        after[i] = after[dead]
        if after[i] >= 0:
            before[after[i]] = i
        put(dead, none)
        put(i, rank_at(i))
        if before[i] >= 0:
            put(before[i], rank_at(before[i]))
    return [s for s in symbol if s >= 0]


def merge_bank(words: list[bytes], size: int, ranks: Ranks) -> list[list[int]]:
    """Ids of many matches of at most ``size`` bytes (a power of two)."""
    rows, cells = len(words), len(words) * size
    lengths = np.fromiter(map(len, words), np.int64, rows)
    raw = np.frombuffer(b"".join([w.ljust(size, b"\0") for w in words]), np.uint8)
    place = np.tile(np.arange(size), rows)
    left = np.repeat(lengths, size) - place
    cell = np.arange(cells)
    # neighbours are cells of the same row, -1 where there is none
    symbol = np.where(left > 0, ranks.byte_ids[raw], -1)
    after = np.where(left > 1, cell + 1, -1)
    before = np.where((left > 0) & (place > 0), cell - 1, -1)
    tree = np.full(2 * cells, NONE, np.int64)
    root = np.arange(rows) * 2 * size
    shift = size.bit_length() - 1

    def leaf_values(at: np.ndarray) -> np.ndarray:
        then = after[at]
        found = ranks.pair_ranks(symbol[at], symbol[then])
        return np.where((then >= 0) & (found < NONE), (found << shift) + (at & (size - 1)), NONE)

    first = np.flatnonzero(after >= 0)
    tree[(first >> shift) * size + first + size] = leaf_values(first)
    whole = tree.reshape(rows, 2 * size)
    for level in range(shift - 1, -1, -1):
        a, b = 1 << level, 2 << level
        whole[:, a:b] = np.minimum(whole[:, b : 2 * b : 2], whole[:, b + 1 : 2 * b : 2])
    row = np.flatnonzero(tree[root + 1] < NONE)
    while row.size:
        key = tree[root[row] + 1]
        here = row * size + (key & (size - 1))
        dead = after[here]
        symbol[here], symbol[dead] = key >> shift, -1
        then = after[dead]
        after[here], after[dead] = then, -1
        linked = then >= 0
        before[then[linked]] = here[linked]
        prior = before[here]
        # three leaves change: each of their paths is renewed, level by level
        changed = np.concatenate([here, prior[prior >= 0], dead])
        base = root[changed >> shift]
        node = (changed & (size - 1)) + size
        tree[base + node] = leaf_values(changed)
        for _ in range(shift):
            child = base + (node & ~1)
            node = node >> 1
            tree[base + node] = np.minimum(tree[child], tree[child + 1])
        row = row[tree[root[row] + 1] < NONE]
    kept = symbol >= 0
    ids = symbol[kept].tolist()
    ends = np.cumsum(kept.reshape(rows, size).sum(axis=1)).tolist()
    return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def merge_all(words: Iterable[bytes], ranks: Ranks) -> dict[bytes, list[int]]:
    """Ids of each distinct match; a match that is a token is not merged."""
    out: dict[bytes, list[int]] = {}
    by_size: dict[int, list[bytes]] = {}
    for word in words:
        whole = ranks.ids.get(word)
        if whole is not None:
            out[word] = [whole]
        else:
            by_size.setdefault(1 << (len(word) - 1).bit_length(), []).append(word)
    for size, group in by_size.items():
        step = max(1, BANK_CELLS // size)
        for start in range(0, len(group), step):
            part = group[start : start + step]
            if len(part) < FEW_ROWS:
                out.update((word, merge_one(word, ranks)) for word in part)
            else:
                out.update(zip(part, merge_bank(part, size, ranks)))
    return out


class Encoder:
    """Texts to ids written as decimals joined by commas."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        # white space as the tokenizer's own engine has it
        exact = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.matches = regex.compile(exact.replace(r"\s", r"\p{White_Space}")).findall
        self.runs: dict[bytes, str] = {}
        self.words: dict[bytes, str] = {}

    def _cut(self, run: bytes) -> list[bytes]:
        """Matches of the pattern in a run; the two commonest shapes at once."""
        text = run.decode()
        if text[0] == " " and text[1:].isalpha():
            return [run]
        if text[0] == " " and text[-1] in ",." and text[1:-1].isalpha():
            return [run[:-1], run[-1:]]
        return [m.encode() for m in self.matches(text)]

    def _learn(self, runs: set[bytes]) -> set[bytes]:
        """Encode runs of white space and what follows: no match leaves one."""
        cut = {run: self._cut(run) for run in runs}
        fresh = set().union(*cut.values()).difference(self.words)
        text = self.ranks.decimal.__getitem__
        for word, ids in merge_all(fresh, self.ranks).items():
            self.words[word] = ",".join(map(text, ids))
        get = self.words.__getitem__
        for run, parts in cut.items():
            self.runs[run] = ",".join(map(get, parts))
        return fresh

    def encode(self, texts: list[bytes]) -> list[str]:
        cut = [_RUNS.findall(text) for text in texts]
        fresh = set().union(*cut).difference(self.runs)
        words = self._learn(fresh)
        get = self.runs.__getitem__
        out = [",".join(map(get, runs)) for runs in cut]
        # what came first is commonest: it stays, what does not fit goes again
        for table, learnt in ((self.runs, fresh), (self.words, words)):
            if len(table) > CACHED:
                for key in learnt:
                    del table[key]
        return out

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.ranks.by_decimal.__getitem__, ids.split(","))) if ids else b""


def encode_texts(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row, whole texts.

    ``ids`` are decimals joined by commas, ``decoded`` the bytes that these
    ids decode to. Null and empty texts have no ids; null keys, repeated rows
    and very long texts are rows like any other; other columns are dropped.
    An empty table gives an empty one.
    """
    spread = df.select(df[key].alias("key"), utf8(df[text]).alias("text"))

    def make():
        encoder = Encoder(path, pattern)
        gc.disable()  # millions of short lists, no cycles

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = encoder.encode(batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([i.count(",") + 1 if i else 0 for i in ids], pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(map(encoder.decode, ids), pa.binary()),
                ],
                ["key", "n_tokens", "ids", "decoded"],
            )

        return work

    kind = spread.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids string, decoded binary"
    return map_slices(spread, "text", schema, make).withColumnRenamed("key", key)
