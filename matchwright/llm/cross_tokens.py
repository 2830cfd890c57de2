"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers end a token wherever a text goes over to white space that
neither joins to what stands before it, so a text falls into runs, and each
distinct run is encoded and aligned once. Inside a run the shared cuts are
found by dividing: a common end near the middle, found by bisection, parts both
rows of tokens, and each half goes on by itself; where no cut is left, the
tokens are one group. All new runs of a slice are divided at the same time.

Links (pairs of tokens that overlap) are counted over the corpus by documents.
A slice of documents hands over its distinct pairs with their counts; the
totals come back to each slice, and the sums of its documents are made there.
No table of all pairs is held anywhere at once.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8
from matchwright.llm.byte_level import WHITE, letter_bytes, token_bytes
from matchwright.sources.staging import stage_table

CACHED_BYTES = 160 << 20
_WHITE = re.compile(f"[{WHITE}]")


def shared_cuts(
    a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of a, and which of b, end where one of the other does.

    ``a`` and ``b`` are rising byte ends; both are cut into the same intervals
    by ``ends_a`` and ``ends_b`` (one past each interval's last token, whose
    end is shared). All intervals are divided at the same time: at the shared
    end nearest the middle, found by bisection of b; the halves are the
    intervals of the next round, and those without a cut are done.
    """
    cut_a, cut_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    cut_a[ends_a - 1] = cut_b[ends_b - 1] = True
    now = np.stack(
        [np.r_[0, ends_a[:-1]], ends_a - 1, np.r_[0, ends_b[:-1]], ends_b - 1]
    ).astype(np.int64)
    while now.shape[1]:
        now = now[:, (now[0] < now[1]) & (now[2] < now[3])]
        a0, a1, b0, b1 = now
        middle = (a0 + a1) // 2
        found_a, found_b = np.full(len(a0), -1), np.full(len(a0), -1)
        open_, step = np.arange(len(a0)), 0
        while len(open_):
            for at in (middle[open_] + step, middle[open_] - step):
                inside = (a0[open_] <= at) & (at < a1[open_])
                here, i = open_[inside], at[inside]
                j = np.searchsorted(b, a[i])
                hit = (b0[here] <= j) & (j < b1[here]) & (b[np.minimum(j, len(b) - 1)] == a[i])
                found_a[here[hit]], found_b[here[hit]] = i[hit], j[hit]
            step += 1
            left = (found_a[open_] < 0) & (
                (middle[open_] + step < a1[open_]) | (middle[open_] - step >= a0[open_])
            )
            open_ = open_[left]
        cut = found_a >= 0
        i, j = found_a[cut], found_b[cut]
        cut_a[i] = cut_b[j] = True
        a0, a1, b0, b1 = now[:, cut]
        now = np.concatenate(
            [np.stack([a0, i, b0, j]), np.stack([i + 1, a1, j + 1, b1])], axis=1
        )
    return cut_a, cut_b


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all tokens whose byte ranges overlap, by their ends: between
    two neighbouring ends of either, just one token of each goes on."""
    ends = np.union1d(a, b)
    return np.searchsorted(a, ends), np.searchsorted(b, ends)


@lru_cache(maxsize=2)
def _byte_tokens(path: str) -> dict[int, bytes]:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = letter_bytes()
    found = {i: token_bytes(t, letters) for t, i in spec["model"]["vocab"].items()}
    return found | {a["id"]: a["content"].encode() for a in spec["added_tokens"]}


def piece_bytes(piece: str) -> bytes:
    """A piece's bytes: U+2581 is a space, <0xHH> the byte HH."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Aligner:
    """Runs of text, encoded by both tokenizers and aligned; remembered.

    ``spots`` numbers the runs met; by that number go their counts (tokens of
    both, groups, links, and whether their bytes come out right), the groups
    as text, and where their links (a << 32 | b) begin among all.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        self.a_bytes = _byte_tokens(path_a)
        pieces = self.b.id_to_piece(list(range(self.b.get_piece_size())))
        self.b_bytes = dict(enumerate(map(piece_bytes, pieces)))
        self.blank = pieces.index("▁")
        self.runs = _cutter(pieces).findall
        # by 2 * id, and 2 * id + 1 for the last one of a group
        self.a_text = [f"{i}{end}" for i in range(max(self.a_bytes) + 1) for end in ",|"]
        self.b_text = [f"{i}{end}" for i in range(len(pieces)) for end in ",;"]
        self._forget()

    def _forget(self) -> None:
        self.spots: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 5), np.int64)
        self.first = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)
        self.held = 0

    def _encode_b(self, runs: list[str]) -> list[list[int]]:
        """The model puts a space before what it is given, so a leading one is
        taken off beforehand, or the one put there afterwards."""
        given = [run[1:] if run[0] == " " else run for run in runs]
        out = self.b.encode(given, num_threads=1)
        for k, run in enumerate(runs):
            if run == " ":
                out[k] = [self.blank]
            elif run[0] != " ":
                if out[k][0] != self.blank:
                    raise ValueError("the second tokenizer joins its space to a run's start")
                del out[k][0]
        return out

    def learn(self, runs: list[str]) -> None:
        """Encode and align these runs, all at the same time."""
        raw = [run.encode() for run in runs]
        of_a = [e.ids for e in self.a.encode_batch_fast(runs, add_special_tokens=False)]
        of_b = self._encode_b(runs)
        right = _given_back(of_a, raw, self.a_bytes) & _given_back(of_b, raw, self.b_bytes)
        for k in np.flatnonzero(~right).tolist():
            of_a[k], of_b[k] = [], []
        n_a, a, a_end, last_a = _flat_tokens(of_a, self.a_bytes)
        n_b, b, b_end, last_b = _flat_tokens(of_b, self.b_bytes)
        some = n_a > 0  # the others have no bytes either
        cut_a, cut_b = shared_cuts(a_end, b_end, last_a[some], last_b[some])
        i, j = overlaps(a_end, b_end)
        # groups of all runs, numbered: a's tokens of each, then b's
        order = np.argsort(
            np.concatenate([2 * (np.cumsum(cut_a) - cut_a), 2 * (np.cumsum(cut_b) - cut_b) + 1]),
            kind="stable",
        )
        names = [*map(self.a_text.__getitem__, (2 * a + cut_a).tolist())]
        names += map(self.b_text.__getitem__, (2 * b + cut_b).tolist())
        texts = list(map(names.__getitem__, order.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        own = ["".join(texts[s:e])[:-1] for s, e in zip([0, *ends], ends)]
        run_of = np.repeat(np.arange(len(runs)), n_a)
        n_groups = np.bincount(run_of[cut_a], minlength=len(runs))
        n_links = np.bincount(run_of[i], minlength=len(runs))
        fresh = np.stack([n_a, n_b, n_groups, n_links, right], axis=1).astype(np.int64)
        self.spots.update(zip(runs, range(len(self.groups), len(self.groups) + len(runs))))
        self.groups += own
        self.first = np.concatenate([self.first, len(self.links) + np.cumsum(n_links) - n_links])
        self.links = np.concatenate([self.links, a[i] << 32 | b[j]])
        self.counts = np.concatenate([self.counts, fresh])
        self.held += 12 * sum(map(len, raw)) + 250 * len(runs)

    def align(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """The runs' numbers of each text, and its sums of counts.

        The last column says whether all of its runs came out right; texts
        that are empty or did not have no tokens.
        """
        if self.held > CACHED_BYTES:
            self._forget()
        cut = [self.runs(" " + t) if t else [] for t in texts]
        fresh = set().union(*cut).difference(self.spots)
        if fresh:
            self.learn(list(fresh))
        get = self.spots.__getitem__
        numbers = [list(map(get, runs)) for runs in cut]
        totals = np.zeros((len(texts), 5), np.int64)
        for k, own in enumerate(numbers):
            found = self.counts[own].sum(axis=0) if own else totals[k]
            if own and found[4] == len(own):
                totals[k] = found
                totals[k, 4] = 1
            else:
                numbers[k] = []
        return numbers, totals


@lru_cache(maxsize=1)
def load_aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker: what a task has learnt, the next one knows."""
    return Aligner(path_a, path_b)


def _given_back(ids: list[list[int]], raw: list[bytes], tokens: dict[int, bytes]) -> np.ndarray:
    """Whether each run's tokens join to its bytes."""
    get = tokens.__getitem__
    return np.fromiter(
        (b"".join(map(get, own)) == text for own, text in zip(ids, raw)), bool, len(raw)
    )


def _flat_tokens(ids: list[list[int]], tokens: dict[int, bytes]):
    """Tokens of each run; all tokens, their byte ends, and one past each run's last."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, n.sum())
    size = np.zeros(max(tokens) + 1, np.int64)
    size[list(tokens)] = list(map(len, tokens.values()))
    return n, flat, np.cumsum(size[flat]), np.cumsum(n)


def _cutter(pieces: list[str]) -> re.Pattern:
    """Runs that neither tokenizer joins: white space, what follows, and on as
    long as the white space after it is such as some piece has inside."""
    inside = {c for p in pieces for c in p[1:] if _WHITE.match(c)}
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("the second tokenizer has pieces that go on after a space")
    on = f"[{re.escape(''.join(sorted(inside)))}][{WHITE}]*" if inside else "(?!)"
    word = f"[^{WHITE}]+"
    return re.compile(f"[{WHITE}]*{word}(?:{on}{word})*(?:{on}\\Z)?|[{WHITE}]+")


def _link_rows(aligner: Aligner, numbers: list[list[int]]) -> tuple[np.ndarray, ...]:
    """The slice's distinct links; and per document and link: which, and how often."""
    sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
    met = np.fromiter(chain.from_iterable(numbers), np.int64, sizes.sum())
    runs, which = np.unique(met, return_inverse=True)
    per_run = aligner.counts[runs, 3]
    start = np.cumsum(per_run) - per_run
    flat = aligner.links[np.arange(per_run.sum()) + np.repeat(aligner.first[runs] - start, per_run)]
    pairs, place = np.unique(flat, return_inverse=True)
    times = per_run[which]
    shift = np.cumsum(times) - times
    at = np.arange(times.sum()) + np.repeat(start[which] - shift, times)
    doc = np.repeat(np.repeat(np.arange(len(numbers)), sizes), times)
    own, often = np.unique(doc * max(len(pairs), 1) + place[at], return_counts=True)
    return pairs, own // max(len(pairs), 1), own % max(len(pairs), 1), often


def _packed(numbers: np.ndarray) -> bytes:
    raw = numbers.astype("<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], size, "zstd", asbytes=True), "<i4")


def aligned_slices(spread: DataFrame, path_a: str, path_b: str, with_groups: bool) -> DataFrame:
    """One row per slice of (key, text): its documents' counts, its links.

    ``links`` holds, as numbers, how many links each document has, which (by
    the steps between their places among ``pairs``), and how often.
    """
    kind = spread.schema["key"].dataType.simpleString()
    schema = (
        f"slice long, keys array<{kind}>, sums array<long>, told array<string>, pairs array<long>,"
        " held array<int>, links binary"
    )

    def make():
        aligner = load_aligner(path_a, path_b)
        gc.disable()  # many short-lived lists, no cycles
        first, done = TaskContext.get().partitionId() << 32, 0

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal done
            texts = [t.decode() for t in batch.column("text").to_pylist()]
            numbers, totals = aligner.align(texts)
            told = []
            for own in numbers:
                groups = ";".join([aligner.groups[n] for n in own])
                told.append(groups if with_groups or not own else hashlib.sha256(groups.encode()).hexdigest())
            pairs, doc, place, often = _link_rows(aligner, numbers)
            links = np.concatenate(
                [np.bincount(doc, minlength=len(texts)), np.diff(place, prepend=0), often]
            )
            one = [
                pa.array([first + done], pa.int64()),
                pa.ListArray.from_arrays([0, len(texts)], batch.column("key")),
                pa.array([totals[:, :4].ravel()], pa.list_(pa.int64())),
                pa.array([told], pa.list_(pa.string())),
                pa.array([pairs], pa.list_(pa.int64())),
                pa.array([np.bincount(place, minlength=len(pairs))], pa.list_(pa.int32())),
                pa.array([_packed(links)], pa.binary()),
            ]
            done += 1
            return pa.RecordBatch.from_arrays(
                one, ["slice", "keys", "sums", "told", "pairs", "held", "links"]
            )

        return work

    return map_slices(spread, "text", schema, make)


def _documents(slice_rows: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of one slice, with the corpus-wide counts of its links."""
    names = ("key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "told")
    row = slice_rows.combine_chunks()
    keys = row.column("keys").combine_chunks().flatten()
    sums = row.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, 4)
    pairs = len(row.column("pairs").combine_chunks().flatten())
    count, best = np.zeros(pairs, np.int64), np.zeros(pairs, bool)
    at = totals.column("place").to_numpy()
    count[at] = totals.column("total").to_numpy()
    best[at] = totals.column("best").to_numpy(zero_copy_only=False)
    n = len(keys)
    links = _unpacked(row.column("links")[0].as_py())
    each, rest = links[:n], links[n:].reshape(2, -1).astype(np.int64)
    place, often = np.cumsum(rest[0]), rest[1]

    def per_doc(values: np.ndarray) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(values)])
        stop = np.cumsum(each, dtype=np.int64)
        return ends[stop] - ends[stop - each]

    columns = [
        keys,
        *(pa.array(sums[:, k]) for k in range(4)),
        pa.array(per_doc(often * best[place])),
        pa.array(per_doc(often * count[place])),
        row.column("told").combine_chunks().flatten(),
    ]
    return pa.table(dict(zip(names, columns)))


def align_documents(
    df: DataFrame,
    path_a: str,
    path_b: str,
    key: str = "doc_id",
    text: str = "text",
    with_groups: bool = True,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    ``path_a`` is a byte-level BPE of tokenizers, ``path_b`` a sentencepiece
    model that puts a space first; A encodes a space and the text, so both have
    the same bytes. ``groups`` are ``a1,a2|b1;a3|b2``, or their SHA-256 in hex
    without ``with_groups``. A link's count is the number of rows that hold
    it, over the whole table. Null and empty texts, and texts that one of the
    tokenizers does not give back byte for byte, have no tokens: zeros and no
    groups. Null keys and repeated rows are rows like any other; a text of any
    length is a slice of its own; other columns are dropped; an empty table
    gives an empty one.
    """
    spread = df.select(F.col(key).alias("key"), utf8(text).alias("text"))
    slices = stage_table(aligned_slices(spread, path_a, path_b, with_groups), "aligned")
    held = slices.selectExpr("explode(arrays_zip(pairs, held)) AS p")
    totals = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("total"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(of_a))
    met = slices.selectExpr("slice AS of", "posexplode(pairs) AS (place, pair)")
    told = met.join(totals.hint("merge"), "pair").select("of", "place", "total", "best")
    kind = spread.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, told string"
    )
    joined = slices.drop("held").groupBy("slice").cogroup(told.groupBy("of"))
    found = joined.applyInArrow(_documents, schema)
    return found.withColumnRenamed("key", key).withColumnRenamed("told", "groups")
