"""Removal of passages that an earlier document holds already.

A window of 13 words is anchored at its least 5-word phrase (by hash), so equal
windows have equal anchors, and a few anchors stand for all windows of a text.
Anchors that one document alone has are dropped. Around the others documents
cut fragments, which meet by anchor: in bounded shards the windows that recur
are confirmed word by word, compiled into an Aho-Corasick automaton, and every
fragment is streamed through it to locate each occurrence. Exact copies are
settled beforehand: all that a copy has, the first of them has.
"""

from __future__ import annotations

import gc
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8
from matchwright.sources.staging import drop_tables, shuffles_freed, stage_table

WINDOW = 13
PHRASE = 5
#: Words of fragments that are compiled together.
SHARD = 150_000
CACHED = 400_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Anchors:
    """Anchors of the windows of texts."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def find(self, cut: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text of words: each window's anchor, and the anchor's place."""
        fresh = set().union(*cut).difference(self.known)
        self.known.update((w, xxhash.xxh64_intdigest(w)) for w in fresh)
        sizes = list(map(len, cut))
        get = self.known.__getitem__
        h = np.fromiter(map(get, chain.from_iterable(cut)), np.uint64, sum(sizes))
        if len(self.known) > CACHED:  # what came first is commonest and stays
            for word in fresh:
                del self.known[word]
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        if len(h) < WINDOW:
            return [none] * len(cut)
        n = len(h) - PHRASE + 1
        code = np.zeros(n, np.uint64)
        for k in range(PHRASE):
            code = (code ^ h[k : n + k]) * _A
            code = (code ^ (code >> np.uint64(31))) * _B
        code ^= code >> np.uint64(32)
        wide = WINDOW - PHRASE + 1
        at = np.lib.stride_tricks.sliding_window_view(code, wide).argmin(axis=1)
        at = at + np.arange(len(at))
        out, start = [], 0
        for size in sizes:
            if size < WINDOW:
                out.append(none)
            else:
                own = at[start : start + size - WINDOW + 1]
                out.append((code[own], own - start))
            start += size
        return out


def anchor_rows(texts: DataFrame) -> DataFrame:
    """(anchor, key) of (key, h, text); a task leaves out later copies it can see."""

    def make():
        anchors, seen = Anchors(), {}
        gc.disable()  # many short-lived lists, no cycles

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, cut = [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "h", "text"))
            for key, h, text in zip(*columns):
                if seen.get(h, key + 1) > key:
                    if h in seen or len(seen) < CACHED:
                        seen[h] = key
                    keys.append(key)
                    cut.append(text.split())
            found = [np.unique(codes) for codes, _ in anchors.find(cut)]
            owner = np.repeat(np.array(keys, np.int64), list(map(len, found)))
            codes = np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(owner)], ["anchor", "key"])

        return work

    return map_slices(texts.select("key", "h", "text"), "text", "anchor long, key long", make)


def _shared(batches):
    """(anchor, key) of anchors with two keys and more; rows come in this order."""
    anchor = first = last = None
    told = False
    for batch in batches:
        a, k = batch.column("anchor").to_numpy(), batch.column("key").to_numpy()
        if not len(a):
            continue
        fresh = np.r_[a[0] != anchor or k[0] != last, (a[1:] != a[:-1]) | (k[1:] != k[:-1])]
        a, k = a[fresh], k[fresh]
        if not len(a):
            continue
        carried = a[0] == anchor
        starts = np.flatnonzero(np.r_[not carried, a[1:] != a[:-1]])
        begin = starts if not carried else np.r_[0, starts]
        size = np.diff(np.r_[begin, len(a)])
        many = size > 1
        if carried:
            many[0] = True
        keep = np.repeat(many, size)
        out_a, out_k = a[keep], k[keep]
        if carried and not told:
            out_a, out_k = np.r_[anchor, out_a], np.r_[first, out_k]
        told = bool(many[-1])
        first = first if carried and len(begin) == 1 else k[begin[-1]]
        anchor, last = a[-1], k[-1]
        yield pa.RecordBatch.from_arrays([pa.array(out_a), pa.array(out_k)], ["anchor", "key"])


FRAGMENT = "anchor long, key long, h long, places array<int>, words binary"


def fragment_rows(texts: DataFrame) -> DataFrame:
    """Fragments around the shared ``anchors`` of (key, h, text, anchors).

    A fragment holds the consecutive windows of one anchor; fragments that a
    text repeats are one row with all their places.
    """

    def make():
        finder = Anchors()
        gc.disable()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cut = [text.split() for text in batch.column("text").to_pylist()]
            shared = batch.column("anchors")
            rows: list[tuple] = []
            names = (batch.column(c).to_pylist() for c in ("key", "h"))
            for i, (key, h, words, (codes, at)) in enumerate(zip(*names, cut, finder.find(cut))):
                wanted = np.asarray(shared[i].values).view(np.uint64)
                used = np.flatnonzero(np.isin(codes, wanted))
                if not len(used):
                    continue
                breaks = np.flatnonzero((np.diff(used) != 1) | (np.diff(at[used]) != 0)) + 1
                held: dict[tuple, list[int]] = {}
                for run in np.split(used, breaks):
                    start, stop = int(run[0]), int(run[-1]) + WINDOW
                    name = (int(codes[run[0]].view(np.int64)), b" ".join(words[start:stop]))
                    held.setdefault(name, []).append(start)
                rows += [(a, key, h, places, text) for (a, text), places in held.items()]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["anchor", "key", "h", "places", "words"],
            )

        return work

    return map_slices(texts, "text", FRAGMENT, make)


def _locate(batches):
    """(key, h, start, stop): words of windows that a smaller key holds too.

    Fragments come by anchor and key. Shards end at an anchor's end, or, inside
    an anchor with very many fragments, go on with the windows met so far. A
    fragment that a smaller key has word for word goes whole, unread.
    """
    rows, size, anchor = [], 0, None
    first: dict[tuple, int] = {}
    number: dict[bytes, int] = {}
    whole: dict[bytes, tuple[int, int]] = {}
    known: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "h", "places", "words"))):
            if row[0] != anchor:
                if size >= SHARD:
                    yield _occurrences(rows, first, number)
                    rows, size = [], 0
                    first, number = {}, {}
                whole, anchor = {}, row[0]
            elif size >= 2 * SHARD:
                yield _occurrences(rows, first, number)
                rows, size = [], 0
            key, h, places, text = row[1:]
            holder, n = whole.get(text, (key, 0))
            if holder < key:
                known += [(key, h, p, p + n) for p in places]
                if len(known) > SHARD:
                    yield _spans(known)
                    known = []
                continue
            words = text.split(b" ")
            whole[text] = (key, len(words))
            rows.append((key, h, places, tuple([number.setdefault(w, len(number)) for w in words])))
            size += len(words)
    if rows:
        yield _occurrences(rows, first, number)
    yield _spans(known)


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["key", "h", "start", "stop"]
    )


def _occurrences(rows: list[tuple], first: dict, number: dict) -> pa.RecordBatch:
    """Confirm, compile and stream one shard."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, _, _, words in rows:
        for i in range(len(words) - WINDOW + 1):
            window = words[i : i + WINDOW]
            # equal windows have one anchor, whose keys ascend
            if first.setdefault(window, key) < key:
                automaton.add_word(window, window)
    out: list[tuple] = []
    if len(automaton):
        automaton.make_automaton()
        for key, h, places, words in rows:
            start = stop = -1
            for end, window in automaton.iter(words):
                if first[window] < key:
                    if end - WINDOW + 1 > stop:
                        out += [(key, h, p + start, p + stop) for p in places if stop > 0]
                        start = end - WINDOW + 1
                    stop = end + 1
            out += [(key, h, p + start, p + stop) for p in places if stop > 0]
    return _spans(out)


class Removal:
    """What to remove from each document: the plan behind both forms below."""

    def __init__(self, docs: DataFrame, key: str, text: str):
        self.key, self.text = key, text
        with shuffles_freed(docs.sparkSession):
            self.copies, self.spans = self._found(docs)

    def _found(self, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Copies (key, h), and the spans (key, h, start, stop) of other texts."""
        key, text = self.key, self.text
        base = docs.select(F.col(key).cast("long").alias("key"), utf8(text).alias("text"))
        base = base.where("key IS NOT NULL").withColumn("h", F.xxhash64("text"))
        copies = (
            base.select("key", "h", F.octet_length("text").alias("size"))
            .groupBy("h", "size")
            .agg(F.min("key").alias("rep"))
        )
        held = base.select("key", "h", F.octet_length("text").alias("size"))
        later = held.join(copies.hint("merge"), ["h", "size"]).where("key <> rep")
        gone = stage_table(later.select("key", "h").distinct(), "copies")
        dealt = anchor_rows(base).repartition("anchor").sortWithinPartitions("anchor", "key")
        shared = stage_table(dealt.mapInArrow(_shared, "anchor long, key long"), "anchors")
        # what is a copy is told with the anchors, so that texts are dealt out once;
        # a key has as many of these marks as it has different texts
        by_key = gone.groupBy("key").agg(F.collect_set("h").alias("gone"))
        lists = shared.groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
        lists = lists.join(by_key.hint("merge"), "key", "left")
        texts = base.join(lists.hint("merge"), "key")
        texts = texts.where("gone IS NULL OR NOT array_contains(gone, h)")
        texts = texts.select("key", "h", "text", "anchors")
        fragments = fragment_rows(texts).repartition("anchor").sortWithinPartitions("anchor", "key")
        found = fragments.mapInArrow(_locate, "key long, h long, start long, stop long")
        spans = stage_table(found.distinct(), "spans")
        drop_tables(shared)
        return gone, spans

    def marked(self, docs: DataFrame, own: str = "__") -> DataFrame:
        """``docs`` with ``<own>spans``, or null, and ``<own>copy``.

        ``own`` starts none of the columns of ``docs`` (``own_prefix``).
        """
        spans = self.spans.groupBy("key", "h").agg(
            F.collect_list(F.struct("start", "stop")).alias("spans"), F.lit(False).alias("c")
        )
        none = F.lit(None).cast("array<struct<start:bigint,stop:bigint>>")
        copies = self.copies.select("key", "h", none.alias("spans"), F.lit(True).alias("c"))
        marks = (
            spans.unionByName(copies)
            .select(F.col("key").alias(f"{own}k"), F.col("h").alias(f"{own}h"), "spans", "c")
            .groupBy(f"{own}k", f"{own}h")
            .agg(
                F.first("spans", ignorenulls=True).alias(f"{own}spans"),
                F.max("c").alias(f"{own}copy"),
            )
        )
        on = (F.col(self.key).cast("long") == F.col(f"{own}k")) & (
            F.xxhash64(utf8(self.text)) == F.col(f"{own}h")
        )
        return docs.join(marks.hint("merge"), on, "left").drop(f"{own}k", f"{own}h")


def own_prefix(columns: list[str]) -> str:
    """A prefix that no column's name starts with."""
    own = "__"
    while any(c.lower().startswith(own) for c in columns):
        own += "_"
    return own


def kept_words(words: list[bytes], spans: list[dict] | None, copy: bool) -> list[bytes]:
    """The words that stay; a copy of thirteen words and more loses all."""
    if copy and len(words) >= WINDOW:
        return []
    if not spans:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, [s["start"] for s in spans], 1)
    np.add.at(cover, [s["stop"] for s in spans], -1)
    return [w for w, c in zip(words, np.cumsum(cover[:-1]).tolist()) if not c]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept): kept words joined by one space.

    One row per row of ``docs``. Null and empty texts have no words; rows with
    a null key lose nothing and cost others nothing; rows of one key are one
    document to each other; other columns are dropped; an empty table gives an
    empty one. Keys are whole numbers: their order says who is earlier, and a
    text that is no number raises.
    """
    slim = docs.select(key, text)
    own = own_prefix(slim.columns)
    marked = Removal(slim, key, text).marked(slim, own)
    spread = marked.select(
        F.col(key).alias("key"),
        utf8(text).alias("text"),
        F.col(f"{own}spans").alias("__spans"),
        F.col(f"{own}copy").alias("__copy"),
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = (batch.column(c).to_pylist() for c in ("text", "__spans", "__copy"))
            cut = [(text.split(), spans, copy) for text, spans, copy in zip(*columns)]
            kept = [kept_words(*row) for row in cut]
            n = np.array([len(words) for words, _, _ in cut], np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(n),
                    pa.array(n - np.array(list(map(len, kept)), np.int64)),
                    pa.array([b" ".join(k).decode() for k in kept], pa.string()),
                ],
                ["key", "n_words", "n_removed", "kept"],
            )

        return work

    kind = spread.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words long, n_removed long, kept string"
    return map_slices(spread, "text", schema, make).withColumnRenamed("key", key)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: str = "n_chars"
) -> DataFrame:
    """``docs``, all columns, texts without what ``remove_repeats`` removes.

    Texts that lose nothing stay as they are; ``size``, where there is such a
    column, follows the text. Nulls, repeated rows, keys and empty tables as in
    ``remove_repeats``; texts of any length are taken whole; other columns stay,
    whatever their names.
    """
    names = docs.columns
    own = own_prefix(names)
    marked = Removal(docs.select(key, text), key, text).marked(docs, own)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(text).to_pylist()
            marks = (batch.column(f"{own}{c}").to_pylist() for c in ("spans", "copy"))
            for i, (spans, copy) in enumerate(zip(*marks)):
                if spans or copy:
                    words = (texts[i] or "").encode().split()
                    kept = kept_words(words, spans, copy)
                    if len(kept) < len(words):
                        texts[i] = b" ".join(kept).decode()
            columns = [batch.column(c) for c in names]
            columns[names.index(text)] = pa.array(texts, batch.column(text).type)
            return pa.RecordBatch.from_arrays(columns, names)

        return work

    out = map_slices(marked, text, docs.schema, make)
    if size in names:
        changed = F.length(text).cast(docs.schema[size].dataType)
        out = out.withColumn(size, F.when(F.col(text).isNotNull(), changed).otherwise(F.col(size)))
    return out
