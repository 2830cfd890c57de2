"""Similarity join of documents on word n-gram sets, by PartEnum signatures.

Sets whose sizes fall into one band, or into neighbouring ones, and whose
Jaccard similarity reaches the threshold differ in at most k elements. The
domain of elements is dealt into groups, so many that some groups hold one
difference at most, and each group into three parts: leaving out the part with
the difference, the other two agree. A set's signatures are the hashes of its
elements in every two of the three parts of every group (Arasu, Ganti and
Kaushik, VLDB 2006); sets similar enough share one.

A set smaller than its band allows differs less from what is similar to it: it
signs the first groups only, as many as its own size asks for, and of them none
with two empty parts, in which all sets of the band with few elements agree.

Equal sets are one class and are signed alike. In a bucket of one signature
classes meet its least class first; only classes that this leaves in different
components meet its hub, the class with most links, and those that this leaves
apart as well meet each other. Every pair that is met passes a bound on its
difference before the sets are compared: a set's sketch holds, for each of 1,024
cells of hashed elements, whether their number is odd, and sets differ in at
least as many elements as their sketches in bits. Where sets are so large that
this tells nothing, pairs pass a second sketch, with cells in proportion to the
set, before whole sets travel.

Where parts hold few elements, one element that many sets share fills a bucket
with sets that share little else. There the domain has more groups than
differences ask for, so that similar sets agree in so many groups more; a class
with no more signatures in crowded buckets than that leaves those buckets and
still shares another with each similar one.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8
from matchwright.llm.components import smallest_reachable
from matchwright.sources.staging import drop_tables, shuffles_freed, stage_table

SHINGLE = 4
PERCENT = 85
#: Longs of 64 cells in a set's sketch.
SKETCH = 16
#: Times that mixed buckets meet their hub before all that is left apart does.
HUB_ROUNDS = 1
#: Sets of this many elements and more have a second sketch of two cells and more an element.
LARGE = 1024
#: A bucket with more classes is crowded.
CROWD = 8
CACHED = 400_000
#: Bytes of texts that are cut into words at once.
PIECE = 1 << 18

_A, _B, _C = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def mixed(x: np.ndarray, salt: int | np.ndarray = 0) -> np.ndarray:
    """A 64-bit finaliser on an array."""
    x = (x + np.uint64(salt)) * _A
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def _lower(table: np.ndarray) -> np.ndarray:
    """A-Z count as a-z."""
    table[65:91] = table[97:123]
    return table


_LETTER = _lower(mixed(np.arange(256, dtype=np.uint64), 21))
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PLACE = mixed(np.arange(256, dtype=np.uint64), 22) | np.uint64(1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in bytes that begin and end with a blank, and the words'
    64-bit hashes: sums of letters times odd numbers of their places, mixed."""
    inside = ~_BLANK[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    most = int(lengths.max())
    places = _PLACE
    if most > len(places):
        places = mixed(np.arange(most, dtype=np.uint64), 22) | np.uint64(1)
    codes = _LETTER[data[inside]] * places[at]
    return starts, mixed(np.add.reduceat(codes, first) + lengths.astype(np.uint64), 23)


class Shingler:
    """Distinct word n-grams of texts, as sorted 64-bit hashes."""

    def __init__(self, words: int = SHINGLE):
        self.n = words

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        out, start, held = [], 0, 0
        for at, text in enumerate(texts):
            held += len(text)
            if held >= PIECE or at == len(texts) - 1:
                out += self._sets(texts[start : at + 1])
                start, held = at + 1, 0
        return out

    def _sets(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        starts, h = word_hashes(data)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        sizes = np.diff(np.searchsorted(starts, ends, side="right"), prepend=0)
        n = min(self.n, len(h))
        code = np.full(len(h) - n + 1 if n else 0, np.uint64(self.n))
        for k in range(n):
            code = mixed(code ^ h[k : len(h) - n + 1 + k], k + 1)
        out, start = [], 0
        for size in sizes.tolist():
            if size >= self.n:
                own = np.sort(code[start : start + size - self.n + 1])
                out.append(own[np.r_[True, own[1:] != own[:-1]]])
            elif size:  # a text of fewer words is one shingle
                one = np.full(1, np.uint64(size))
                for k in range(size):
                    one = mixed(one ^ h[start + k : start + k + 1], k + 1)
                out.append(one)
            else:
                out.append(h[:0])
            start += size
        return out


class PartEnum:
    """Bands of set sizes and the signatures of a set in its bands."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.most = [1]  # the largest size of each band
        # two parts of the largest set of a band hold about so many elements
        held = 2 * (100 + percent) / (3 * max(100 - percent, 1))
        self.share, self.spare = (6, 20) if held < 7 else (0, 50)

    def band(self, size: int) -> int:
        while self.most[-1] < size:
            u = self.most[-1]
            self.most.append(max(u + 1, u * 10_000 // self.percent**2))
        return int(np.searchsorted(self.most, size))

    def differences(self, sizes: int) -> int:
        """Differing elements that two similar sets of these sizes together have at most."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def groups(self, band: int) -> tuple[int, int]:
        """Groups that differences in a band ask for (0: none differ), and those
        that a set may leave for being in crowded buckets."""
        while len(self.most) <= band:
            self.band(self.most[-1] + 1)
        k = self.differences(2 * self.most[band])
        asked = k // 2 + 1 if k else 0
        return asked, asked // self.share if self.share else 0

    def needed(self, size: int, band: int) -> int:
        """Groups of which one agrees with any similar set that signs in the band."""
        return self.differences(size + min(self.most[band], size * 100 // self.percent)) // 2 + 1

    def leaves(self) -> str:
        """SQL: how many crowded buckets a set of n elements may leave."""
        if not self.share:
            return "0"
        k = f"2 * n * {100 - self.percent} DIV {100 + self.percent}"  # its band's sets are no smaller
        return f"({k} DIV 2 + 1) DIV {self.share}"

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """Signatures in the set's own band, and in the next if a partner may lie there."""
        return self.signed([elements])[0]

    def signed(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of sets, set by set, and how many each has."""
        of, bands = [], []
        for i, size in enumerate(map(len, sets)):
            if size:
                band = self.band(size)
                both = (band,) if self.band(size * 100 // self.percent) == band else (band, band + 1)
                for b in both:
                    if self.groups(b)[0]:  # else only equal sets are similar, and those are one class
                        of.append(i)
                        bands.append(b)
        if not of:
            return np.zeros(0, np.int64), np.zeros(len(sets), np.int64)
        asked, left = np.array([self.groups(b) for b in bands]).T
        # more groups than needed, for those with empty parts
        groups = asked + 1 + asked // self.spare + left
        need = left + np.array([self.needed(len(sets[i]), b) for i, b in zip(of, bands)])
        elements = np.concatenate([sets[i] for i in of])
        sizes = np.array([len(sets[i]) for i in of])
        of, band = np.array(of), np.array(bands, np.uint64)
        first = np.cumsum(groups) - groups
        place = mixed(elements, np.repeat(band + np.uint64(1), sizes)) >> np.uint64(32)
        part = place * np.repeat((3 * groups).astype(np.uint64), sizes) >> np.uint64(32)
        part = part.astype(np.int64) + np.repeat(3 * first, sizes)
        total = int(groups.sum())
        count = np.bincount(part, minlength=3 * total).reshape(total, 3)
        # halves of 32 bits: their sums are exact as doubles
        value = mixed(elements, 77)
        low, high = (
            np.bincount(part, half.astype(np.float64), 3 * total).astype(np.uint64)
            for half in (value & np.uint64(0xFFFFFFFF), value >> np.uint64(32))
        )
        sums = (low + (high << np.uint64(32))).reshape(total, 3)
        out = np.empty((total, 3), np.uint64)
        blank = np.empty((total, 3), bool)
        number = (np.arange(total) - np.repeat(first, groups)).astype(np.uint64) * np.uint64(4)
        number += np.repeat(band << np.uint64(40), groups)
        for left_out in range(3):
            a, b = (p for p in range(3) if p != left_out)
            out[:, left_out] = mixed(
                mixed(sums[:, a], 5) + mixed(sums[:, b], 9) * _B + number, left_out + 11
            )
            blank[:, left_out] = count[:, a] + count[:, b] == 0
        # a set signs its first groups, as many as its own size asks for without the
        # empty ones; of two similar sets the one that stops first has enough in both
        full = (~blank.any(axis=1)).astype(np.int64)
        told = np.add.reduceat(full, first)
        before = np.cumsum(full) - full - np.repeat(np.cumsum(told) - told, groups)
        enough = np.repeat(told >= need, groups)
        keep = ((before < np.repeat(need, groups))[:, None] & ~blank) | ~enough[:, None]
        own = np.add.reduceat(keep.sum(axis=1), first)
        many = np.bincount(of, own, len(sets)).astype(np.int64)
        return out[keep].view(np.int64), many


def class_of(elements: np.ndarray) -> int:
    """One number for equal sets (0: the empty one)."""
    if not len(elements):
        return 0
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63) or 1


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parities of the elements' numbers in 64 cells for each of ``SKETCH`` longs."""
    cells = SKETCH * 64
    odd = np.bincount((elements % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(elements: np.ndarray) -> np.ndarray | None:
    """Such parities in two cells and more for each element; none for smaller sets."""
    if len(elements) < LARGE:
        return None
    cells = 1 << (2 * len(elements) - 1).bit_length()
    odd = np.bincount((elements % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_possible(x: str, y: str, percent: int) -> str:
    """SQL: second sketches, columns that start so, allow similar sets.

    Twice the cells are folded to the other's number, as a cell's place is the
    rest of a division; numbers further apart allow all.
    """

    def bits(p: str, q: str) -> str:
        return f"aggregate(zip_with({p}, {q}, (u, v) -> bit_count(u ^ v)), 0, (s, c) -> s + c)"

    def half(p: str) -> str:
        n = f"CAST(size({p}) DIV 2 AS INT)"
        return f"zip_with(slice({p}, 1, {n}), slice({p}, {n} + 1, {n}), (u, v) -> u ^ v)"

    p, q = f"{x}wide", f"{y}wide"
    apart = f"""CASE WHEN size({p}) = size({q}) THEN {bits(p, q)}
        WHEN size({p}) = 2 * size({q}) THEN {bits(half(p), q)}
        WHEN 2 * size({p}) = size({q}) THEN {bits(p, half(q))} ELSE 0 END"""
    return f"({apart}) * {100 + percent} <= {100 - percent} * ({x}n + {y}n)"


def possible(x: str, y: str, percent: int) -> str:
    """SQL: sizes and sketches, columns that start so, allow similar sets."""
    apart = " + ".join(f"bit_count({x}m{k} ^ {y}m{k})" for k in range(SKETCH))
    return f"""100 * least({x}n, {y}n) >= {percent} * greatest({x}n, {y}n)
        AND ({apart}) * {100 + percent} <= {100 - percent} * ({x}n + {y}n)"""


def set_rows(spread: DataFrame, words: int) -> DataFrame:
    """(key, n, class, m0, m1, ..., wide) of every row of (key, text): whole texts."""
    marks = [f"m{k}" for k in range(SKETCH)]

    def make():
        shingler = Shingler(words)
        gc.disable()  # many short-lived lists, no cycles

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingler.sets(batch.column("text").to_pylist())
            odd = np.array([sketch(s) for s in sets], np.int64).reshape(-1, SKETCH)
            columns = [
                batch.column("key"),
                pa.array(list(map(len, sets)), pa.int64()),
                pa.array(list(map(class_of, sets)), pa.int64()),
                *map(pa.array, np.ascontiguousarray(odd.T)),
                pa.array(list(map(wide_sketch, sets)), pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["key", "n", "class", *marks, "wide"])

        return work

    kind = spread.schema["key"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in ("n", "class", *marks))
    return map_slices(spread, "text", f"key {kind}, {longs}, wide array<long>", make)


def signature_rows(spread: DataFrame, words: int, percent: int) -> DataFrame:
    """(sig, class) of all texts; a task signs a class that it remembers once."""

    def make():
        shingler, scheme, signed = Shingler(words), PartEnum(percent), set()
        gc.disable()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            fresh, names = [], []
            for s in shingler.sets(batch.column("text").to_pylist()):
                name = class_of(s)
                if name not in signed:
                    if len(signed) < CACHED:
                        signed.add(name)
                    fresh.append(s)
                    names.append(name)
            sigs, many = scheme.signed(fresh)
            classes = np.repeat(np.array(names, np.int64), many)
            return pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(classes)], ["sig", "class"])

        return work

    return map_slices(spread.select("text"), "text", "sig long, class long", make)


def _runs(batches):
    """(sig, center, class, place) of signatures with two classes and more.

    Rows come by signature and class; the center is the least class, and places
    count from it. Only the run at hand is remembered, as its center, last class
    and length.
    """
    sig = center = last = None
    told, length = False, 0
    for batch in batches:
        s, c = batch.column("sig").to_numpy(), batch.column("class").to_numpy()
        if not len(s):
            continue
        fresh = np.r_[s[0] != sig or c[0] != last, (s[1:] != s[:-1]) | (c[1:] != c[:-1])]
        s, c = s[fresh], c[fresh]
        if not len(s):
            continue
        starts = np.flatnonzero(np.r_[s[0] != sig, s[1:] != s[:-1]])
        carried = not (len(starts) and starts[0] == 0)
        if carried:
            starts = np.r_[0, starts]
        ends = np.r_[starts[1:], len(s)]
        centers = c[starts].copy()
        if carried:
            centers[0] = center
        size = ends - starts
        of = np.repeat(centers, size)
        before = length if carried else 0
        place = np.arange(len(s)) - np.repeat(starts, size)
        place[: ends[0]] += before
        length = int(place[-1]) + 1
        shared = of != c
        # a center is a member of its bucket as well, told when it has company
        company = np.flatnonzero(np.add.reduceat(shared, starts) > 0)
        if carried and told:
            company = company[company != 0]
        out = [
            np.r_[s[shared], s[starts[company]]],
            np.r_[of[shared], centers[company]],
            np.r_[c[shared], centers[company]],
            np.r_[place[shared], np.zeros(len(company), np.int64)],
        ]
        told = bool(shared[starts[-1] :].any()) or (told and carried and len(starts) == 1)
        sig, center, last = s[-1], centers[-1], c[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in out], ["sig", "center", "class", "place"]
        )


def _buckets(signed: DataFrame) -> DataFrame:
    dealt = signed.repartition("sig").sortWithinPartitions("sig", "class")
    return dealt.mapInArrow(_runs, "sig long, center long, class long, place long")


class NearJoin:
    """One join: its documents, classes and the checks between classes."""

    def __init__(self, docs: DataFrame, words: int, percent: int, key: str, text: str):
        self.words, self.percent = words, percent
        self.spread = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
        self.rows = stage_table(set_rows(self.spread, words), "sets")
        self.classes = stage_table(
            self.rows.where("n > 0 AND key IS NOT NULL")
            .groupBy("class")
            .agg(
                F.min("key").alias("rep"),
                *(F.min(c).alias(c) for c in ("n", *(f"m{k}" for k in range(SKETCH)))),
            ),
            "classes",
        )
        wide = self.rows.where("wide IS NOT NULL AND key IS NOT NULL")
        self.wide = wide.select("class", "wide").dropDuplicates(["class"])

    def members(self) -> DataFrame:
        """(sig, center, class, place) of all buckets with company."""
        signed = signature_rows(self.spread.where("key IS NOT NULL"), self.words, self.percent)
        found, leaves = _buckets(signed), PartEnum(self.percent).leaves()
        if leaves == "0":
            return stage_table(found, "members")
        found = stage_table(found, "buckets")
        crowded = found.where(f"place = {CROWD}").selectExpr("sig", "true AS crowded")
        marked = found.join(crowded.hint("merge"), "sig", "left")
        marked = stage_table(marked, "marked")
        drop_tables(found)
        full = marked.where("crowded").select("sig", "class")
        often = full.groupBy("class").agg(F.count("*").alias("often"))
        often = often.join(self.classes.select("class", "n").hint("merge"), "class")
        stay = often.where(f"often > {leaves}").select("class")
        still = _buckets(full.join(stay.hint("merge"), "class", "left_semi"))
        roomy = marked.where("crowded IS NULL").drop("crowded")
        members = stage_table(roomy.unionByName(still), "members")
        drop_tables(marked)
        return members

    def _side(self, name: str) -> DataFrame:
        told = ("n", *(f"m{k}" for k in range(SKETCH)))
        return self.classes.select(
            F.col("class").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in told)
        ).hint("merge")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct (a, b) that are similar, by their whole sets."""
        low, high = self.percent, 100
        met = pairs.join(self._side("a"), "a").join(self._side("b"), "b")
        first = stage_table(
            met.where(possible("a_", "b_", low)).select("a", "b", "a_n", "b_n"), "possible"
        )
        wide_a, wide_b = (
            self.wide.select(F.col("class").alias(x), F.col("wide").alias(f"{x}_wide")).hint("merge")
            for x in ("a", "b")
        )
        large = f"a_n >= {LARGE} AND b_n >= {LARGE}"
        met = first.where(large).join(wide_a, "a").join(wide_b, "b")
        both = met.where(wide_possible("a_", "b_", low)).select("a", "b")
        near = stage_table(first.where(f"NOT ({large})").select("a", "b").unionByName(both), "near")
        drop_tables(first)
        named = near.select("a").unionByName(near.select(F.col("b").alias("a"))).distinct()
        reps = self.classes.join(named.withColumnRenamed("a", "class").hint("merge"), "class")
        reps = reps.select(F.col("rep").alias("key"), "class")
        texts = self.spread.join(reps.hint("merge"), "key").select("key", "class", "text")
        # one row per class, however often its document is repeated
        held = stage_table(self._sets(texts).dropDuplicates(["class"]), "compared")
        one, two = (
            held.select(F.col("class").alias(x), F.col("elements").alias(f"{x}_set")).hint("merge")
            for x in ("a", "b")
        )
        met = near.join(one, "a").join(two, "b")
        both = "size(array_intersect(a_set, b_set))"
        links = stage_table(
            met.selectExpr("a", "b", f"{both} AS both", "size(a_set) + size(b_set) AS total")
            .where(f"{high} * both >= {low} * (total - both)")
            .select("a", "b"),
            "links",
        )
        drop_tables(near, held)
        return links

    def _sets(self, texts: DataFrame) -> DataFrame:
        words = self.words

        def make():
            shingler = Shingler(words)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                sets = shingler.sets(batch.column("text").to_pylist())
                # a repeated key may have another text: its own class only
                own = [class_of(s) == c for s, c in zip(sets, batch.column("class").to_pylist())]
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column("class"),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["class", "elements"],
                ).filter(pa.array(own, pa.bool_()))

            return work

        return map_slices(texts, "text", "class long, elements array<long>", make)

    def mixed(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """(sig, class, root, home, n, sketch) of buckets that the links so far
        leave in several components; home is the center's. A center has met its
        whole bucket, so a bucket of two has nothing left to meet."""
        root = roots.select(F.col("node").alias("class"), "root")
        at = members.join(root.hint("merge"), "class", "left").withColumn(
            "root", F.coalesce("root", "class")
        )
        at = at.join(
            root.select(F.col("class").alias("center"), F.col("root").alias("home")).hint("merge"),
            "center",
            "left",
        ).withColumn("home", F.coalesce("home", "center"))
        at = stage_table(at.select("sig", "class", "place", "root", "home"), "at")
        third = at.where("place = 2").select("sig")
        apart = at.where("root <> home").select("sig").distinct()
        apart = apart.join(third.hint("merge"), "sig")
        told = ("n", *(f"m{k}" for k in range(SKETCH)))
        full = (
            at.join(apart.hint("merge"), "sig", "left_semi")
            .join(self.classes.select("class", *told).hint("merge"), "class")
            .select("sig", "class", "root", "home", *told)
        )
        full = stage_table(full, "mixed")
        drop_tables(at)
        return full

    def to_hubs(self, full: DataFrame, links: DataFrame) -> DataFrame:
        """Pairs of a mixed bucket's hub, its class with most links, and the
        classes outside the hub's component: one row a member at most."""
        ends = links.select("a").unionByName(links.select(F.col("b").alias("a")))
        degree = ends.groupBy(F.col("a").alias("class")).agg(F.count("*").alias("degree"))
        at = full.select("sig", "class", "root").join(degree.hint("merge"), "class", "left")
        rank = F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "class", "root")
        hub = at.groupBy("sig").agg(F.max(rank).alias("hub"))
        met = at.join(hub.hint("merge"), "sig").where("root <> hub.root")
        return met.selectExpr(
            "least(class, hub.class) AS a", "greatest(class, hub.class) AS b"
        ).distinct()

    def across(self, full: DataFrame) -> DataFrame:
        """Pairs of one mixed bucket in different components.

        Classes outside the center's component meet the rest; sizes and sketches
        are part of the join's condition, so that only possible links come out.
        """
        x = full.where("root <> home").alias("x")
        condition = f"""x.sig = y.sig AND x.root <> y.root
            AND (y.root = y.home OR x.class < y.class)
            AND {possible("x.", "y.", self.percent)}"""
        met = x.join(full.alias("y").hint("merge"), F.expr(condition))
        return met.selectExpr(
            "least(x.class, y.class) AS a", "greatest(x.class, y.class) AS b"
        ).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components; a node without a row is its own root."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        pairs = pairs.join(own.hint("merge"), side, "left")
    apart = F.coalesce("a_root", "a") != F.coalesce("b_root", "b")
    return pairs.where(apart).select("a", "b")


def _links(join: NearJoin) -> DataFrame:
    """(a, b) of similar classes that connect whatever similar pairs connect."""
    members = join.members()
    star = members.where("center <> class").select(
        F.col("center").alias("a"), F.col("class").alias("b")
    )
    # a class meets one of its centers first; then those that this leaves apart
    links = join.links(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    roots = smallest_reachable(links)
    rest = join.links(_apart(star, roots).distinct())
    links = links.unionByName(rest)
    roots = smallest_reachable(links)
    for _ in range(HUB_ROUNDS):
        full = join.mixed(members, roots)
        links = links.unionByName(join.links(join.to_hubs(full, links)))
        drop_tables(full)
        roots = smallest_reachable(links)
    full = join.mixed(members, roots)
    drop_tables(members)
    links = links.unionByName(join.links(join.across(full)))
    drop_tables(full)
    return links


def near_components(
    docs: DataFrame,
    words: int = SHINGLE,
    percent: int = PERCENT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_shingles, component_id), one row per row of ``docs``.

    ``component_id`` is the least key that links reach. Null and empty texts,
    and rows with a null key, are linked with nothing; repeated rows are one
    class; other columns are dropped; an empty table gives an empty one.
    """
    with shuffles_freed(docs.sparkSession):
        join = NearJoin(docs, words, percent, key, text)
        links = _links(join)
        roots = smallest_reachable(links).withColumnRenamed("node", "class")
    placed = join.classes.join(roots.hint("merge"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    least = placed.groupBy("root").agg(F.min("rep").alias("component"))
    placed = placed.join(least.hint("merge"), "root").select("class", "component")
    rows = join.rows.join(placed.hint("merge"), "class", "left")
    alone = F.when((F.col("n") > 0) & F.col("key").isNotNull(), F.col("component"))
    return rows.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce(alone, F.col("key")).alias("component_id"),
    )
