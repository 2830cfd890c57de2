"""Token counts of every prefix of a text, by dynamic programming.

The encoding of a prefix is the encoding of a shorter one and a last token, and
a row of tokens is the encoding of its bytes just if each two neighbours are
the encoding of theirs. So going from byte to byte, the last token of a prefix
is the one token that ends there and keeps its place beside the last token of
the prefix before it; its count is that prefix's count and one. What two
neighbours do is found by undoing their merges, latest first, and remembered.

With the counts of all prefixes at hand, questions of truncation and budget
(:func:`longest_prefix`, :func:`tokens_between`) encode nothing again.
"""

from __future__ import annotations

import gc
import json
import os
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8
from matchwright.llm.byte_level import RUNS, WHITE_RUN, letter_bytes, token_bytes

CACHED_BYTES = 160 << 20
PAIRS = 1 << 20
# one word of letters that all versions of Unicode call so, after a blank at most
_WORD = re.compile(r" ?(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ʯ]+)([!-&(-/:-@]*)")
NEVER = 1 << 60


class Merges:
    """A byte-level BPE file: tokens numbered by rank, what made each, an automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE")
        if pre["add_prefix_space"] or not pre["use_regex"] or model.get("ignore_merges"):
            raise ValueError(f"{path} needs settings that prefixes do not follow")
        added = spec["added_tokens"]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        letters = letter_bytes()
        self.added = [a["content"] for a in added]
        ranks = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.joined: dict[int, int] = {}
        for pair in model["merges"]:
            left, right = (
                token_bytes(t, letters) for t in (pair.split(" ") if isinstance(pair, str) else pair)
            )
            rank = len(self.parts)
            self.parts.append((ranks[left], ranks[right]))
            self.joined[ranks[left] << 32 | ranks[right]] = rank
            ranks.setdefault(left + right, rank)
        if len(ranks) != len(self.parts):
            raise ValueError(f"{path} makes one token in two ways")
        self.tokens = ahocorasick.Automaton()
        self.size = [0] * len(self.parts)
        for token, rank in ranks.items():
            self.size[rank] = len(token)
            self.tokens.add_word(token.decode("latin-1"), rank)
        self.tokens.make_automaton()
        self.kept: dict[int, bool] = {}
        self.before: tuple[bytes, list[int], list[int]] = (b"", [0], [0])

    def keeps(self, left: int, right: int) -> bool:
        """Whether these two tokens, in this order, are the encoding of their bytes.

        Their merges are undone, latest first (of one and the same merge, the
        right one comes later). At each state the symbols that touch must not
        have been joined before either went on; of equal ranks the leftmost
        pair is joined first.
        """
        joined, parts = self.joined, self.parts
        left_end = right_end = NEVER
        while True:
            rank = joined.get(left << 32 | right)
            if rank is not None and rank < left_end and rank <= right_end:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                left_end, left = left, parts[left][1]
            else:
                right_end, right = right, parts[right][0]

    def counts(self, word: bytes) -> list[int]:
        """Tokens of each prefix of ``word``, that of no bytes first.

        The automaton names the tokens that end at a byte longest first; just
        one of them keeps its place. What the word has in common with the one
        before it is known already.
        """
        size, kept, keeps = self.size, self.kept, self.keeps
        before, last, count = self.before
        same, most = 0, min(len(before), len(word))
        while same < most and before[same] == word[same]:
            same += 1
        last, count = last[: same + 1], count[: same + 1]
        done = same
        for end, rank in self.tokens.iter(word.decode("latin-1")):
            if end < done:
                continue
            start = end + 1 - size[rank]
            if start:
                pair = last[start] << 32 | rank
                fine = kept.get(pair)
                if fine is None:
                    fine = keeps(last[start], rank)
                    if len(kept) < PAIRS:
                        kept[pair] = fine
                if not fine:
                    continue
            last.append(rank)
            count.append(count[start] + 1)
            done += 1
        self.before = word, last, count
        return count


@lru_cache(maxsize=2)
def load_merges(path: str) -> Merges:
    return Merges(path)


class PrefixCounter:
    """Counts of all prefixes of texts, run by run; runs are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.merges = load_merges(path)
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = "|".join(map(re.escape, sorted(self.merges.added, key=len, reverse=True)))
        self.special = re.compile(f"({special})") if special else None
        self.runs: dict[str, bytes] = {}
        self.matches: dict[str, list[int]] = {}
        self.held = 0

    def _chars(self, text: str) -> list[int]:
        """Counts of the prefixes of one match, by characters."""
        out = self.matches.get(text)
        if out is None:
            raw = text.encode()
            counts = self.merges.counts(raw)
            if len(raw) == len(text):
                out = counts[1:]
            else:
                ends = [i for i in range(1, len(raw)) if raw[i] & 0xC0 != 0x80]
                out = [counts[i] for i in ends] + counts[-1:]
            self.matches[text] = out
            self.held += 12 * len(text) + 200
        return out

    def _run(self, run: str) -> list[int]:
        """Counts of the prefixes of white space and what follows it.

        A prefix that ends in the white space ends with one match of all of
        it; one that ends later has the matches of the whole run, the last of
        them cut. Only a contraction, cut, is an apostrophe and letters.
        """
        plain = _WORD.fullmatch(run)
        if plain:
            cut = plain.start(1)
            own = self._chars(run[:cut])
            return own + [own[-1] + n for n in self._chars(run[cut:])] if cut < len(run) else own
        blank = WHITE_RUN.match(run).end()
        out = list(self._chars(run[:blank])) if blank else []
        if blank == len(run):
            return out
        before = 0
        for _, (start, end) in self.cut(run):
            match = run[start:end]
            own = self._chars(match)
            if match[0] == "'" and end - start > 1 and match[1].isalpha():
                own = [1, *(1 + n for n in self._chars(match[1:-1])), own[-1]]
            for n in own[max(blank - start, 0) :]:
                out.append(before + n)
            before += own[-1]
        return out

    def flat(self, texts: list[str]) -> np.ndarray:
        """Counts of all prefixes of these texts, which hold no added token."""
        cut = [RUNS.findall(t) for t in texts]
        fresh = set().union(*cut).difference(self.runs)
        for run in sorted(fresh):
            self.runs[run] = np.array(self._run(run), np.int32).tobytes()
            self.held += 5 * len(run) + 160
        runs = [run for own in cut for run in own]
        values = np.frombuffer(b"".join(map(self.runs.__getitem__, runs)), np.int32)
        # each run goes on from the total of those before it in its text
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        totals = values[np.cumsum(sizes) - 1].astype(np.int64) if len(runs) else sizes
        before = np.cumsum(totals) - totals
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        first = np.cumsum(per_text) - per_text
        own = np.repeat(before[np.minimum(first, max(len(runs) - 1, 0))] if len(runs) else first, per_text)
        if self.held > CACHED_BYTES:
            self.runs, self.matches, self.held = {}, {}, 0
        return values + np.repeat(before - own, sizes).astype(np.int32)

    def _with_added(self, text: str) -> np.ndarray:
        """An added token is one token once it is whole, and plain text before."""
        parts, out, base = self.special.split(text), [], 0
        for k in range(0, len(parts), 2):
            added = parts[k + 1] if k + 1 < len(parts) else ""
            own = self.flat([parts[k] + added])
            if added:
                own[-1] = (own[len(parts[k]) - 1] if parts[k] else 0) + 1
            out.append(own + np.int32(base))
            base += int(own[-1]) if len(own) else 0
        return np.concatenate(out)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All counts, and where each text's begin (and the last's end)."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = np.concatenate([[0], ends])
        special = [i for i, t in enumerate(texts) if self.special and self.special.search(t)]
        if not special:
            return self.flat(texts), starts
        parts, done = [], 0
        for i in special:
            parts += [self.flat(texts[done:i]), self._with_added(texts[i])]
            done = i + 1
        return np.concatenate([*parts, self.flat(texts[done:])]), starts


@lru_cache(maxsize=1)
def load_counter(path: str) -> PrefixCounter:
    """One per worker: what a task has learnt, the next one knows."""
    return PrefixCounter(path)


def prefix_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, counts) of every row: whole texts, every prefix.

    ``counts[i]`` are the tokens of the first i + 1 characters (code points),
    as the tokenizers library gives them for these characters alone, without
    special tokens of its own; strings of added tokens inside a text are these
    tokens, as by its default. Null and empty texts have an empty array and no
    bytes; null keys and repeated rows are rows like any other; a text of n
    characters takes 4n bytes of counts in its row; other columns are dropped;
    an empty table gives an empty one.
    """
    spread = df.select(df[key].alias("key"), utf8(df[text]).alias("text"))

    def make():
        counter = load_counter(path)
        gc.disable()  # many short-lived lists, no cycles

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = batch.column("text").to_pylist()
            counts, starts = counter.counts([t.decode() for t in raw])
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(list(map(len, raw)), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(counts, pa.int32())),
                ],
                ["key", "n_bytes", "counts"],
            )

        return work

    kind = spread.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, counts array<int>"
    return map_slices(spread, "text", schema, make).withColumnRenamed("key", key)


def n_tokens(counts: str = "counts") -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.try_element_at(counts, F.lit(-1)), F.lit(0)).cast("long")


def longest_prefix(budget: int, counts: str = "counts") -> Column:
    """Characters of the longest prefix that takes at most ``budget`` tokens."""
    fits = F.transform(counts, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0))


def tokens_between(start: Column, end: Column, counts: str = "counts") -> Column:
    """Tokens that the characters from ``start`` to ``end`` add to the prefix before them."""

    def at(n: Column) -> Column:
        return F.when(n > 0, F.try_element_at(counts, n.cast("int"))).otherwise(0)

    return at(end) - at(start)
