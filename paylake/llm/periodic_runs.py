"""Periodic runs of words by online dyadic square catching.

A run is a longest stretch of words of smallest period q that is at least ``EXPONENT`` times q
and ``LEAST`` words long. Words are appended, a chunk of any size at a time; what is found does
not depend on the chunks.

1. For each power of two L, blocks of L words start at every multiple of L/2. When a block
   is complete, a catcher watches the L words after it for the block's first return.
2. Each appended word moves the suffix of L words that a catcher compares with its block.
   Suffixes are compared by hashes of their halves' hashes; a return is then checked word by
   word. A block whose next L/2 words are not all repeats of words at most L back has no
   return for its catcher, so most catchers are let go before anything is hashed.
3. A return p words on, L/2 < p <= L, shows a square of period p, and p is its smallest: a
   nearer return would have been met before. Nearer returns are left to shorter blocks.
4. Squares of one period that touch merge; what a merged stretch may lack at its ends is
   less than L/2 words, which are compared one by one.

No run is missed: for its period q let L be the power of two in [q, 2q). Of the run's 4q words
some block and the q words after it lie within, since L/2 - 1 + L + q <= 4q; being L >= q words
long, the block returns after q words and, by the theorem of Fine and Wilf, not before.
The work grows with n log(n)^2 at most, whatever the words are.

A null or empty text has no words and no runs. Rows are looked at one by one: repeated rows
and null ids come out as they went in, an empty table gives no rows, other columns than the two
named are not looked at. Texts of any length are taken whole; one that is longer than
``GROUP_BYTES`` makes a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import groups, keyed_text, mix

# What counts as a run. The grid of blocks holds for this exponent and larger ones.
EXPONENT, LEAST = 4, 6
GROUP_BYTES = 2 << 20
# Words that the catchers of one length look at in one step.
STEP_WORDS = 1 << 20
_FAR = np.int64(1) << np.int64(60)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Catchers:
    """Words appended so far, and the squares caught in them."""

    def __init__(self):
        self.words = np.empty(0, np.int64)
        self.back = np.empty(0, np.int64)  # how far back the same word stands, or _FAR
        self.last = np.empty(0, np.int64)  # where each word was seen last
        self.next_block: list[int] = []  # by length: the first block not yet let go
        self.streak = self.longest = 0  # words without a new one: up to the end, at most
        self.caught: list[tuple[np.ndarray, np.ndarray, int]] = []

    def append(self, words: np.ndarray) -> None:
        """Adds words, given as numbers from 0 on, and catches the squares that they complete."""
        words = np.asarray(words, np.int64)
        if len(words):
            self._look_back(words)
            self.words = np.concatenate([self.words, words])
            self._catch(len(self.words), ended=False)

    def finish(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and periods of all runs, by start, then period."""
        self._catch(len(self.words), ended=True)
        found = [self._merged(level) for level in range(len(self.next_block))]
        start, length, period = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 3
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]

    def _look_back(self, words: np.ndarray) -> None:
        at, top = len(self.words), int(words.max()) + 1
        if top > len(self.last):
            self.last = np.concatenate([self.last, np.full(top - len(self.last), -_FAR)])
        keyed = np.sort(words << np.int64(32) | np.arange(len(words)))
        word, place = keyed >> np.int64(32), keyed & np.int64(0xFFFFFFFF)
        first = np.diff(word, prepend=-1) != 0
        back = np.empty(len(words), np.int64)
        back[place[1:]] = np.diff(place)
        back[place[first]] = np.minimum(at + place[first] - self.last[word[first]], _FAR)
        ends = np.append(first[1:], True)
        self.last[word[ends]] = at + place[ends]
        self.back = np.concatenate([self.back, back])
        new = np.flatnonzero(back == _FAR)
        if len(new):
            gaps = np.diff(new) - 1
            self.longest = max(self.longest, self.streak + int(new[0]), int(gaps.max(initial=0)))
            self.streak = len(words) - 1 - int(new[-1])
        else:
            self.streak += len(words)
        self.longest = max(self.longest, self.streak)

    def _catch(self, n: int, ended: bool) -> None:
        """Lets go of all catchers that have seen their L words, or of all when it ended."""
        level = 0
        while True:
            size = 1 << level
            # A catcher's least need: the block, and half a block and a word after it.
            need = size + size // 2 + 1 if ended else 2 * size
            if need > n or size // 2 + 1 > self.longest:
                return
            if level == len(self.next_block):
                self.next_block.append(0)
            step, start = max(1, size // 2), self.next_block[level]
            blocks = np.arange(start, n - need + 1, step)
            if len(blocks):
                self.next_block[level] = int(blocks[-1]) + step
                foreign = np.cumsum(self.back[start:] > size)
                first = blocks - start + size
                blocks = blocks[foreign[first + size // 2] == foreign[first - 1]]
                rows = max(1, STEP_WORDS // (2 * size))
                for i in range(0, len(blocks), rows):
                    self._watch(blocks[i : i + rows], level)
            level += 1

    def _watch(self, blocks: np.ndarray, level: int) -> None:
        """Catches the blocks whose first return is more than half their length away."""
        n, size = len(self.words), 1 << level
        places = blocks[:, None] + np.arange(2 * size)
        # Past the end stand words that are equal to none.
        own = np.where(places < n, self.words[np.minimum(places, n - 1)], -1 - places)
        hashes = mix(own.astype(np.uint64) * _ODD)
        half = 1
        while half < size:
            hashes = mix(hashes[:, :-half] * _ODD + hashes[:, half:])
            half *= 2
        returns = hashes[:, 1:] == hashes[:, :1]
        period = returns.argmax(axis=1) + 1
        met = returns.any(axis=1) & (2 * period > size)
        own, period, blocks = own[met], period[met], blocks[met]
        after = period[:, None] + np.arange(size)
        same = (own[:, :size] == np.take_along_axis(own, after, axis=1)).all(axis=1)
        if same.any():
            self.caught.append((blocks[same], period[same], level))

    def _merged(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs whose squares were caught by blocks of one length."""
        mine = [(b, p) for b, p, k in self.caught if k == level]
        if not mine:
            return (np.empty(0, np.int64),) * 3
        size = 1 << level
        block = np.concatenate([b for b, _ in mine])
        period = np.concatenate([p for _, p in mine])
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        # Words i and i + period are equal for i in [low, high).
        new = (np.diff(period, prepend=0) != 0) | (np.diff(block, prepend=-_FAR) > size)
        low, period = block[new], period[new]
        high = block[np.append(new[1:], True)] + size
        short = size // 2  # at most so many words less one are missing at either end
        able = high - low + 2 * short >= np.maximum(EXPONENT * period, LEAST) - period
        low, high, period = low[able], high[able], period[able]
        if short:
            low = low - self._equal(low, period, short, -1)
            high = high + self._equal(high, period, short, 1)
        length = high - low + period
        run = length >= np.maximum(EXPONENT * period, LEAST)
        return low[run], length[run], period[run]

    def _equal(self, at: np.ndarray, period: np.ndarray, most: int, way: int) -> np.ndarray:
        """How many words from each place on, or before it, equal those a period later."""
        n, out = len(self.words), np.zeros(len(at), np.int64)
        rows = max(1, STEP_WORDS // most)
        for i in range(0, len(at), rows):
            steps = np.arange(most) if way > 0 else -1 - np.arange(most)
            here = at[i : i + rows, None] + steps
            there = here + period[i : i + rows, None]
            same = (here >= 0) & (there < n)
            same &= self.words[here.clip(0, n - 1)] == self.words[there.clip(0, n - 1)]
            out[i : i + rows] = np.where(same.all(axis=1), most, (~same).argmax(axis=1))
        return out


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one sequence."""
    catchers = Catchers()
    catchers.append(words)
    return list(zip(*(x.tolist() for x in catchers.finish()), strict=True))


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>,"
    " collapsed string"
)


def _group(texts: list[bytes]) -> tuple[list[int], pa.Array, list[bytes]]:
    """Word counts, runs and collapsed texts of a group of texts.

    The words of all texts are one sequence, with a word of its own behind each text.
    """
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = pa.array(chain.from_iterable(split), pa.binary(), size=int(counts.sum()))
    coded = flat.dictionary_encode()
    ends = np.cumsum(counts + 1)  # behind each text's own mark
    words = np.empty(int(ends[-1]), np.int64)
    marks = np.zeros(len(words), bool)
    marks[ends - 1] = True
    words[~marks] = coded.indices.to_numpy(zero_copy_only=False)
    words[marks] = len(coded.dictionary) + np.arange(len(texts))
    catchers = Catchers()
    catchers.append(words)
    start, length, period = catchers.finish()
    doc = np.searchsorted(ends, start, side="right")
    begins = ends - counts - 1
    drops = np.zeros(len(words) + 1, np.int64)
    np.add.at(drops, start + period, 1)
    np.add.at(drops, start + length, -1)
    dropped = np.cumsum(drops) > 0
    offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
    fields = [pa.array(x) for x in (start - begins[doc], length, period)]
    runs = pa.StructArray.from_arrays(fields, fields=list(_RUNS.value_type))
    collapsed = []
    for i, own in enumerate(split):
        if offsets[i + 1] > offsets[i]:
            own = compress(own, ~dropped[begins[i] : ends[i] - 1])
        collapsed.append(b" ".join(own))
    return counts.tolist(), pa.ListArray.from_arrays(offsets, runs), collapsed


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its words, its runs, and its text without repeats.

    ``runs`` are by start, then period. ``collapsed`` has the words that no run holds after
    its first period, joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            sizes = pc.binary_length(texts).to_pylist()
            for start, end in groups(sizes, GROUP_BYTES):
                counts, runs, collapsed = _group(texts.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, end - start),
                        pa.array(counts, pa.int64()),
                        runs,
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return keyed_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the words of every tenth text, by a hash of its id, come to repeat.

    With h the crc32 of the id as text, n words, g = h div 10: if 10 divides h, each word from
    a = g mod n on is the word at a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeating(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")

        def at(i: Column) -> Column:
            return F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

        return F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("long"), n - 1), at))

    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    # An array of one stands for a name: the words are split once, not for each of them.
    named = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeating(w)).otherwise(""))
    planted = F.when(h % 10 == 0, F.get(named, F.lit(0))).otherwise(F.col("text"))
    return keyed_text(docs).select("doc_id", planted.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run and checksums of what ``find_runs`` found."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]),
        )
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    named = found.withColumn("longest", longest)
    fields = F.col("longest")
    start, length, period = -fields["col2"], fields["length"], -fields["col3"]
    return named.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
