"""Benchmark passages in documents, found by the CGK embedding and confirmed by edit distance.

Words are runs of anything but ASCII white space, A-Z in lower case. A document holds an
item of L words if some passage of it is within ``tolerance`` * L word edits (rounded down;
insertions, deletions, replacements) of the whole item.

1. Items are put in classes of similar length. At every word of a document stands one
   window for each class, as long as the class's shortest item.
2. A window with more words foreign to the class's items than edits allowed, or with too
   many repeated words besides, cannot match and is left out; this loses nothing.
3. The CGK random walk copies a window's words to ``STRETCH`` times as many places, going on
   to the next word when a random bit of (place, word) says so. Small edit distance becomes
   small Hamming distance.
4. Bit-sampling: words at ``SAMPLED`` random places are a key; ``TABLES`` keys for each walk.
   Walks are repeated until ``TARGET`` of randomly edited items, with as many edits as are
   allowed, share a key with their item. A class that needs more than ``MAX_WALKS``, as long
   items do, has no keys: its windows go against all its items.
5. A window and an item that share a key, or need none, are verified: first by how many of the window's
   words the item has, then by the exact edit distance of the item and the passage.

The items are the query set, so they are collected, and go against all documents in blocks
of ``BLOCK_ITEMS``. Null or empty texts hold nothing; null or wordless items match nothing.
Rows are handled one by one, so repeated rows and null ids come out as they went in.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import keyed_text, mix, slices, word_hashes

TOLERANCE = 0.2
STRETCH, SAMPLED, TABLES = 3, 2, 16
TARGET, MAX_WALKS = 0.998, 24
TRIALS = 400
CLASS_RATIO = 1.3
BLOCK_ITEMS = 5_000
_WINDOWS = 4_000  # windows embedded at a time


def embed(windows: np.ndarray, walk: int, places: int) -> np.ndarray:
    """The CGK walk over rows of word hashes: a row of ``places`` words for each, 0 at its end."""
    n, c = windows.shape
    padded = np.hstack([windows, np.zeros((n, 1), np.uint64)]).reshape(-1)
    base, at = np.arange(n) * (c + 1), np.zeros(n, np.int64)
    out = np.empty((places, n), np.uint64)
    steps = np.arange(places, dtype=np.uint64) + np.uint64(walk * 1_000_003 + 1)
    factors = mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for j in range(places):
        word = padded[base + at]
        out[j] = word
        at += ((word * factors[j]) >> np.uint64(63)).astype(np.int64)
        np.minimum(at, c, out=at)
    return out.T


def sampled_keys(windows: np.ndarray, walk: int) -> np.ndarray:
    """A row of TABLES keys for each window; 0 where a sampled place is beyond its end."""
    places = STRETCH * windows.shape[1]
    random = np.random.default_rng([walk, places])
    chosen = np.sort(random.integers(0, places, (TABLES, SAMPLED)), axis=1)
    walked = embed(windows, walk, places)
    keys = np.empty((len(windows), TABLES), np.uint64)
    for t, at in enumerate(chosen):
        words = walked[:, at]
        key = np.full(len(windows), walk * TABLES + t + 1, np.uint64)
        for j in range(SAMPLED):
            key = mix(key ^ words[:, j])
        keys[:, t] = np.where((words == 0).any(axis=1), 0, key)
    return keys


def passage_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Fewest edits between the item and any passage of the region; the passage's end."""
    j = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, word in enumerate(item, 1):
        replaced = row[:-1] + (region != word)
        best = np.concatenate([[i], np.minimum(replaced, row[1:] + 1)])
        row = np.minimum.accumulate(best - j) + j
    return int(row.min()), int(row.argmin())


def passage_start(item: np.ndarray, region: np.ndarray, end: int) -> int:
    """Where the passage begins that ends at ``end`` with the fewest edits."""
    _, length = passage_distance(item[::-1], region[:end][::-1])
    return end - length


@dataclass
class LengthClass:
    """Items of similar length, their keys, and what is needed to rule windows out."""

    size: int
    ids: np.ndarray
    items: list[np.ndarray]
    allowed: np.ndarray
    vocabulary: np.ndarray
    has: np.ndarray  # item by word of the vocabulary: how often it occurs
    repeats: int = 0  # most words of an item that equal their predecessor
    walks: int = 0
    keys: np.ndarray | None = None
    owners: np.ndarray | None = None
    exact: bool = False  # too many walks would be needed: keys are not used

    @classmethod
    def of(cls, size: int, ids: list, items: list[np.ndarray], tolerance: float) -> LengthClass:
        vocabulary = np.unique(np.concatenate(items))
        has = np.zeros((len(items), len(vocabulary) + 1), np.uint16)
        for i, words in enumerate(items):
            np.add.at(has[i], np.searchsorted(vocabulary, words), 1)
        allowed = np.array([int(tolerance * len(w) + 1e-9) for w in items])
        repeats = max(int((w[1:] == w[:-1]).sum()) for w in items)
        own = cls(size, np.array(ids, object), items, allowed, vocabulary, has, repeats)
        own._plan()
        return own

    def _plan(self) -> None:
        """Adds walks until the target share of edited items meets its item."""
        heads = np.array([w[: self.size] for w in self.items])
        random = np.random.default_rng(self.size)
        picked = random.integers(0, len(self.items), TRIALS)
        edited = np.array([self._edited(i, random) for i in picked])
        met = np.zeros(TRIALS, bool)
        keys, owners = [], []
        while self.walks < MAX_WALKS and (self.walks < 2 or met.mean() < TARGET):
            own = sampled_keys(heads, self.walks)
            changed = sampled_keys(edited, self.walks)
            met |= ((own[picked] == changed) & (changed != 0)).any(axis=1)
            keys.append(own.reshape(-1))
            owners.append(np.repeat(np.arange(len(heads)), TABLES))
            self.walks += 1
        self.exact = bool(met.mean() < TARGET)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        order = order[keys[order] != 0]
        self.keys, self.owners = keys[order], owners[order]

    def _edited(self, i: int, random: np.random.Generator) -> np.ndarray:
        """A window of the item's words after as many random edits as are allowed."""
        words = self.items[i].tolist()
        for _ in range(self.allowed[i]):
            at, kind = int(random.integers(0, len(words))), int(random.integers(0, 3))
            other = int(random.choice(self.vocabulary))
            if kind == 0:
                words[at] = other
            elif kind == 1:
                words.insert(at, other)
            elif len(words) > 1:
                del words[at]
        words += random.choice(self.vocabulary, self.size).tolist()
        return np.array(words[: self.size], np.uint64)

    def candidates(
        self, flat: np.ndarray, place: np.ndarray, room: np.ndarray, same: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) of windows that share enough words with an item, and a key if it has any.

        ``place`` is each word's place in the vocabulary (its length if none), ``room`` how
        many words its document has from there on, ``same`` whether it equals the word before
        it. Windows may run into the document's end.
        """
        n, most = len(flat), int(self.allowed.max())
        foreign = np.zeros(n + self.size + 1, np.int32)
        np.cumsum(place == len(self.vocabulary), out=foreign[1 : n + 1])
        foreign[n + 1 :] = foreign[n]
        # A window that runs into the end has still fewer words to match; that is seen below.
        starts = np.flatnonzero(foreign[self.size : n + self.size] - foreign[:n] <= most)
        length = np.minimum(room[starts], self.size)
        ends = starts + length
        strange = foreign[ends] - foreign[starts] + self.size - length
        # Two equal words of the vocabulary in a row, where the item has none, cost an edit of
        # one of them (which may serve two such pairs) or a deletion between them. A deletion
        # may also have let a word behind the passage into the window, a strange one or one
        # more of a pair. So strange words and pairs together are at most twice the edits.
        again = np.cumsum(same & (place < len(self.vocabulary)), dtype=np.int32)
        pairs = np.maximum(again[ends - 1] - again[starts] - self.repeats, 0)
        starts = starts[(strange <= most) & (strange + pairs <= 2 * most)]
        if self.exact:
            return self._by_words(place, starts, np.minimum(room[starts], self.size))
        found_start, found_item = [], []
        offsets = np.arange(self.size)
        for i in range(0, len(starts), _WINDOWS):
            part = starts[i : i + _WINDOWS]
            at = part[:, None] + offsets
            inside = offsets < room[part][:, None]
            at = np.minimum(at, n - 1)
            windows = np.where(inside, flat[at], np.uint64(1))
            for walk in range(self.walks):
                keys = sampled_keys(windows, walk)
                low = np.searchsorted(self.keys, keys.reshape(-1), "left")
                high = np.searchsorted(self.keys, keys.reshape(-1), "right")
                count = np.where(keys.reshape(-1) == 0, 0, high - low)
                hit = np.flatnonzero(count)
                if not len(hit):
                    continue
                which = np.repeat(hit, count[hit])
                step = np.arange(len(which)) - np.repeat(
                    np.cumsum(count[hit]) - count[hit], count[hit]
                )
                item = self.owners[low[which] + step]
                pair = np.unique((which // TABLES) * len(self.items) + item)
                row, item = pair // len(self.items), pair % len(self.items)
                # A matching window has at most as many words that are not the item's.
                words = np.where(inside[row], place[at[row]], len(self.vocabulary))
                enough = (self.has[item[:, None], words] == 0).sum(axis=1) <= self.allowed[item]
                row, item, words = row[enough], item[enough], words[enough]
                # Nor does it hold a word more often than the item, but for edits.
                turn = np.zeros(words.shape, np.int64)
                for j in range(1, self.size):
                    turn[:, j] = (words[:, :j] == words[:, j : j + 1]).sum(axis=1)
                enough = (turn >= self.has[item[:, None], words]).sum(axis=1) <= self.allowed[item]
                found_start.append(part[row[enough]])
                found_item.append(item[enough])
        if not found_start:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pair = np.unique(
            np.concatenate(found_start) * len(self.items) + np.concatenate(found_item)
        )
        return pair // len(self.items), pair % len(self.items)

    def _by_words(
        self, place: np.ndarray, starts: np.ndarray, length: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) of all windows with at most as many words foreign to the item as edits."""
        found_start, found_item = [starts[:0]], [starts[:0]]
        for i in range(len(self.items)) if len(starts) else ():
            known = np.concatenate([[0], np.cumsum((self.has[i] > 0)[place], dtype=np.int32)])
            own = self.size - (known[starts + length] - known[starts])
            fits = starts[own <= self.allowed[i]]
            found_start.append(fits)
            found_item.append(np.full(len(fits), i))
        return np.concatenate(found_start), np.concatenate(found_item)


@dataclass
class Matcher:
    classes: list[LengthClass]

    def find(self, texts: list[str]) -> list[tuple[int, object, int, int, int]]:
        """(text, item id, edits, start word, end word) of the best passage for each pair."""
        flat, counts = word_hashes(texts)
        if not len(flat) or not self.classes:
            return []
        ends = np.cumsum(counts)
        owner = np.repeat(np.arange(len(texts)), counts)
        room = ends[owner] - np.arange(len(flat))
        same = np.concatenate([[False], flat[1:] == flat[:-1]])
        every = np.unique(np.concatenate([own.vocabulary for own in self.classes]))
        known = np.minimum(np.searchsorted(every, flat), len(every) - 1).astype(np.int32)
        known[every[known] != flat] = len(every)
        out = []
        for own in self.classes:
            at = np.full(len(every) + 1, len(own.vocabulary), np.int32)
            at[np.searchsorted(every, own.vocabulary)] = np.arange(len(own.vocabulary))
            place = at[known]
            starts, items = own.candidates(flat, place, room, same)
            order = np.lexsort((starts, items))
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            done = (-1, -1, -1)  # text, item and last start that the last look has covered
            for start, i in zip(starts[order].tolist(), items[order].tolist(), strict=True):
                text = int(owner[start])
                if done[:2] == (text, i) and start <= done[2]:
                    continue
                words, allowed = own.items[i], int(own.allowed[i])
                first = int(ends[text] - counts[text])
                low = max(first, start - allowed)
                high = min(int(ends[text]), start + len(words) + 2 * allowed + 1)
                region = flat[low:high]
                edits, end = passage_distance(words, region)
                done = (text, i, start + allowed)
                if edits <= allowed and (text, i) not in best or (
                    edits <= allowed and edits < best[text, i][0]
                ):
                    begin = passage_start(words, region, end)
                    best[text, i] = (edits, low + begin - first, low + end - first)
            out += [(t, own.ids[i], *hit) for (t, i), hit in best.items()]
        return out


def build_matcher(
    items: Iterable[tuple[object, str]], tolerance: float = TOLERANCE
) -> Matcher:
    """Classes of items with words; each class is as long as its shortest item."""
    items = [(i, t) for i, t in items if t]
    hashes, counts = word_hashes([t for _, t in items])
    pieces = np.split(hashes, np.cumsum(counts)[:-1]) if len(items) else []
    sized = sorted(
        ((len(w), i, w) for (i, _), w in zip(items, pieces, strict=True) if len(w)),
        key=lambda x: (x[0], str(x[1])),
    )
    classes, group = [], []
    for entry in sized:
        if group and entry[0] > max(group[0][0] * CLASS_RATIO, group[0][0] + 1):
            classes.append(group)
            group = []
        group.append(entry)
    classes += [group] if group else []
    return Matcher(
        [LengthClass.of(g[0][0], [e[1] for e in g], [e[2] for e in g], tolerance) for g in classes]
    )


def _matchers(
    benchmark: DataFrame, id_col: str, text_col: str, tolerance: float
) -> Iterator[Matcher]:
    items = keyed_text(benchmark, id_col, text_col).filter("text <> ''").distinct()
    rows = sorted(
        ((r["doc_id"], r["text"]) for r in items.collect()), key=lambda r: (r[0] is None, *map(str, r))
    )
    for i in range(0, len(rows), BLOCK_ITEMS):
        yield build_matcher(rows[i : i + BLOCK_ITEMS], tolerance)


SCHEMA = "doc_id long, item_id long, edits int, start_word long, end_word long"


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each row of ``docs`` and item that it holds: the closest passage."""
    rows = keyed_text(docs, id_col, text_col)

    def search(matcher: Matcher):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 500):
                ids = batch["doc_id"].to_pylist()
                found = matcher.find(batch["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[x[0]] for x in found], pa.int64()),
                        pa.array([x[1] for x in found], pa.int64()),
                        pa.array([x[2] for x in found], pa.int32()),
                        pa.array([x[3] for x in found], pa.int64()),
                        pa.array([x[4] for x in found], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "edits", "start_word", "end_word"],
                )

        return run

    out = None
    for matcher in _matchers(benchmark, item_id_col, item_text_col, tolerance):
        part = rows.mapInArrow(search(matcher), SCHEMA)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def without_passages(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with all their columns."""
    own = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))

    def clean(matcher: Matcher) -> Column:
        @F.pandas_udf("boolean")
        def test(texts: pd.Series) -> pd.Series:
            out, values = np.ones(len(texts), bool), texts.tolist()
            for i in range(0, len(values), 500):
                for hit in matcher.find(values[i : i + 500]):
                    out[i + hit[0]] = False
            return pd.Series(out)

        return test(own)

    for matcher in _matchers(benchmark, "item_id", "text", tolerance):
        docs = docs.filter(clean(matcher))
    return docs
