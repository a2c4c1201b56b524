"""Toxicity by a support vector machine on a subsequence string kernel with landmarks.

The kernel of two words sums, over common subsequences of ``LENGTH`` characters, a weight
that falls by ``DECAY`` with every character either occurrence spans beyond its letters;
occurrences span at most ``SPAN`` characters. So a word with characters inserted still
resembles the insult it hides. Signs are gaps that cost nothing: ``i.d.i.o.t`` is ``idiot``.
Single letters a blank apart are one word from ``LENGTH`` of them on. Neighbours a blank apart
count as one word beside being two, if all strings of ``LENGTH`` letters over the blank stand
in some landmark (a blank has cut an insult in two). Letters of more than ``LONG`` in a row are read
in overlapping windows, so that far parts do not add up.

Landmarks are short strings that set toxic learning texts apart, and common strings of
clean ones, both found in the learning sample. A text's row holds, for each landmark, the
kernel of its most similar word relative to the landmark with itself, turned into
coordinates by the inverse root of the landmarks' kernel matrix (Nystroem); the logarithm of
the sum of a sharpened kernel over all its words, which is a kernel of documents; and both
again for all telling landmarks together. A linear machine with squared hinge loss is
trained on labelled texts, some of them a second time with words hidden in these ways, and its
margins are mapped to 0..1 by a logistic function.

Not seen through: insults cut into three parts, cut over a line break or by several blanks,
cut with letters inserted at the cut, with letters replaced, or spelt with more than
``SPAN - LENGTH`` inserted letters around.

A null text is an empty one and has a score. Rows are scored one by one: repeated rows and
null ids come out as they went in. Without texts of both labels every score is 0.25. Whole
texts are read; words of any length are.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm import training
from paylake.llm.common import keyed_text, mix, slices

LENGTH, SPAN, DECAY = 3, 8, 0.8
LANDMARKS, CONTRAST, COVER = 64, 16, 3
GRAMS = (4, 5, 6)
# Kernels below the floor count as 0: sharpened, they would add less than a thousandth.
# A power of a kernel is a kernel, and keeps words that are only somewhat alike apart; the
# document's kernel sums a power of that power.
FLOOR, POWER, SHARP = 0.4, 3, 3
MARK = "\x02"  # stands before each word, so that strings and subsequences can begin there
# Learning texts: at most so many rows, of at most so many characters each.
SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 20_000
HIDDEN = 2_400  # learning texts that are learned a second time with their words hidden
FEWEST = 0.005  # share of the toxic texts that a further string must cover
SHARED = 2.0  # weight of what all telling landmarks share over what each has of its own
PURITY = 5  # toxic texts a string must cover for each clean one, both as shares
SLICE = 250  # texts that are scored at a time
BLOCK = 4_096  # distinct words whose subsequences are held at a time
LONG, WINDOW = 24, 12  # letters of a word from which on it is read in windows, of this size
_BINS = 1 << 22
_SIGNS = re.compile(r"[^\w\s\x02]|_")
_BREAKS = re.compile(r"\s\s+|[^\S ]")
_GAPS = [
    gaps
    for gaps in itertools.product(range(1, SPAN), repeat=LENGTH - 1)
    if sum(gaps) < SPAN
]


def _blocks(letters: str) -> list[str]:
    """The letters behind a mark; long ones as overlapping windows, so that kernels stay local.

    An empty string between two windows says that they are no neighbours.
    """
    if len(letters) <= LONG:
        return [MARK + letters]
    out = [MARK + letters[:WINDOW]]
    for i in range(WINDOW // 2, len(letters) - WINDOW // 2, WINDOW // 2):
        out += ["", letters[i : i + WINDOW]]
    return out


def words_of(text: str) -> list[str]:
    """Words in lower case, each behind a mark, without the signs in and around them.

    Single letters a blank apart are one word from ``LENGTH`` of them on. An empty string
    stands where words are more than one blank apart.
    """
    words = _SIGNS.sub("", _BREAKS.sub(f" {MARK} ", text.lower())).split()
    sizes = list(map(len, words))
    spaced = sizes.count(1) >= LENGTH and any(
        a == b == c == 1 for a, b, c in zip(sizes, sizes[1:], sizes[2:], strict=False)
    )
    if not spaced and max(sizes, default=0) <= LONG:
        return [MARK + w if w != MARK else "" for w in words]
    out: list[str] = []
    run: list[str] = []
    for word in [*words, MARK]:
        if len(word) == 1 and word != MARK:
            run.append(word)
            continue
        if run:
            out += _blocks("".join(run)) if len(run) >= LENGTH else [MARK + c for c in run]
            run = []
        out += _blocks(word) if word != MARK else [""]
    return out


class Alphabet:
    """Numbers for the characters of the landmarks; 0 for all others."""

    def __init__(self, landmarks: list[str]):
        self.size = 1 + len(set("".join(landmarks)))
        self.table = np.zeros(0x110000, np.uint8 if self.size < 256 else np.uint16)
        for i, c in enumerate(sorted(set("".join(landmarks)))):
            self.table[ord(c)] = i + 1

    def codes(self, joined: str) -> np.ndarray:
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.table[raw].astype(np.int64)


def _subsequences(codes: np.ndarray, word: np.ndarray, size: int) -> Iterator[tuple]:
    """(word, code, weight) of all subsequences of known characters within one word."""
    n = len(codes)
    for gaps in _GAPS:
        reach = sum(gaps)
        if reach >= n:
            continue
        at, code = 0, codes[: n - reach]
        ok = code > 0
        for gap in gaps:
            at += gap
            step = codes[at : n - reach + at]
            ok = ok & (step > 0)
            code = code * size + step
        ok &= word[: n - reach] == word[reach:]
        hit = np.flatnonzero(ok)
        yield word[hit], code[hit], DECAY ** (reach - LENGTH + 1)


@dataclass
class Kernel:
    """Weights of the landmarks' subsequences, for kernels of any words with them."""

    landmarks: list[str]
    telling: int  # the first of the landmarks, which tell toxic texts
    alphabet: Alphabet = field(init=False)
    known: np.ndarray = field(init=False)
    closed: np.ndarray = field(init=False)  # strings of three that stand in a landmark
    weights: np.ndarray = field(init=False)
    most: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.alphabet = Alphabet(self.landmarks)
        size = self.alphabet.size
        found: dict[tuple[int, int], float] = {}
        for i, landmark in enumerate(self.landmarks):
            codes = self.alphabet.codes(landmark)
            for _, code, weight in _subsequences(codes, np.zeros(len(codes), int), size):
                for c in code.tolist():
                    found[c, i] = found.get((c, i), 0.0) + weight
        distinct = sorted({c for c, _ in found})
        row = {c: r for r, c in enumerate(distinct)}
        weights = np.zeros((len(distinct), len(self.landmarks)))
        for (c, i), weight in found.items():
            weights[row[c], i] = weight
        self.weights = (weights / np.maximum((weights**2).sum(axis=0), 1e-9)).astype(np.float32)
        self.most = self.weights.max(axis=1, initial=0)
        self.closed = np.zeros(size**LENGTH, bool)
        for landmark in self.landmarks:
            codes = self.alphabet.codes(landmark)
            for at in range(len(codes) - LENGTH + 1):
                first, second, third = codes[at : at + LENGTH]
                self.closed[(first * size + second) * size + third] = True
        self.known = np.full(size**LENGTH, -1, np.int32)
        self.known[distinct] = np.arange(len(distinct))

    def similar(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words that come near any landmark, and their kernels with each.

        So many words at a time that their subsequences stay within a bound.
        """
        parts = [self._similar(words[i : i + BLOCK]) for i in range(0, len(words), BLOCK)]
        if not parts:
            return self._similar([])
        places = [some + n * BLOCK for n, (some, _) in enumerate(parts)]
        return np.concatenate(places), np.concatenate([kernels for _, kernels in parts])

    def _similar(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if not lengths.sum():
            return np.empty(0, np.int64), np.empty((0, len(self.landmarks)), np.float32)
        codes = self.alphabet.codes("".join(words))
        word = np.repeat(np.arange(len(words)), lengths)
        where, which, weight = [], [], []
        for w, code, value in _subsequences(codes, word, self.alphabet.size):
            row = self.known[code]
            hit = row >= 0
            where.append(w[hit])
            which.append(row[hit])
            weight.append(np.full(int(hit.sum()), value, np.float32))
        if not where:
            return np.empty(0, np.int64), np.empty((0, len(self.landmarks)), np.float32)
        where, which = np.concatenate(where), np.concatenate(which)
        order = np.argsort(where, kind="stable")
        where, which = where[order], which[order]
        weight = np.concatenate(weight)[order]
        starts = np.flatnonzero(np.diff(where, prepend=-1))
        if len(starts):
            # No kernel of a word exceeds the sum of its subsequences' largest weights.
            most = np.add.reduceat(self.most[which] * weight, starts)
            near = np.repeat(most >= FLOOR, np.diff(np.append(starts, len(where))))
            where, which, weight = where[near], which[near], weight[near]
            starts = np.flatnonzero(np.diff(where, prepend=-1))
        if not len(starts):
            return np.empty(0, np.int64), np.empty((0, len(self.landmarks)), np.float32)
        out = np.empty((len(starts), len(self.landmarks)), np.float32)
        step = 4096  # words at a time: their subsequences' weights are held together
        ends = np.append(starts, len(where))
        for i in range(0, len(starts), step):
            j = min(i + step, len(starts))
            a, b = ends[i], ends[j]
            part = self.weights[which[a:b]] * weight[a:b, None]
            out[i:j] = np.add.reduceat(part, starts[i:j] - a, axis=0)
        out = np.minimum(out, 1)
        out[out < FLOOR] = 0
        return where[starts], out**POWER

    def joined(self, distinct: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which neighbouring words may be one that a blank cuts: strings over the blank are some
        landmark's own.
        """
        size = self.alphabet.size
        bare = [w.removeprefix(MARK) for w in distinct]
        ends = self.alphabet.codes("".join([("  " + w)[-2:] for w in distinct])).reshape(-1, 2)
        starts = self.alphabet.codes("".join([(w + "  ")[:2] for w in bare])).reshape(-1, 2)
        lengths = np.fromiter(map(len, bare), np.int64, len(bare))
        a, b = ends[left], starts[right]
        before = self.closed[(a[:, 0] * size + a[:, 1]) * size + b[:, 0]]
        behind = self.closed[(a[:, 1] * size + b[:, 0]) * size + b[:, 1]]
        some = (lengths[left] > 0) & (lengths[right] > 0)
        return some & (before | (lengths[left] == 1)) & (behind | (lengths[right] == 1))

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its most similar word's kernel with each landmark, and the sum of all
        its words' kernels, sharpened, with each telling one.
        """
        lists = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        best = np.zeros((len(texts), len(self.landmarks)), np.float32)
        whole = np.zeros((len(texts), self.telling))
        if not counts.sum():
            return best, whole
        flat = np.empty(int(counts.sum()), object)
        flat[:] = list(itertools.chain.from_iterable(lists))
        code, distinct = pd.factorize(flat)
        distinct = list(distinct)
        owner = np.repeat(np.arange(len(texts)), counts)
        cut = np.flatnonzero(owner[1:] == owner[:-1])
        cut = cut[self.joined(distinct, code[cut], code[cut + 1])]
        extra = [
            distinct[i][-WINDOW:] + distinct[j].removeprefix(MARK)[:WINDOW]
            for i, j in zip(code[cut].tolist(), code[cut + 1].tolist(), strict=True)
        ]
        if extra:
            more, pairs = pd.factorize(np.array(extra, object))
            owner = np.concatenate([owner, owner[cut]])
            code = np.concatenate([code, more + len(distinct)])
            distinct += list(pairs)
        some, kernels = self.similar(distinct)
        # Only words near some landmark can raise a text above zero.
        place = np.full(len(distinct), -1, np.int64)
        place[some] = np.arange(len(some))
        at = place[code]
        pair = np.sort(owner[at >= 0] * len(distinct) + at[at >= 0])
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        times = np.diff(np.append(first, len(pair))).astype(np.float32)
        owner, at = pair[first] // len(distinct), pair[first] % len(distinct)
        sharp = kernels[:, : self.telling] ** SHARP
        step = 10_000
        for i in range(0, len(owner), step):
            own, k = owner[i : i + step], kernels[at[i : i + step]]
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            ids = own[starts]
            best[ids] = np.maximum(best[ids], np.maximum.reduceat(k, starts, axis=0))
            # In double precision, so that sums do not depend on what a text is scored with.
            full = sharp[at[i : i + step]] * times[i : i + step, None].astype(np.float64)
            whole[ids] += np.add.reduceat(full, starts, axis=0)
        return best, np.log1p(whole)


def _grams(text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed strings of n letters or marks within words, and where each one begins."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(raw) < n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letter = (raw > 64) & ~((raw > 90) & (raw < 97)) & ~((raw > 122) & (raw < 192))
    letter |= raw == ord(MARK)
    inside = np.convolve(letter, np.ones(n, int), "valid") == n
    code = np.full(len(raw) - n + 1, n, np.uint64)
    for j in range(n):
        code = mix(code ^ raw[j : len(raw) - n + 1 + j].astype(np.uint64))
    at = np.flatnonzero(inside)
    return (code[at] % np.uint64(_BINS)).astype(np.int64), at


def choose_landmarks(texts: list[str], y: np.ndarray) -> tuple[list[str], int]:
    """Strings that set the toxic texts apart, each text covered ``COVER`` times if possible.

    Greedy: the next string is the one in most toxic texts that still lack cover, less a
    penalty for the clean texts it is in. Then strings common in clean texts, for contrast. Returned with how many are of the first sort.
    """
    counts = np.zeros((2, _BINS), np.float32)
    seen: list[np.ndarray] = []  # of the toxic texts only
    for text, label in zip(texts, y, strict=True):
        joined = " ".join(words_of(text))
        own = np.unique(np.concatenate([_grams(joined, n)[0] for n in GRAMS]).astype(np.int32))
        counts[label, own] += 1
        if label == 1:
            seen.append(own)
    toxic, clean = max(int((y == 1).sum()), 1), max(int((y == 0).sum()), 1)
    ratio = ((counts[1] + 0.5) / (toxic + 1)) / ((counts[0] + 0.5) / (clean + 1))
    telling = (counts[1] >= max(2, 0.002 * toxic)) & (ratio >= 8)
    marks = [own[telling[own]] for own in seen]
    del seen
    lack = np.full(len(marks), COVER)
    chosen: list[int] = []
    taken = np.zeros(_BINS, bool)
    while len(chosen) < LANDMARKS:
        weight = np.zeros(_BINS, np.float32)
        for own, left in zip(marks, lack, strict=True):
            if left > 0:
                weight[own] += 1
        weight -= PURITY * counts[0] * (toxic / clean)
        weight[taken] = 0
        # Among equals the more telling one.
        best = int(np.argmax(weight + np.minimum(ratio, 1e6) / 1e7))
        if weight[best] < max(1, FEWEST * toxic):
            break
        chosen.append(best)
        taken[best] = True
        for i, own in enumerate(marks):
            lack[i] -= bool(lack[i] > 0 and (own == best).any())
    telling_ones = len(chosen)
    usual = np.argsort(-counts[0] + counts[1], kind="stable")
    usual = usual[counts[0][usual] > 0]
    chosen += [int(b) for b in usual[: CONTRAST * 20 : 20]]
    wanted, names = set(chosen), {}
    for text in texts:
        joined = " ".join(words_of(text))
        for n in GRAMS:
            code, at = _grams(joined, n)
            hit = np.isin(code, chosen)
            for c, i in zip(code[hit].tolist(), at[hit].tolist(), strict=True):
                names.setdefault(c, joined[i : i + n])
        if len(names) == len(wanted):
            break
    return [names[c] for c in chosen], telling_ones


def train_machine(x: np.ndarray, y: np.ndarray, cost: float = 4.0) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, by Newton's method.

    Both classes weigh the same in total.
    """
    z = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y == 1, 1.0, -1.0)
    weight = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    w = np.zeros(z.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    ridge /= cost * len(y)
    before = None
    for _ in range(50):
        active = sign * (z @ w) < 1
        if before is not None and (active == before).all():
            break
        before = active
        a = z[active] * weight[active, None]
        w = np.linalg.solve(ridge * len(y) + a.T @ z[active], a.T @ sign[active])
    return w[:-1], float(w[-1])


def fit_logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic function of the margin; targets are smoothed."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ w).clip(-30, 30)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, z.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w -= step.clip(-2, 2)
    return float(max(w[0], 0.1)), float(w[1])


@dataclass
class Model:
    kernel: Kernel
    root: np.ndarray  # inverse root of the landmarks' kernel matrix
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    @property
    def landmarks(self) -> list[str]:
        return self.kernel.landmarks

    def score(self, texts: list[str]) -> np.ndarray:
        margin = _row(self.kernel, self.root, texts) @ self.weights + self.offset
        # Rounded, so that a text's score does not depend on the batch it came in.
        return (1 / (1 + np.exp(-(self.slope * margin + self.shift).clip(-30, 30)))).round(9)


def _hidden(text: str, way: int, random: np.random.Generator) -> str:
    """The text with its longer words hidden: a sign or letter put in, dots between letters, a
    blank within, or blanks between letters.
    """
    words = text.split()
    for i, word in enumerate(words):
        at = int(random.integers(1, max(len(word) - 1, 2)))
        if way == 0 and len(word) > 3:
            words[i] = word[:at] + ".-_*xaeu"[int(random.integers(8))] + word[at:]
        elif way == 1 and len(word) > 3:
            words[i] = word[:at] + " " + word[at:]
        elif way == 2:
            words[i] = " ".join(word)
    return " ".join(words)


def _row(kernel: Kernel, root: np.ndarray, texts: list[str]) -> np.ndarray:
    """Coordinates, strong words by landmark, and what holds for all telling landmarks."""
    best, whole = kernel.rows(texts)
    total = np.log1p(np.expm1(whole).sum(axis=1, keepdims=True))
    most = np.sort(best[:, : kernel.telling], axis=1)[:, ::-1][:, :2]
    most = np.pad(most, ((0, 0), (0, 2 - most.shape[1])))
    return np.hstack([best @ root, whole, SHARED * total, SHARED * most])


def fit(texts: list[str], y: np.ndarray) -> Model | None:
    """A model from labelled texts; None if either label is missing."""
    if not len(y) or y.min() == y.max():
        return None
    kernel = Kernel(*choose_landmarks(texts, y))
    if not kernel.landmarks:
        return None
    gram = np.zeros((len(kernel.landmarks),) * 2)
    some, own = kernel.similar(kernel.landmarks)
    gram[some] = own
    gram = (gram + gram.T) / 2
    values, vectors = np.linalg.eigh(gram)
    root = (vectors / np.sqrt(values.clip(0.05))) @ vectors.T
    random = np.random.default_rng(11)
    again = random.permutation(len(texts))[:HIDDEN]
    texts = [*texts, *(_hidden(texts[i], j % 3, random) for j, i in enumerate(again))]
    y = np.concatenate([y, y[again]])
    x = np.vstack([_row(kernel, root, texts[i : i + 200]) for i in range(0, len(texts), 200)])
    weights, offset = train_machine(x, y)
    slope, shift = fit_logistic(x @ weights + offset, y)
    return Model(kernel, root, weights, offset, slope, shift)


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    """A model from a bounded sample: rows and characters of what reaches the driver are capped."""
    rows = (
        training.sample(docs, labels, label, SAMPLE_ROWS)
        .filter(F.length("text") <= SAMPLE_CHARS)
        .select("doc_id", "text", "label")
        .toPandas()
        .sort_values(["doc_id", "text"], kind="stable")
    )
    return fit(rows["text"].tolist(), rows["label"].to_numpy().astype(np.int64))


UNKNOWN = 0.25
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs``: its score, and whether it reaches a half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            texts = batch["text"].to_pylist()
            score = model.score(texts) if model else np.full(len(texts), UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(score, pa.float64()),
                    pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = keyed_text(docs)
    return rows.select(
        "doc_id", training.held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(run, SCHEMA)


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below a half, with all their columns."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        values = texts.tolist()
        if not model:
            return pd.Series(np.full(len(values), UNKNOWN))
        parts = [model.score(values[i : i + SLICE]) for i in range(0, len(values), SLICE)]
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.filter(score(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))) < 0.5)
