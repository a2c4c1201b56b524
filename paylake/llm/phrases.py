"""Phrases whose words stand together more often than their parts let expect, by language.

Counting is by marginalisation of the top order. Each word begins one window: itself and the
``LONGEST`` - 1 words that lead on from it, padded with null where its piece of text ends. Only
these windows are counted. Every phrase occurs once in front of each window that begins with
it, so its count is the sum over the longer windows: Spark's ROLLUP over (language, first,
second) sums the counts of shorter and shorter prefixes, down to all words of a language.

1. Windows are counted in the Arrow function for a stretch of texts at a time, so that a
   stretch passes on each distinct window once, however common it is. A row has a first word
   and, as lines of text, the windows that go on with one share of the second words.
2. Rows are dealt by language, first word and share. There the windows and their two-word
   prefixes are summed in one aggregation. Windows below the least count, and two words below
   it, are folded into their prefix; nothing is lost from the prefix's sum.
3. Pairs of words with so many different third words that they would fill a task are shared
   out by the third word too. Which pairs these are is taken from a sample of the rows; it
   decides only where rows go, not what is counted.
4. ROLLUP runs over the folded rows. Each candidate meets the counts of its parts by joins on
   their text; scores are whole numbers, exact in 38 decimal digits.
5. A candidate inside a longer one that is at least ``SHARE`` per cent as frequent is dropped.
   The best of each language are the best of the best of its shares.

A null text is empty; a null language is ``und``; A-Z are lower-cased. Pieces end at any of
``.,;:!?`` and line breaks, words at spaces and tabs. Repeated rows count as often as they
occur; ids are not looked at, nor other columns. A text of any length is one row of work. An
empty table, or one without phrases of the least count, gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import groups, mix, stored

LEAST, SHARE, TOP = 10, 50, 2000
STRETCH_BYTES = 8 << 20
# A row in so many is looked at to find pairs with many third words: those with more than
# 1 / (PAIRS_OF * partitions) of all windows' rows, so there are fewer of them than that.
SAMPLED, PAIRS_OF = 100, 4
# The best of each language are chosen in so many shares first.
RANK_SHARES = 32
_OUT_ROWS = 20_000

_SPACE, _END = 0x20, 0x0A


def _byte_map() -> bytes:
    """A-Z in lower case, a tab as a space, and all that ends a piece as a line feed."""
    table = bytearray(range(256))
    table[0x41:0x5B] = range(0x61, 0x7B)
    table[0x09] = _SPACE
    for byte in b".,;:!?\x0b\x0c\x0d":
        table[byte] = _END
    return bytes(table)


_BYTES = _byte_map()


@dataclass
class Dealing:
    """In how many shares a first word's windows go, and pairs that are shared out further."""

    shares: int
    lang: list[str] = field(default_factory=list)
    first: list[str] = field(default_factory=list)
    second: list[str] = field(default_factory=list)


def _coded_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words, and for each word its number in these, its piece and its text."""
    joined = b"\n".join(t.translate(_BYTES) for t in texts)
    raw = np.frombuffer(joined, np.uint8)
    inside = (raw != _SPACE) & (raw != _END)
    edges = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]
    ).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(raw == _END), starts)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(text_ends, starts, side="right")
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return words.dictionary.cast(pa.string()), codes, piece, text


def _lead(codes: np.ndarray, piece: np.ndarray, by: int) -> np.ndarray:
    """The word so many places on, 0 behind the end of the piece; words count from 1."""
    out = np.zeros(len(codes), np.int64)
    same = piece[by:] == piece[:-by]
    out[: len(same)][same] = codes[by:][same] + 1
    return out


def _shares(dealing: Dealing, langs, words, top, pair, second, third) -> np.ndarray:
    """The share of each window: by its second word, or by second and third of a dealt pair."""
    hashed = [0, *(zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist())]
    hashed = mix(np.array(hashed, np.uint64) + np.uint64(1))
    share = (hashed[second] % np.uint64(dealing.shares)).astype(np.int64)
    if dealing.lang:
        columns = ((dealing.lang, langs), (dealing.first, words), (dealing.second, words))
        own = [
            pc.index_in(pa.array(values, pa.string()), value_set=known).fill_null(-1).to_numpy()
            for values, known in columns
        ]
        own = [x[np.min(own, axis=0) >= 0].astype(np.int64) for x in own]
        rows = np.isin(pair, (own[0] * top + own[1]) * top + own[2] + 1)
        both = mix(hashed[second[rows]] + hashed[third[rows]])
        share[rows] = dealing.shares + (both % np.uint64(dealing.shares)).astype(np.int64)
    return share


def _windows(langs: pa.Array, texts: list[bytes], dealing: Dealing) -> Iterator[pa.RecordBatch]:
    """Each distinct window of the texts with its count, in rows by first word and share."""
    words, codes, piece, text = _coded_words(texts)
    if not len(codes):
        return
    names = langs.dictionary_encode()
    lang = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
    top = len(words) + 1
    pair_of, pairs = pd.factorize((lang * top + codes) * top + _lead(codes, piece, 1))
    counted, n = np.unique(pair_of * top + _lead(codes, piece, 2), return_counts=True)
    pair, third = pairs[counted // top], counted % top
    head, second = pair // top, pair % top
    share = _shares(dealing, names.dictionary, words, top, pair, second, third)
    order = np.lexsort((third, second, share, head))
    head, second, third, share, n = (x[order] for x in (head, second, third, share, n))
    starts = np.flatnonzero((np.diff(head, prepend=-1) != 0) | (np.diff(share, prepend=-1) != 0))
    ends = np.append(starts[1:], len(head))
    blank = pa.concat_arrays([pa.array([""]), words])
    for i in range(0, len(starts), _OUT_ROWS):
        own, end = starts[i : i + _OUT_ROWS], ends[min(i + _OUT_ROWS, len(ends)) - 1]
        s = slice(own[0], end)
        lines = pc.binary_join_element_wise(
            blank.take(pa.array(second[s])),
            blank.take(pa.array(third[s])),
            pa.array(n[s]).cast(pa.string()),
            " ",
        )
        offsets = pa.array(np.append(own, end) - own[0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                names.dictionary.take(pa.array(head[own] // top)),
                words.take(pa.array(head[own] % top)),
                pa.array(share[own], pa.int32()),
                pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n"),
            ],
            names=["lang", "first", "share", "windows"],
        )


def _counted_windows(texts: DataFrame, dealing: Dealing) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["text"].cast(pa.binary())
            for start, end in groups(pc.binary_length(raw).to_pylist(), STRETCH_BYTES):
                own = raw.slice(start, end - start).to_pylist()
                yield from _windows(batch["lang"].slice(start, end - start), own, dealing)

    return texts.mapInArrow(run, "lang string, first string, share int, windows string")


def _one_by_one(rows: DataFrame) -> DataFrame:
    """A row for each window; second and third are empty behind the piece's end."""
    parts = F.split("line", " ")
    return rows.select(
        "lang", "first", "share", F.explode(F.split("windows", "\n")).alias("line")
    ).select(
        "lang",
        "first",
        "share",
        F.get(parts, F.lit(0)).alias("second"),
        F.get(parts, F.lit(1)).alias("third"),
        F.get(parts, F.lit(2)).cast("long").alias("n"),
    )


def _dealing(texts: DataFrame, partitions: int) -> Dealing:
    """How windows are dealt; the pairs come to the driver, at most PAIRS_OF * partitions."""
    plain = Dealing(shares=max(8, partitions // 8))
    sample = _one_by_one(_counted_windows(texts.sample(1 / SAMPLED, seed=1), plain))
    pairs = stored(
        sample.groupBy("lang", "first", "second").agg(F.count("third").alias("rows")), "pairs"
    )
    total = pairs.agg(F.sum("rows")).first()[0] or 0
    many = pairs.filter((F.col("second") != "") & (F.col("rows") * PAIRS_OF * partitions > total))
    found = many.filter("rows > 1").select("lang", "first", "second").collect()
    return Dealing(plain.shares, *(list(x) for x in zip(*found, strict=True))) if found else plain


def folded_counts(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, first, second, third, n): windows of the least count, and what the others add.

    A row with a third word is a phrase of three words with its count. The others have null
    there; they add up to the count of their first two words if that is ``least`` or more, or
    else, with null for the second too, to their part of the first word's count.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealing = _dealing(texts, partitions)
    dealt = _counted_windows(texts, dealing).repartition(partitions, "lang", "first", "share")
    # Each row counts for its window and for the window's first two words.
    both = F.array("third", F.lit(None).cast("string"))
    summed = (
        _one_by_one(dealt)
        .select("lang", "first", "share", "second", "n", F.explode(both).alias("third"))
        .filter("third IS NULL OR third <> ''")
        .groupBy("lang", "first", "share", "second", "third")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= least) | F.col("third").isNull())
    )
    # A pair that is shared out further may be frequent though none of its shares is.
    whole = (F.col("second") != "") & ((F.col("n") >= least) | (F.col("share") >= dealing.shares))
    return (
        summed.select("lang", "first", F.when(whole, F.col("second")).alias("second"), "third", "n")
        .groupBy("lang", "first", "second", "third")
        .agg(F.sum("n").alias("n"))
    )


def phrase_counts(docs: DataFrame, least: int, lang_col: str, text_col: str) -> DataFrame:
    """(lang, phrase, size, n): phrases of 1 to 3 words that occur ``least`` times or more.

    The row of size 0 has the number of all words of its language.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    folded = stored(folded_counts(texts, least), "windows")
    longest = folded.filter("third IS NOT NULL").select(
        "lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), F.lit(3).alias("size"), "n"
    )
    rolled = (
        folded.filter("third IS NULL")
        .rollup("lang", "first", "second")
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    )
    size = F.when(F.col("level") == 0, 2).when(F.col("level") == 1, 1).when(F.col("level") == 3, 0)
    shorter = (
        rolled.withColumn("size", size)
        .filter("size IN (0, 1) OR (size = 2 AND second IS NOT NULL)")
        .select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "size", "n")
        .filter((F.col("n") >= least) | (F.col("size") == 0))
    )
    return shorter.unionByName(longest)


def _cuts(phrase: Column) -> Column:
    """Each way to cut a phrase after its first words: (k, left, right)."""

    def cut(words: Column, k: Column) -> Column:
        left = F.array_join(F.slice(words, F.lit(1), k), " ")
        right = F.array_join(F.slice(words, k + 1, F.size(words)), " ")
        return F.struct(k.alias("k"), left.alias("left"), right.alias("right"))

    words = F.split(phrase, " ")
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: cut(words, k))


def _inner(phrase: Column) -> Column:
    """The phrases one word shorter that lie in one of three words."""
    words = F.split(phrase, " ")
    return F.array(*(F.array_join(F.slice(words, i, 2), " ") for i in (1, 2)))


def mine_phrases(
    docs: DataFrame,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The best ``top`` phrases of 2 or 3 words of each language.

    (lang, rank, phrase, a, l, r, n, score): how often the phrase occurs, its first part and
    its rest at the cut that scores lowest, all words of the language, and
    1000000 a a / (l r), floored, which is at most 1000000.
    """
    counts = stored(phrase_counts(docs, least, lang_col, text_col), "phrases")
    phrases = counts.filter("size >= 2").withColumnRenamed("n", "a")
    parts = counts.filter("size IN (1, 2)")
    cuts = phrases.select("lang", "phrase", "size", "a", F.explode(_cuts(F.col("phrase"))).alias("c"))
    cuts = cuts.select("lang", "phrase", "size", "a", "c.k", "c.left", "c.right")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    exact = {c: F.col(c).cast("decimal(38,0)") for c in "alr"}
    wide = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = wide.select(
        "lang", "phrase", "size", "a", "k", "l", "r",
        (exact["a"] * exact["a"] * F.lit(1_000_000)).alias("above"),
        (exact["l"] * exact["r"]).alias("below"),
    )
    best = (
        wide.withColumn("score", F.expr("above div below"))
        .groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    within = (
        phrases.filter("size = 3")
        .select("lang", F.explode(_inner(F.col("phrase"))).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    free = best.join(within, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("a") * share
    )
    # The best of a language are among the best of its shares: no task gets all of them.
    best_first = (F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    shares = Window.partitionBy("lang", "of").orderBy(*best_first)
    among = (
        free.withColumn("of", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARES)))
        .withColumn("rank", F.row_number().over(shares))
        .filter(F.col("rank") <= top)
    )
    order = Window.partitionBy("lang").orderBy(*best_first)
    ranked = among.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    words = counts.filter("size = 0").select("lang", "n")
    return ranked.join(words, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        "cut.l",
        "cut.r",
        "n",
        "cut.score",
    )
