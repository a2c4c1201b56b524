"""Document fingerprints: one-permutation MinHash with optimal densification, packed bits.

A text's distinct shingles are hashed once. The top bits of a hash choose one of ``BINS``
bins, and each bin keeps its smallest hash. An empty bin copies a bin that is chosen by a
hash of (bin, attempt), the same for all texts, until it meets one that was not empty. Of
every bin the low ``BITS`` bits of its value, mixed with the bin, are stored. Two fingerprints agree by chance in one bin of
2^BITS, which ``likeness`` takes out.

Equal texts have equal fingerprints. A text without words has the empty fingerprint: like
another empty one (1), unlike any other (0). A null text is empty. Null ids come first in
the order of ids; rows with equal ids follow each other by text, and each gets its row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import densify, keyed_text, mix, shingle_sets

BINS, BITS, WIDTH = 256, 4, 5
_TOP = np.uint64(64 - BINS.bit_length() + 1)
_LOW = np.uint64((1 << BITS) - 1)


def signatures(texts: Iterable[str]) -> np.ndarray:
    """A row of BINS low-order values for each text; all 255 for a text without words."""
    sets = shingle_sets(texts, WIDTH)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values = np.zeros((len(sets), BINS), np.uint64)
    filled = np.zeros(values.shape, bool)
    if sizes.sum():
        hashes = np.concatenate(sets)
        cell = np.repeat(np.arange(len(sets)), sizes) * BINS + (hashes >> _TOP).astype(np.int64)
        first = np.flatnonzero(np.diff(cell, prepend=-1))  # sorted sets: the smallest comes first
        values.reshape(-1)[cell[first]] = hashes[first]
        filled.reshape(-1)[cell[first]] = True
        densify(values, filled)
    # A copied value gives other bits in each bin, or few shingles would make few distinct bits.
    own = np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = (mix(values ^ own) & _LOW).astype(np.uint8)
    out[sizes == 0] = 255
    return out


def packed(rows: np.ndarray) -> list[str]:
    """Signatures as hex, two values to a byte."""
    pairs = (rows[:, 0::2] << BITS) | (rows[:, 1::2] & _LOW.astype(np.uint8))
    return ["" if row[0] == 255 else p.tobytes().hex() for row, p in zip(rows, pairs, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated resemblance of signatures, row by row, without chance agreement."""
    chance = 1 / (1 << BITS)
    estimate = ((a == b).mean(axis=1) - chance) / (1 - chance)
    no_words = (a[:, 0] == 255) != (b[:, 0] == 255)
    return np.where(no_words, 0.0, estimate.clip(0.0, 1.0))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("bucket", "own", "doc_id", "text")))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
_STEP = 400


def _output(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Results for all rows but the last, each of which has its successor behind it."""
    at = [i for i, row in enumerate(rows[:-1]) if row[1]]
    if not at:
        return
    texts = [row[3] for row in rows]
    edited = []
    for i in at:
        quarter = len(texts[i]) // 4
        edited.append(texts[i][: len(texts[i]) - quarter] + texts[i + 1][:quarter])
    own, changed = signatures(texts), signatures(edited)
    mine = own[at]
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([rows[i][2] for i in at], pa.int64()),
            "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
            "edited_sha256": [
                hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited
            ],
            "fingerprint": packed(mine),
            "edited_fingerprint": packed(changed),
            "near_edited": likeness(mine, changed),
            "near_next": likeness(mine, own[[i + 1 for i in at]]),
        }
    )


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, compared with its edited self and its successor.

    The successor is the next row by id (then text); the last row's is the first. Ids are
    cut into buckets at actual ids, found in a pass over the id column alone, and the first
    rows of each bucket also go to the end of the one before. So one shuffle of the texts
    brings every row and its successor together, and no bucket depends on another.
    """
    spark = docs.sparkSession
    rows = keyed_text(docs, id_col, text_col)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * partitions
    ids = rows.agg(
        F.min("doc_id").alias("least"),
        F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("cuts"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    cuts = sorted({c for c in ids["cuts"] or [] if c > ids["least"]})
    edges = np.array(cuts, np.int64)
    first = F.lit(None) if ids["nulls"] else F.lit(ids["least"])

    @F.pandas_udf("int")
    def bucket(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        values = doc_id.fillna(0).to_numpy().astype(np.int64)
        return pd.Series(np.where(known, np.searchsorted(edges, values, side="right"), 0))

    opens = F.col("doc_id").eqNullSafe(first.cast("long"))
    if cuts:
        opens = opens | F.coalesce(F.col("doc_id").isin(cuts), F.lit(False))
    before = F.when(F.col("at") == 0, len(cuts)).otherwise(F.col("at") - 1)
    both = F.array(
        F.struct(F.col("at").alias("bucket"), F.lit(True).alias("own")),
        F.struct(before.alias("bucket"), F.lit(False).alias("own")),
    )
    placed = (
        rows.withColumn("at", bucket("doc_id"))
        .withColumn("to", F.explode(F.when(opens, both).otherwise(F.slice(both, 1, 1))))
        .select("to.bucket", "to.own", "doc_id", "text")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", F.desc("own"), "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in _rows_of(batches):
            if held and held[-1][0] != row[0]:
                yield from _output(held)
                held = []
            held.append(row)
            if len(held) > _STEP:
                yield from _output(held)
                held = held[-1:]
        yield from _output(held)

    return placed.mapInArrow(run, SCHEMA)
