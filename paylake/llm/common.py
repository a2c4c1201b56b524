"""What the operators share: reading tables, scratch tables, hashing, words as code arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import scratch_dir

# Rows of an Arrow batch that one step of Python work holds at a time.
SLICE_ROWS = 1000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, under its own names; a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, what: str, sort_by: str | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm/{what}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes in all; a row above it is alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal outputs in any process."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def ascii_words(text: str) -> list[bytes]:
    """Maximal runs of anything but space and the controls 9 to 13; A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_UPPER_TO_LOWER).split()


def word_hashes(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one text after the other, and their counts."""
    lists = [ascii_words(t) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.empty(int(counts.sum()), object)
    at = 0
    for words in lists:
        flat[at : at + len(words)] = words
        at += len(words)
    codes, distinct = pd.factorize(flat)
    return hash_bytes(distinct)[codes] if len(flat) else np.empty(0, np.uint64), counts


def hash_bytes(words: Iterable[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64)


def shingle_sets(texts: Iterable[str], width: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``width`` words as sorted 64-bit hashes.

    Fewer words than ``width`` make one shingle of the whole sequence; no words, none.
    """
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        own = hashes[at : at + n]
        at += n
        if n == 0:
            out.append(own)
            continue
        k = min(width, n)
        shingles = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            shingles = mix(shingles ^ own[j : n - k + 1 + j])
        out.append(np.unique(shingles))
    return out


def densify(values: np.ndarray, filled: np.ndarray) -> None:
    """Fills the empty bins of each row in place from bins of the same row that are not empty.

    Where an empty bin looks is a hash of (bin, attempt), the same for all rows, so rows with
    equal contents are filled alike. Rows without any filled bin stay as they are.
    """
    bins = values.shape[1]
    flat, full = values.reshape(-1), filled.reshape(-1)
    empty = np.flatnonzero(~full & np.repeat(filled.any(axis=1), bins))
    attempt = 0
    while len(empty):
        attempt += 1
        own = empty % bins
        to = mix(own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        source = empty - own + (to % np.uint64(bins)).astype(np.int64)
        met = full[source]
        flat[empty[met]] = flat[source[met]]
        empty = empty[~met]
