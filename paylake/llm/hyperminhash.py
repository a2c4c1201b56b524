"""Near-duplicates by HyperMinHash: compressed registers, banding, estimate, verification.

A text's distinct shingles are hashed to 64 bits. The top bits choose one of ``REGISTERS``
buckets; each keeps its smallest hash as a register of 16 bits: the number of leading zeros
of the rest (6 bits) and the ``MANTISSA`` bits that follow the first one.

1. Texts with the same set of shingles form a class; only classes go on, by their smallest
   id. A set of up to ``TINY`` shingles reaches 0.8 with an equal set only.
2. Bands of ``ROWS`` registers are keys; for these, empty registers are filled from others
   of the set (optimal densification), else one common shingle would be a small set's whole
   key. A pair at similarity s meets in some band with probability 1 - (1 - s^4)^32:
   0.99999995 at 0.8.
3. In each key with more than one class, every class meets the key's centre: the member
   whose keys hold the most classes, which in a group of copies is the original.
4. A pair's similarity is estimated from equal registers, less the collisions to expect for
   sets of those sizes. Pairs more than ``MARGIN`` below the threshold go no further, but for
   those with a set of under ``FEW`` shingles.
5. The rest are confirmed on the full sets; confirmed links form components.
6. Steps 3 to 5 come again for keys that still hold several components, with a centre from
   another component. After ``STARS`` such rounds, what is left of such keys is compared
   where it lies, block against block, pairs of different components only. So no link that
   a key shows is lost, and a group of copies gives a few rows for each of its members, not
   one for each pair.

A null text is empty. A text without words is linked with nothing. Each row gets the
component of its own text, so rows that repeat an id and text get equal results; classes
whose smallest ids are equal count as one. A row with a null id is linked with nothing: its
component is null, and it is kept. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import densify, keyed_text, mix, shingle_sets, slices, stored
from paylake.llm.components import components

REGISTERS, MANTISSA = 256, 10
BANDS, ROWS = 32, 4
TINY = 3
MARGIN = 0.13
# The estimate says nothing certain of sets that fill few registers: pairs with a smaller one
# than this are confirmed without it.
FEW = 16
STARS = 3
# A block's members and the bytes of their sets: what one task holds at a time, twice.
BLOCK, BLOCK_BYTES = 1024, 64 << 20
_BUCKET_SHIFT = np.uint64(64 - 8)
_EMPTY = 0


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of REGISTERS 16-bit registers for each sorted set; 0 marks an empty bucket."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    if not sizes.sum():
        return out
    hashes = np.concatenate(sets)
    cell = np.repeat(np.arange(len(sets)), sizes) * REGISTERS
    cell += (hashes >> _BUCKET_SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))  # sorted sets: the smallest comes first
    rest = hashes[first] << np.uint64(8) | np.uint64(0xFF)
    # The exponent of a float is where its first one stands; 53 bits of the rest are exact.
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, 44).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    value = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa
    out.reshape(-1)[cell[first]] = value.astype(np.uint16)
    return out


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of buckets whose registers agree though the sets are disjoint.

    The chance that both sets' smallest values in a bucket fall into the same register: the
    sum over registers of the product of both sets' differences of (1 - x / buckets)^size.
    """
    k = np.arange(0, 30)
    low = np.repeat(2.0 ** -(k + 1), 32) * (1 + np.tile(np.arange(32) / 32, len(k)))
    high = low + np.repeat(2.0 ** -(k + 1), 32) / 32
    # 32 parts stand for 2^MANTISSA registers each of equal width: their chance is split.
    split = 32 / (1 << MANTISSA)

    def fall(size: np.ndarray) -> np.ndarray:
        size = np.asarray(size, float)[:, None]
        return np.exp(size * np.log1p(-low / REGISTERS)) - np.exp(
            size * np.log1p(-high / REGISTERS)
        )

    return (fall(n) * fall(m)).sum(axis=1) * split


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of sets from their registers and sizes, row by row."""
    equal = ((a == b) & (a != _EMPTY)).sum(axis=1)
    either = np.maximum(((a != _EMPTY) | (b != _EMPTY)).sum(axis=1), 1)
    raw = equal / either
    chance = collisions(n, m) * REGISTERS / either
    return ((raw - chance) / (1 - chance).clip(0.01)).clip(0, 1)


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """Each row's set: its size, its hash, registers and keys; source is a hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch["text"].to_pylist(), width)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            own = registers(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["source"],
                    pa.array(map(len, sets), pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array([row.tobytes() for row in own], pa.binary()),
                    pa.array(list(band_keys(own)), pa.list_(pa.int64())),
                ],
                names=["doc_id", "source", "n", "set_key", "sketch", "keys"],
            )

    schema = (
        "doc_id long, source long, n long, set_key binary, sketch binary, keys array<bigint>"
    )
    return docs.select("doc_id", "source", "text").mapInArrow(run, schema)


def band_keys(own: np.ndarray) -> np.ndarray:
    """A row of BANDS 64-bit keys for each row of registers."""
    full = own.copy()
    densify(full, own != _EMPTY)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(own), 1))
    for j in range(ROWS):
        keys = mix(keys ^ full[:, j : ROWS * BANDS : ROWS].astype(np.uint64))
    return keys.view(np.int64)


def _bands(classes: DataFrame) -> DataFrame:
    """(key, rep) for each band of a class."""
    return classes.filter(F.col("n") > TINY).select(F.explode("keys").alias("key"), "rep")


def _shared_bands(classes: DataFrame, what: str) -> DataFrame:
    """(key, rep, mass) of keys with two classes or more, and how full the class's keys are."""
    bands = _bands(classes)
    full = bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(bands.join(full, "key"), f"{what}-bands")
    mass = shared.groupBy("rep").agg(F.sum("size").alias("mass"))
    return stored(shared.select("key", "rep").join(mass, "rep"), f"{what}-mass")


def _with_components(shared: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return shared.withColumn("component", F.col("rep"))
    found = found.select(F.col("node").alias("rep"), "component")
    return shared.join(found, "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )


def _open_keys(members: DataFrame) -> DataFrame:
    """Members of keys of three or more that hold more than one component."""
    keys = (
        members.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("size"),
        )
        .filter("low <> high and size > 2")  # the one pair of a key of two is settled by then
        .select("key")
    )
    return members.join(keys, "key", "left_semi")


def _star_pairs(members: DataFrame, turn: int) -> DataFrame:
    """(a, b): members of an open key with the key's centre, if in another component.

    The first turn's centre is the member with the fullest keys. Later turns take it from
    a component other than the one with the smallest or, in turn, the largest number.
    """
    order = F.struct("mass", (-F.col("rep")).alias("back"), "component")
    if turn:
        side = F.min if turn % 2 else F.max
        edge = members.groupBy("key").agg(side("component").alias("edge"))
        pool = members.join(edge, "key").filter("component <> edge")
    else:
        pool = members
    centre = pool.groupBy("key").agg(F.max(order).alias("top"))
    return (
        members.join(centre, "key")
        .filter(F.col("component") != F.col("top.component"))
        .select(F.col("rep").alias("a"), (-F.col("top.back")).alias("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose estimated similarity is not clearly below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4000):
            a, b = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for c in ("sketch_a", "sketch_b")
            )
            n, m = (batch[c].to_numpy() for c in ("n_a", "n_b"))
            near = (estimate(a, b, n, m) >= threshold - MARGIN) | (np.minimum(n, m) < FEW)
            near &= np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(near))

    side = [
        classes.select(
            F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")
        )
        for x in ("a", "b")
    ]
    return pairs.join(side[0], "a").join(side[1], "b").mapInArrow(run, "a long, b long")


def _items(reps: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(rep, items): the full sets of the classes in ``reps``, as sorted 64-bit hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = shingle_sets(batch["text"].to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], pa.array([s.tobytes() for s in found], pa.binary())],
                names=["rep", "items"],
            )

    chosen = classes.select("rep", "source").join(reps.distinct(), "rep", "left_semi")
    # A class's own text is told by its hash from others under a repeated id.
    return (
        docs.withColumnRenamed("doc_id", "rep")
        .join(chosen, ["rep", "source"])
        .select("rep", "source", "text")
        .dropDuplicates(["rep", "source"])
        .select("rep", "text")
        .mapInArrow(sets, "rep long, items binary")
    )


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirmed(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near = [
                _linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch["items_a"].to_pylist(), batch["items_b"].to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    side = [items.select(F.col("rep").alias(x), F.col("items").alias(f"items_{x}")) for x in "ab"]
    found = pairs.join(side[0], "a").join(side[1], "b").mapInArrow(check, "a long, b long")
    return found.distinct()


def _blocked_links(
    members: DataFrame, items: DataFrame, classes: DataFrame, percent: int
) -> DataFrame:
    """(a, b): links between components that meet in a key, block against block.

    A key's members are dealt by hash into blocks of some ``BLOCK`` members or
    ``BLOCK_BYTES`` of sets; a group holds two blocks, so a member goes to as many groups as
    its key has blocks.
    A pair is compared only under the first key it shares, first by registers, then in full.
    Components that a group has joined are not compared again, so a group reports fewer links
    than it has members.
    """
    threshold = percent / 100
    sizes = (
        members.join(classes.select("rep", "n"), "rep")
        .groupBy("key")
        .agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") * 8 / BLOCK_BYTES)).alias("blocks"))
    )
    rows = (
        members.join(sizes, "key")
        .withColumn("blocks", F.col("blocks").cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("key", "low", "high", "block", "rep", "component")
        .join(classes.select("rep", "n", "sketch", "keys"), "rep")
        .join(items, "rep")
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        key, low, high = (int(pdf[c].iloc[0]) for c in ("key", "low", "high"))
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint16).reshape(-1, REGISTERS)
        keys = np.array(pdf["keys"].tolist(), np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["items"]]
        rep, part, n, block = (pdf[c].to_numpy() for c in ("rep", "component", "n", "block"))
        part = part.copy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        out = []
        for i in left:
            j = right[(part[right] != part[i]) & ((low != high) | (rep[right] > rep[i]))]
            j = j[np.minimum(n[j], n[i]) >= threshold * np.maximum(n[j], n[i]) - 1e-9]
            same = keys[j] == keys[i]
            j = j[keys[i][same.argmax(axis=1)] == key] if len(j) else j
            if not len(j):
                continue
            own = np.broadcast_to(sketch[i], (len(j), REGISTERS))
            near = estimate(own, sketch[j], np.full(len(j), n[i]), n[j]) >= threshold - MARGIN
            near |= np.minimum(n[j], n[i]) < FEW
            for k in j[near]:
                if part[k] != part[i] and _linked(sets[i], sets[k], percent):
                    out.append((rep[i], rep[k]))
                    part[part == part[k]] = part[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("key", "low", "high").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    return _near_rows(docs, width, percent, id_col, text_col).drop("source")


def _source() -> Column:
    """A hash of the text, which tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _near_rows(
    docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What ``near_duplicates`` gives, and the hash of each row's text."""
    rows = keyed_text(docs, id_col, text_col).withColumn("source", _source())
    sketches = stored(_sketches(rows, width), "near-sketches")
    classes = stored(_classes(sketches), "near-classes")
    found = _linked_components(rows, classes, width, percent)
    by_key = classes.select("set_key", "rep")
    if found is not None:
        moved = found.select(F.col("node").alias("rep"), "component")
        by_key = by_key.join(moved, "rep", "left")
    else:
        by_key = by_key.withColumn("component", F.lit(None).cast("long"))
    by_key = by_key.select("set_key", F.coalesce("component", "rep").alias("component"))
    own = sketches.select("doc_id", "source", F.col("n").alias("n_shingles"), "set_key")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        own.join(by_key, "set_key", "left")
        .withColumn("component_id", component)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "source",
        )
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest id.

    A row is known by its id and its text: unlike texts under one id are documents of their
    own, in the order of a hash of the text, and rows that agree in both count once. Rows with
    a null id stay.
    """
    row = ["__near_id", "__near_text"]
    known = docs.filter(F.col("doc_id").isNotNull()).withColumns(
        {row[0]: F.col("doc_id").cast("long"), row[1]: _source()}
    )
    pairs = stored(known.select(*row).distinct(), "near-rows")
    if pairs.groupBy(row[0]).count().filter("count > 1").isEmpty():
        near = _near_rows(docs, width, percent).filter(F.col("kept") & F.col("doc_id").isNotNull())
        keep = near.select(F.col("doc_id").alias(row[0]), F.col("source").alias(row[1]))
    else:
        # Numbers in the order of id and text stand for the ids.
        order = pairs.repartitionByRange(*row).sortWithinPartitions(*row)
        named = stored(order.withColumn("name", F.monotonically_increasing_id()), "near-names")
        texts = known.select(*row, "text").join(named, row).select("name", "text")
        near = _near_rows(texts, width, percent, id_col="name").filter("kept")
        keep = near.select(F.col("doc_id").alias("name")).distinct().join(named, "name")
    left = known.join(keep.select(*row), row, "left_semi").dropDuplicates(row)
    return left.select(*docs.columns).union(docs.filter(F.col("doc_id").isNull()))


def _classes(sketches: DataFrame) -> DataFrame:
    """(rep, source, set_key, n, sketch, keys) for each distinct set: its smallest id stands for it."""
    return (
        sketches.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "source", "n", "sketch", "keys")).alias("least"))
        .select(
            F.col("least.doc_id").alias("rep"),
            F.col("least.source").alias("source"),
            "set_key",
            F.col("least.n").alias("n"),
            F.col("least.sketch").alias("sketch"),
            F.col("least.keys").alias("keys"),
        )
    )


def _linked_components(
    rows: DataFrame, classes: DataFrame, width: int, percent: int
) -> DataFrame | None:
    """Components of classes; None if no key holds two classes."""
    threshold = percent / 100
    shared = _shared_bands(classes, "near")
    # The texts are shuffled once; later turns join the sets of classes that share a key.
    items = stored(_items(shared.select("rep"), rows, classes, width), "near-items")
    found = tested = links = None
    for turn in range(STARS + 1):
        members = _with_components(shared, found)
        if turn:
            members = stored(_open_keys(members), f"near-open{turn}")
        if members.isEmpty():
            break
        if turn == STARS:
            new = _blocked_links(members, items, classes, percent)
        else:
            pairs = _likely(_star_pairs(members, turn), classes, threshold)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = stored(pairs, f"near-pairs{turn}")
            tested = pairs if tested is None else tested.union(pairs)
            new = _confirmed(pairs, items, percent)
        new = stored(new, f"near-confirmed{turn}")
        if turn and new.isEmpty():
            continue
        links = new if links is None else links.union(new)
        found = components(links, f"near{turn}")
    return found
