"""Token ids in files: frequency-ranked, in byte-aligned variable length, with control bytes.

Ids are replaced by their rank by frequency over all documents, so most take one byte. A
rank takes 1 to 4 little-endian bytes; its length less one is 2 bits of a control byte, 4
ranks to a byte, lowest bits first. Control bytes and data bytes are kept apart, so that
decoding is a table lookup by control byte and one gather.

A folder of files holds ``ranks`` (the id of each rank) and ``shards``: Parquet with one row
per block of documents, in folders ``part=<n>``. Parts, blocks within a part and documents
within a block ascend by id. A block row has its number, the documents' ids and token
counts, how many tokens its part has before it, and the control and data bytes. Spark's
writer commits the files, so a lost executor's work is done again.

Null and empty texts have only the end id. Null ids come first; rows with equal ids follow
each other by text, and each is a document of its own. An empty table gives no files' rows.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.common import groups, keyed_text, slices, stored
from paylake.session import scratch_dir

BLOCK_TOKENS = 1 << 17
# Bytes of text whose words are looked up at a time; a longer text is alone.
WORK_BYTES = 4 << 20
# Words remembered, those kept when they are more, and bytes of a word that is remembered.
CACHE_WORDS = 500_000
CACHE_KEPT = 400_000
CACHE_WORD_BYTES = 64
END_ID = 1

# For each control byte: the lengths of its four values, their sum, and for each of the 16
# bytes of four 32-bit values where it is found and whether it is there.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_TOTALS = _LENGTHS.sum(axis=1)
_STARTS = np.cumsum(_LENGTHS, axis=1) - _LENGTHS
_THERE = (np.arange(4) < _LENGTHS[:, :, None]).reshape(256, 16)
_SHUFFLE = np.where(
    _THERE, (_STARTS[:, :, None] + np.arange(4)).reshape(256, 16), 0
).astype(np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    lengths = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    two_bits = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    two_bits[: len(values)] = lengths - 1
    control = two_bits[::4] | two_bits[1::4] << 2 | two_bits[2::4] << 4 | two_bits[3::4] << 6
    there = np.arange(4, dtype=np.uint8) < lengths[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[there].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values that ``pack`` was given."""
    code = np.frombuffer(control, np.uint8)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(16, np.uint8)])
    ends = np.cumsum(_TOTALS[code])
    at = (ends - _TOTALS[code])[:, None] + _SHUFFLE[code]
    # The last control byte may stand for fewer than four values.
    four = raw[np.minimum(at, len(raw) - 1)] * _THERE[code]
    return np.ascontiguousarray(four, np.uint8).view("<u4").reshape(-1)[:n]


# Words of these Latin letters (all of them in composed form, each with one lower-case letter)
# and closing marks are cut into just these two pieces, whatever the text around them.
_LETTERS = re.compile(
    "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+"
)
_MARKS = ".,!?;:#$%&*|"
# Byte-level models write a byte as itself where that is a visible Latin-1 character, and the
# others in order from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}


class Remembered:
    """Words and their ids in Arrow arrays: a few dozen bytes a word, where Python takes 200.

    Words not met for longest go first, and long words are not kept, which bounds the memory.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.met, self.now = np.zeros(0, np.int32), 0

    def __len__(self) -> int:
        return len(self.words)

    def ids_of(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, in bytes; those not remembered are encoded."""
        self.now += 1
        found = pc.index_in(self.words, value_set=words)
        known = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        at = np.full(len(words), -1, np.int64)
        at[found.drop_null().to_numpy()] = known
        new = np.flatnonzero(at < 0)
        at[new] = len(self.words) + np.arange(len(new))
        new_words = words.take(pa.array(new))
        new_ids = pa.array([self.encode(w) for w in new_words.to_pylist()], pa.large_binary())
        out = pa.concat_arrays([self.ids, new_ids]).take(pa.array(at))
        self.met[known] = self.now
        short = pc.less_equal(pc.binary_length(new_words), CACHE_WORD_BYTES)
        self._keep(new_words.filter(short), new_ids.filter(short))
        return out

    def _keep(self, words: pa.Array, ids: pa.Array) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids = pa.concat_arrays([self.ids, ids])
        self.met = np.concatenate([self.met, np.full(len(words), self.now, np.int32)])
        if len(self.words) > CACHE_WORDS:
            last = np.sort(np.argpartition(self.met, -CACHE_KEPT)[-CACHE_KEPT:])
            self.words, self.ids = self.words.take(pa.array(last)), self.ids.take(pa.array(last))
            self.met = self.met[last]


class WordTokenizer:
    """Encodes whole texts with the tokenizers library, each distinct word once in a while.

    The tokenizer drops white space and never joins what white space parts, so a text's ids
    are those of its words. Of simple words the letters go straight to the library's model,
    in lower case, and other words through all of the library's steps. A bounded number of
    words is remembered from batch to batch, simple ones as their letters and marks.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(content)
        self.model = self.tokenizer.model
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.known = Remembered(self._word)

    def _packed(self, ids: list[int]) -> bytes:
        # Most words have a few ids: an array of Python's own is made faster than numpy's.
        return array("H" if self.dtype == "<u2" else "I", ids).tobytes()

    def _whole(self, word: str) -> bytes:
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _stem(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTE_CHARS)
        return self._packed([t.id for t in self.model.tokenize(letters)])

    def _word(self, word: str) -> bytes:
        return self._stem(word.lower()) if _LETTERS.fullmatch(word) else self._whole(word)

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, in bytes."""
        stems = pc.utf8_rtrim(words, characters=_MARKS)
        simple = pc.match_substring_regex(stems, f"^(?:{_LETTERS.pattern})$")
        firsts = pc.if_else(simple, pc.utf8_lower(stems), words)
        lengths = pc.binary_length(stems).to_numpy()
        marked = np.flatnonzero(
            simple.to_numpy(zero_copy_only=False) & (lengths < pc.binary_length(words).to_numpy())
        )
        # Marks are ASCII: what a word ends in after as many bytes as its letters take.
        ends = pa.array(
            [
                word[n:].decode()
                for word, n in zip(
                    words.take(pa.array(marked)).cast(pa.large_binary()).to_pylist(),
                    lengths[marked].tolist(),
                    strict=True,
                )
            ],
            pa.large_string(),
        )
        parts = pa.concat_arrays([firsts, ends]).dictionary_encode()
        codes = parts.indices.to_numpy()
        # An empty word has no ids, and so has the second part of a word without marks.
        two = np.zeros((len(words), 2), np.int64)
        there = np.zeros((len(words), 2), bool)
        two[:, 0], there[:, 0] = codes[: len(words)], pc.binary_length(words).to_numpy() > 0
        two[marked, 1], there[marked, 1] = codes[len(words) :], True
        ids = self.known.ids_of(parts.dictionary)
        both = ids.take(pa.array(two.reshape(-1), mask=~there.reshape(-1)))
        starts, data = _bytes_of(both)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(words), [None, pa.py_buffer(starts[::2].copy()), data]
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.each(pa.array(texts, pa.large_string())))

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        texts = texts.cast(pa.large_string())
        for start, end in groups(pc.binary_length(texts).to_pylist(), WORK_BYTES):
            words = pc.split_pattern(
                pc.replace_substring(texts.slice(start, end - start), "\n", " "), " "
            )
            met = words.flatten().dictionary_encode()
            starts, data = _bytes_of(self._ids_of(met.dictionary).take(met.indices))
            offsets = words.offsets.to_numpy()
            ends = starts[offsets - offsets[0]] // np.dtype(self.dtype).itemsize
            ids = np.frombuffer(memoryview(data)[: starts[-1]], self.dtype)
            ends = ends.tolist()
            yield from (ids[i:j] for i, j in zip(ends, ends[1:], strict=False))


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Where each of the values starts, and the end of the last; and the bytes of all."""
    _, offsets, data = values.buffers()
    starts = np.frombuffer(offsets, np.int64, len(values) + 1, 8 * values.offset)
    return starts, data if data is not None else pa.py_buffer(b"")


def id_type(ids: int) -> str:
    """The type that ids are kept in before they are ranked."""
    return "<u2" if ids <= 1 << 16 else "<u4"


_loaded: dict[int, WordTokenizer] = {}


def _tokenizer(content: bytes) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    key = zlib.crc32(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordTokenizer(content)
    return _loaded[key]


def public_tokenizer() -> str:
    """The path of the public vocabulary file that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_IDS = "part int, block int, before long, doc_ids array<bigint>, counts array<bigint>, ids binary"
_SHARDS = (
    "part int, block int, before long, doc_ids array<bigint>, counts array<bigint>,"
    " control binary, data binary"
)


def _encoded(docs: DataFrame, content, end_id: int) -> DataFrame:
    """Blocks of documents in ascending order, with plain ids; the end id closes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part = _tokenizer(content.value), TaskContext.get().partitionId()
        block, before = 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        end = np.array([end_id], tokenizer.dtype)

        def close() -> pa.RecordBatch:
            counts = [len(x) for x in held]
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                    "counts": pa.array([counts], pa.list_(pa.int64())),
                    "ids": pa.array([np.concatenate(held).tobytes()], pa.binary()),
                }
            )

        n = 0
        for batch in batches:
            found = tokenizer.each(batch["text"])
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), found, strict=True):
                doc_ids.append(doc_id)
                held.append(np.concatenate([ids, end]))
                n += len(ids) + 1
                if n >= BLOCK_TOKENS:
                    yield close()
                    block, before, n = block + 1, before + n, 0
                    doc_ids, held = [], []
            # A worker lives on, and another one may stand beside it.
            pa.default_memory_pool().release_unused()
        if held:
            yield close()

    return docs.mapInArrow(run, _IDS)


def _frequencies(encoded: DataFrame, dtype: str) -> list[tuple[int, int]]:
    """(id, count) of all ids that occur: at most as many rows as the vocabulary has ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch["ids"].to_pylist():
                own = np.bincount(np.frombuffer(raw, dtype))
                if len(own) > len(total):
                    own[: len(total)] += total
                    total = own
                else:
                    total[: len(own)] += own
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"]
        )

    counts = encoded.select("ids").mapInArrow(count, "id long, n long")
    return [tuple(r) for r in counts.groupBy("id").agg(F.sum("n").alias("n")).collect()]


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    target: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Writes the tokens of all rows of ``docs`` as files under ``target``."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(tokenizer_path).read_bytes())
    dtype = WordTokenizer(content.value).dtype
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        keyed_text(docs, id_col, text_col)
        .repartitionByRange(partitions, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    encoded = stored(_encoded(ordered, content, end_id), "token-ids")
    counts = sorted(_frequencies(encoded, dtype), key=lambda x: (-x[1], x[0]))
    ranks = [(rank, int(i)) for rank, (i, _) in enumerate(counts)]
    spark.createDataFrame(ranks, "rank long, id long").coalesce(1).write.parquet(f"{target}/ranks")
    rank_of = np.zeros(max((i for _, i in ranks), default=0) + 1, "<u4")
    for rank, i in ranks:
        rank_of[i] = rank

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            packed = [pack(rank_of[np.frombuffer(x, dtype)]) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in ("part", "block", "before", "doc_ids", "counts")],
                    pa.array([c for c, _ in packed], pa.binary()),
                    pa.array([d for _, d in packed], pa.binary()),
                ],
                names=["part", "block", "before", "doc_ids", "counts", "control", "data"],
            )

    encoded.mapInArrow(shard, _SHARDS).write.partitionBy("part").option(
        "compression", "zstd"
    ).parquet(f"{target}/shards")


@dataclass
class TokenFiles:
    """A folder that ``write_token_files`` wrote."""

    spark: SparkSession
    folder: str

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(_SHARDS).parquet(f"{self.folder}/shards")

    def ids_by_rank(self) -> np.ndarray:
        rows = self.spark.read.schema("rank long, id long").parquet(f"{self.folder}/ranks").collect()
        out = np.zeros(len(rows), "<u4")
        for rank, i in rows:
            out[rank] = i
        return out

    def part_starts(self) -> dict[int, int]:
        """Tokens before each part: one row per part reaches the driver."""
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        sums = self.blocks().groupBy("part").agg(F.sum(total).alias("n")).collect()
        starts, at = {}, 0
        for part, n in sorted(map(tuple, sums)):
            starts[part], at = at, at + n
        return starts

    def _decoded(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
        """Turns block rows into (ids of documents, their starts and ends, token ids)."""
        ids_by_rank, starts = self.ids_by_rank(), self.part_starts()

        def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for row in (r for b in slices(batches, 1) for r in b.to_pylist()):
                ends = np.cumsum(np.array(row["counts"], np.int64))
                ranks = unpack(row["control"], row["data"], int(ends[-1]))
                offsets = np.concatenate([[0], ends])
                first = starts[row["part"]] + row["before"]
                yield pa.array(row["doc_ids"], pa.int64()), first, offsets, ids_by_rank[ranks]

        return decode

    def documents(self) -> DataFrame:
        """(doc_id, start, ids) of every document, decoded from the files."""
        decoded = self._decoded()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for doc_ids, first, offsets, ids in decoded(batches):
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(first + offsets[:-1]), lists],
                    names=["doc_id", "start", "ids"],
                )

        return self.blocks().mapInArrow(run, "doc_id long, start long, ids array<int>")

    def digests(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

        The checksum is over the ids as little-endian unsigned 32-bit integers.
        """
        decoded = self._decoded()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for doc_ids, first, offsets, ids in decoded(batches):
                raw = memoryview(ids.astype("<u4").tobytes())
                at = (4 * offsets).tolist()
                sums = [zlib.crc32(raw[i:j]) for i, j in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(first + offsets[:-1]),
                        pa.array(np.diff(offsets)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

        schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
        return self.blocks().mapInArrow(run, schema)


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/llm/token-files-{uuid.uuid4().hex[:12]}"
