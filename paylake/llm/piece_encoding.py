"""SentencePiece encoding by a shared-prefix Viterbi search, and decoding.

Spaces become the mark U+2581 and one mark stands before the text. No piece of a supported
model has a mark behind another character, so a text is cut before every run of marks, and
each marked word is encoded by itself.

A batch's distinct marked words are sorted. Read in that order they are a depth-first walk
over their trie: a word's forward states up to the prefix it shares with the one before are
already there, and only the rest is worked out. The state of a prefix is its best score and
last piece, over all pieces that end there.

For a UNIGRAM model a score is the sum of the pieces' scores. For a BPE model scores only
order merges, so the search keeps to sequences that merging gives: two pieces may follow each
other if merging their joined text gives these two again. The encoding of a prefix is the
one sequence all of whose neighbours may, so best path and library result are the same.

Characters that no piece covers are written in byte pieces, or as the unknown piece where
the model has none. Decoding restores the text exactly if the model's normaliser is the
identity and the text has neither marks nor unknown pieces of its own. The file's path is a
parameter, and tasks read the file from what the driver broadcast. Null and empty texts have
no pieces. Rows are handled one by one: repeated rows and null ids come out as they went in.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import keyed_text, slices

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
UNIGRAM, BPE = 1, 2
# Words remembered between batches of a task: their ids.
CACHE_WORDS = 200_000
CACHE_PAIRS = 400_000
UNKNOWN_PENALTY = 10.0
_CODE_BITS = 22  # room for all pieces and, behind them, all characters


@dataclass
class PieceModel:
    """Pieces by text, with their scores and kinds, from a model file's own description."""

    ids: dict[str, int]
    scores: list[float]
    texts: list[str]
    byte_ids: list[int]  # the piece of each byte, or empty
    unknown: int
    kind: int
    prefix: bool
    tails: dict[str, int] = field(default_factory=dict)  # ends of pieces: the piece or -1
    pairs: dict[int, bool] = field(default_factory=dict)
    byte_of: dict[int, int] = field(default_factory=dict)
    raw: list[bytes] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.tails = {t[i:]: -1 for t in self.ids for i in range(len(t))} | self.ids
        # What each id is in the text: its bytes, with spaces for marks.
        self.raw = [t.replace(MARK, " ").encode("utf-8", "surrogatepass") for t in self.texts]
        for i, b in self.byte_of.items():
            self.raw[i] = bytes([b])

    @classmethod
    def from_bytes(cls, content: bytes) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2 as description

        model = description.ModelProto()
        model.ParseFromString(content)
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        if not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that mark words in front are supported")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only UNIGRAM and BPE models are supported")
        piece = description.ModelProto.SentencePiece
        ids, scores, texts, byte_ids, unknown = {}, [], [], [0] * 256, 0
        for i, p in enumerate(model.pieces):
            texts.append(p.piece)
            scores.append(p.score)
            if p.type == piece.NORMAL:
                if MARK in p.piece.lstrip(MARK):
                    raise ValueError("a piece has a mark behind another character")
                ids[p.piece] = i
            elif p.type == piece.BYTE:
                byte_ids[int(_BYTE.fullmatch(p.piece).group(1), 16)] = i
            elif p.type == piece.UNKNOWN:
                unknown = i
            elif p.type == piece.USER_DEFINED:
                raise ValueError("models with pieces defined by the user are not supported")
        return cls(
            ids,
            scores,
            texts,
            byte_ids if all(byte_ids) else [],
            unknown,
            model.trainer_spec.model_type,
            norm.add_dummy_prefix,
        )

    def merged(self, text: str) -> list[str]:
        """Symbols after merging the best neighbours, leftmost first, until none may merge."""
        symbols: list[str | None] = list(text)
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                joined = symbols[i] + symbols[after[i]]
                if joined in self.ids:
                    heapq.heappush(queue, (-self.scores[self.ids[joined]], i, joined))

        for i in range(len(symbols)):
            offer(i)
        while queue:
            _, i, joined = heapq.heappop(queue)
            j = after[i]
            if symbols[i] is None or j < 0 or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j] = joined, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def text_of(self, code: int) -> str:
        return self.texts[code] if code < len(self.texts) else chr(code - len(self.texts))

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two pieces gives these two; remembered."""
        pair = [self.text_of(left), self.text_of(right)]
        known = self.merged("".join(pair)) == pair
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left << _CODE_BITS | right] = known
        return known

    def fallback(self, char: str) -> list[int]:
        if self.byte_ids:
            return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def encode_sorted(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each of the words, which come in sorted order, each once."""
        extend = self._extend_bpe if self.kind == BPE else self._extend_unigram
        known, raw_size = len(self.texts), [len(t) for t in self.texts]
        before = ""
        # The forward states of the current path: best score and last piece of each prefix.
        # A character without a piece has a code of its own behind the pieces' ids.
        best, last = [0.0], [-1]
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], last[shared + 1 :]
            extend(word, shared, best, last)
            out, end, plain = [], len(word), True
            while end:
                code = last[end]
                out.append(code)
                if code < known:
                    end -= raw_size[code]
                else:
                    end, plain = end - 1, False
            out.reverse()
            if not plain:
                out = [i for c in out for i in ((c,) if c < known else self.fallback(chr(c - known)))]
            yield out
            before = word

    def _extend_bpe(self, word: str, shared: int, best: list[float], last: list[int]) -> None:
        """Forward states from ``shared`` on: the one piece that may end there."""
        tail, fits_of, known = self.tails.get, self.pairs.get, len(self.texts)
        for end in range(shared + 1, len(word) + 1):
            start, found = end - 1, -1
            # Every end of a piece is known, so the first unknown text ends the search.
            while start >= 0 and (code := tail(word[start:end])) is not None:
                if code >= 0:
                    if not start:
                        found = code
                        break
                    fits = fits_of(last[start] << _CODE_BITS | code)
                    if fits is None:
                        fits = self.may_follow(last[start], code)
                    if fits:
                        found = code
                        break
                start -= 1
            last.append(found if found >= 0 else known + ord(word[end - 1]))

    def _extend_unigram(self, word: str, shared: int, best: list[float], last: list[int]) -> None:
        """Forward states from ``shared`` on: the best score; of equal ones the longer piece."""
        tail, scores, known = self.tails.get, self.scores, len(self.texts)
        floor = min(scores, default=0.0) - UNKNOWN_PENALTY
        for end in range(shared + 1, len(word) + 1):
            start, found, top = end - 1, known + ord(word[end - 1]), None
            while start >= 0 and (code := tail(word[start:end])) is not None:
                if code >= 0:
                    score = best[start] + scores[code]
                    if top is None or score >= top:
                        top, found = score, code
                start -= 1
            if tail(word[end - 1], -1) < 0 and (top is None or best[end - 1] + floor > top):
                top, found = best[end - 1] + floor, known + ord(word[end - 1])
            best.append(top)
            last.append(found)

    def marked_words(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", MARK)
        return _WORDS.findall(MARK + text if self.prefix else text)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Encoder:
    """Encodes batch after batch; remembers a bounded number of words between them."""

    def __init__(self, model: PieceModel):
        self.model, self.known = model, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        lists = [self.model.marked_words(t) for t in texts]
        wanted = set().union(*lists) if lists else set()
        known = self.known
        new = sorted(wanted.difference(known))
        coded = {
            w: np.array(ids, np.int32).tobytes()
            for w, ids in zip(new, self.model.encode_sorted(new), strict=True)
        }
        if len(known) + len(coded) > CACHE_WORDS:
            # Words of this batch are the likeliest to come again; others go.
            self.known = known = {w: known[w] for w in wanted.intersection(known)}
        known.update(coded)
        return [np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in lists]


_loaded: dict[int, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    """One encoder per worker process and model."""
    key = zlib.crc32(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(PieceModel.from_bytes(content))
    return _loaded[key]


def public_model() -> str:
    """The path of the public vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The ids of each row; a null row has none."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def encode_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, pieces) for each row of ``docs``, whole texts."""
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for batch in slices(batches, 500):
            found = encoder.encode(batch["text"].to_pylist())
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            pieces = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pieces.cast(pa.list_(pa.int32()))], names=["doc_id", "pieces"]
            )

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, pieces array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) for each row of (doc_id, pieces)."""
    model = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(model.value).model
        for batch in slices(batches):
            texts = [pieces.decode(x.tolist()) for x in _lists(batch["pieces"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame, model_path: str) -> DataFrame:
    """For each row of (doc_id, pieces): their count, checksum, and the decoded text's hash.

    The checksum is crc32 over the ids as little-endian unsigned 32-bit integers.
    """
    model = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(model.value).model
        for batch in slices(batches):
            lists = _lists(batch["pieces"])
            texts = [pieces.decode(x.tolist()).encode("utf-8", "surrogatepass") for x in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(map(len, lists), pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in lists], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                names=["doc_id", "n_pieces", "pieces_crc32", "decoded_sha256"],
            )

    return encoded.select("doc_id", "pieces").mapInArrow(
        run, "doc_id long, n_pieces long, pieces_crc32 long, decoded_sha256 string"
    )


def with_pieces(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pieces``, ``n_pieces`` and ``round_trip``, in place of any such columns.

    ``round_trip`` says whether the decoded pieces give the text again.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    @F.pandas_udf("pieces array<int>, n_pieces long, round_trip boolean")
    def encode(texts: pd.Series) -> pd.DataFrame:
        encoder, values = _encoder(model.value), texts.tolist()
        found = [x for i in range(0, len(values), 500) for x in encoder.encode(values[i : i + 500])]
        same = [
            encoder.model.decode(x.tolist()) == t for x, t in zip(found, values, strict=True)
        ]
        return pd.DataFrame({"pieces": found, "n_pieces": [*map(len, found)], "round_trip": same})

    work = "__pieces"
    text: Column = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = docs.withColumn(work, encode(text))
    return docs.withColumns(
        {c: F.col(f"{work}.{c}") for c in ("pieces", "n_pieces", "round_trip")}
    ).drop(work)
