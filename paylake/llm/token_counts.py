"""Token counts of whole texts by a public tokenizer; only lengths leave the Arrow function.

Rows are taken in groups of about ``GROUP_BYTES`` of text, whatever their number, so a batch
of long texts holds no more at a time than one of short texts. Texts are cut at safe
boundaries: a space, tab or line break behind a character that no definition calls white
space. A byte-level tokenizer's pre-tokens never reach over such a place, and none of the
file's special strings holds white space, so a text has as many tokens as its pieces. A text
above ``GROUP_BYTES`` is cut into stretches there first, each counted by itself.

The distinct pieces of a group that are not remembered go to the library in one batch. What
is remembered is bounded by ``KNOWN_PIECES`` and ``KNOWN_CHARS`` and one group's pieces. Files for
which the boundary is not proven safe (another pre-tokenizer, a normaliser, special strings
that look at their neighbours) and SentencePiece models get whole texts instead.

Special strings inside texts are handled as the library does by default; nothing is added,
cut or padded. A null or empty text has no bytes and no tokens. Each row is counted by
itself: repeated rows and null ids come out as they went in, an empty table gives no rows,
and columns other than the two named are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from paylake.llm.common import groups, keyed_text

GROUP_BYTES = 1 << 20
KNOWN_PIECES, KNOWN_CHARS = 800_000, 16 << 20
LIMIT = 1024

# White space that ends a pre-token for certain, and what any definition of
# white space (Unicode's or a language's) counts besides.
_BREAK = " \t\n\r\x0b\x0c"
_DOUBTFUL = "\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(
    f"[{_BREAK}{_DOUBTFUL}]*[^{_BREAK}{_DOUBTFUL}]+"
    f"(?:[{_DOUBTFUL}][{_BREAK}{_DOUBTFUL}]*[^{_BREAK}{_DOUBTFUL}]*)*"
    f"|[{_BREAK}{_DOUBTFUL}]+"
)
_SAFE = re.compile(f"(?<=[^{_BREAK}{_DOUBTFUL}])(?=[{_BREAK}])")


def public_tokenizer() -> str:
    """The path of the public vocabulary file that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cuts_safely(settings: dict) -> bool:
    """Whether a tokenizer file's tokens never reach over a safe boundary."""
    before = settings.get("pre_tokenizer") or {}
    return (
        settings.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
            or re.search(r"\s", t["content"])
            for t in settings.get("added_tokens", [])
        )
    )


def stretches(text: str, size: int) -> Iterator[str]:
    """The text in parts of ``size`` characters or more, each but the last cut safely."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Counter:
    """Counts tokens with the library that a vocabulary file belongs to."""

    def __init__(self, name: str, content: bytes):
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.safe = False
            self._encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_buffer(content)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.safe = cuts_safely(json.loads(content))
            self._encode = lambda texts: tokenizer.encode_batch_fast(
                texts, add_special_tokens=False
            )
        # Pieces that are not met again go with their generation, the one before this.
        self.known: dict[str, int] = {}
        self.before: dict[str, int] = {}
        self.chars = 0

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the distinct new pieces of all texts are one batch."""
        if not self.safe:
            return list(map(len, self._encode(texts)))
        cut = list(map(_PIECE.findall, texts))
        if len(self.known) > KNOWN_PIECES // 2 or self.chars > KNOWN_CHARS // 2:
            self.known, self.before, self.chars = {}, self.known, 0
        known, before = self.known, self.before
        missing = set().union(*cut).difference(known)
        again = {p: before[p] for p in missing if p in before}
        new = list(missing.difference(again))
        known.update(again)
        known.update(zip(new, map(len, self._encode(new)), strict=True))
        self.chars += sum(map(len, missing))
        return [sum(map(known.__getitem__, own)) for own in cut]

    def count(self, text: str) -> int:
        """Tokens of one long text, a stretch at a time."""
        if not self.safe:
            return self.counts([text])[0]
        return sum(self.counts([part])[0] for part in stretches(text, GROUP_BYTES))


_loaded: dict[tuple[str, int], Counter] = {}


def _counter(name: str, content: bytes) -> Counter:
    """One per worker process and file."""
    key = name, zlib.crc32(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Counter(name, content)
    return _loaded[key]


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its bytes, its tokens, and whether these pass ``limit``."""
    file = Path(tokenizer_path)
    content = docs.sparkSession.sparkContext.broadcast(file.read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file.name, content.value)
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).cast(pa.int64())
            counts: list[int] = []
            for start, end in groups(sizes.to_pylist(), GROUP_BYTES):
                texts = batch["text"].slice(start, end - start).to_pylist()
                long = len(texts) == 1 and len(texts[0]) > GROUP_BYTES
                counts += [counter.count(texts[0])] if long else counter.counts(texts)
            tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], sizes, tokens, pc.greater(tokens, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return keyed_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
