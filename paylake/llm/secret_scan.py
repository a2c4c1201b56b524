r"""Secrets in texts: patterns propose candidates, their decoded structure confirms them.

Base kinds, as the patterns have them: ``assign`` (a name such as ``password``, a sign and
a value of 8 or more characters), ``access`` (``AKIA``, 16 or more characters) and ``hex``
(32 or more lowercase hex digits). Added kinds, each reported only when it parses:

``signed``  three base64url parts, the first a JSON object with ``alg``, the second JSON
``der``     base64 (of either alphabet, also over lines) or hex (also in pairs with colons)
            whose bytes are one DER SEQUENCE with exactly nested lengths and the shape of a
            private key: a version and integers, or an octet string, or an algorithm and an
            octet string; or an encrypted one: an algorithm and an octet string. Public keys
            and certificates have other shapes
``wire``    base64 of an OpenSSH private key file: its magic and length-prefixed strings
``pem``     an armoured block whose label ends in KEY, of any length, also with line breaks
            written as ``\n`` or with marks of quotation before its lines. Its body, less
            header lines and a PGP checksum, must decode to exactly nested DER or to an
            OpenSSH key, or begin as a PGP secret key; a body that its headers call encrypted
            need only be base64. Left out: labels that say PUBLIC, blocks without an END line
            of the same label, and PKCS#8 blocks that are encrypted but no DER

A null or empty text has none. Rows are handled one by one, so repeated rows and null ids
come out as they went in; other columns are not looked at. Whole texts are scanned.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from paylake.llm.common import keyed_text, slices

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "signed", "der", "wire", "pem")
_NAMES = ("passw", "secret", "token", "api")

# Letters in either case within ASCII only; group 2 is the value.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_SIGNED = re.compile(r"(?<![\w-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]{8,})")
# A JSON object's first letters in base64; a failed start hides no later one.
_HEADER = re.compile(
    r"(?<![\w-])(?=((e[w-z][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{4,})\.[A-Za-z0-9_-]{8,}))"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
# Where a SEQUENCE may begin in base64: at a run's start, behind its marks or a written "\n".
_SEQUENCE = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\\n))M[A-P][A-Za-z0-9+/_-]{6}")
_ANYHEX = re.compile(r"[0-9A-Fa-f]{64,}")
_PAIRS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::\s{0,40}[0-9A-Fa-f]{2}){23,}+")
_ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*+)-----")
_LABEL = re.compile(r"(?!.*PUBLIC).*KEY(?: BLOCK)?")
_HEADERS = re.compile(r"(?:\s*+[A-Za-z][A-Za-z0-9-]*+:[^\n]*+(?:\n[\x20\t][^\n]*+)*+)*+")
_ENCRYPTED = re.compile(r"^Proc-Type:.*ENCRYPTED", re.MULTILINE)
_CHECKSUM = re.compile(r"\s=[A-Za-z0-9+/]{4}\s*$")
_WRITTEN = re.compile(r"\\+[nrt]")
_MARKS = re.compile(r"^[\x20\t>|#*]+", re.MULTILINE)
_TO_PLAIN = str.maketrans("-_", "+/")


def unbase64(value: str, url: bool = False) -> bytes | None:
    value = value.rstrip("=")
    if len(value) % 4 == 1:
        return None
    value += "=" * (-len(value) % 4)
    try:
        return base64.b64decode(value, altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """A DER length and where its content begins; None for a form that DER forbids."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data):
        return None
    value = int.from_bytes(data[at + 1 : at + 1 + n], "big")
    return None if value < max(0x80, 1 << 8 * (n - 1)) else (value, at + 1 + n)


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, where its content begins, where it ends) of the elements that fill a range."""
    out = []
    while start < end:
        if not (got := _length(data, start + 1)) or got[0] + got[1] > end:
            return None
        length, inner = got
        out.append((data[start], inner, inner + length))
        start = inner + length
    return out


def _nested(data: bytes, top: list[tuple[int, int, int]]) -> bool:
    """Whether the elements within elements, however deep, fill these exactly."""
    left = [x for x in top if x[0] & 0x20]
    while left:
        _, start, end = left.pop()
        within = _elements(data, start, end)
        if within is None:
            return False
        left += [x for x in within if x[0] & 0x20]
    return True


def _sequence(data: bytes | None) -> list[tuple[int, int, int]] | None:
    """The elements of one SEQUENCE that fills the bytes, if all lengths in it fit."""
    if not data or len(data) < 24 or data[0] != 0x30 or not (got := _length(data, 1)):
        return None
    if got[0] + got[1] != len(data):
        return None
    top = _elements(data, got[1], len(data))
    return top if top and _nested(data, top) else None


def is_der(data: bytes | None) -> bool:
    """One SEQUENCE that fills the bytes, of nested lengths that fit, with 2 or more elements."""
    top = _sequence(data)
    return top is not None and len(top) >= 2


def is_der_key(data: bytes | None) -> bool:
    """DER in the shape of a private key, plain or encrypted."""
    top = _sequence(data)
    if not top or len(top) < 2:
        return False
    tags = [tag for tag, _, _ in top]
    of_algorithm = [
        tag == 0x30 and start < end and data[start] == 0x06 for tag, start, end in top
    ]
    if of_algorithm[0]:
        return tags[1:] == [0x04]
    _, start, end = top[0]
    if tags[0] != 0x02 or end - start != 1 or data[start] > 2:
        return False
    if tags[1] == 0x02:
        return len(tags) >= 4 and set(tags) == {0x02}
    if tags[1] == 0x04:
        return set(tags[2:]) <= {0xA0, 0xA1}
    return of_algorithm[1] and len(tags) >= 3 and tags[2] == 0x04


def der_in_base64(text: str, at: int) -> int | None:
    """Where the base64 of a DER key that begins at a place ends; None if there is none.

    The first bytes say how long it is; so many letters are taken, over line breaks and the
    blanks and marks of quotation behind them, written line breaks too.
    """
    head = unbase64(text[at : at + 8].translate(_TO_PLAIN))
    if not head or not (got := _length(head, 1)):
        return None
    size = got[0] + got[1]
    letters, parts = -(-size * 4 // 3), []
    # A key begins with an integer or a sequence, and is not longer than what is there.
    if letters > len(text) - at or (got[1] < len(head) and head[got[1]] not in (0x02, 0x30)):
        return None
    while letters > 0:
        run = _RUN.match(text, at, at + letters)
        if not run:
            return None
        parts.append(run.group())
        letters -= run.end() - at
        at = run.end()
        if letters > 0:
            gap = _GAP.match(text, at)
            if not gap:
                return None
            at = gap.end()
    data = unbase64("".join(parts).translate(_TO_PLAIN))
    if not is_der_key(data):
        return None
    padding = -len("".join(parts)) % 4
    while padding and text[at : at + 1] == "=":
        at, padding = at + 1, padding - 1
    return at if not _RUN.match(text, at) else None


_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_GAP = re.compile(r"(?:\r?\n|\\+r\\+n|\\+n)[\x20\t>|#*]{0,40}")


def is_wire_key(data: bytes | None) -> bool:
    """An OpenSSH private key file: its magic, and the fields that stand before its keys."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):  # the cipher, the derivation and its options, then the count
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data)


def is_signed_token(header: str, claims: str) -> bool:
    try:
        top = json.loads(unbase64(header, url=True) or b"")
        body = json.loads(unbase64(claims, url=True) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(top, dict) and isinstance(top.get("alg"), str) and isinstance(body, dict)


def is_armoured_key(label: str, body: str) -> bool:
    """Whether what stands between the BEGIN and END lines of a label is a key."""
    body = _MARKS.sub("", _WRITTEN.sub("\n", body))
    headers = _HEADERS.match(body).group()
    body = body[len(headers) :]
    pgp = label.endswith("BLOCK")
    data = unbase64("".join((_CHECKSUM.sub("", body) if pgp else body).split()))
    if pgp:  # a packet's first byte: the old or the new form of tag 5, a secret key
        return bool(data) and len(data) >= 24 and (data[0] & 0xFC == 0x94 or data[0] == 0xC5)
    if _ENCRYPTED.search(headers):
        return bool(data) and len(data) >= 24
    return is_der(data) or is_wire_key(data)


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed. Code points, end exclusive."""
    spans = []
    if any(name in text.lower() for name in _NAMES):
        spans += [
            ("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8
        ]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    # Candidates below hold no white space: a text without a long word has none.
    if any(len(word) >= 24 for word in text.split()):
        spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
        if "." in text:
            for pattern, whole, header, claims in ((_SIGNED, 0, 1, 2), (_HEADER, 1, 2, 3)):
                spans += [
                    ("signed", *m.span(whole))
                    for m in pattern.finditer(text)
                    if is_signed_token(m.group(header), m.group(claims))
                ]
        for m in _BASE64.finditer(text):
            if is_wire_key(unbase64(m.group())):
                spans.append(("wire", *m.span()))
        for m in _SEQUENCE.finditer(text):
            if end := der_in_base64(text, m.start()):
                spans.append(("der", m.start(), end))
        for m in _ANYHEX.finditer(text):
            if len(m.group()) % 2 == 0 and is_der_key(bytes.fromhex(m.group())):
                spans.append(("der", *m.span()))
    if ":" in text:
        for m in _PAIRS.finditer(text):
            if is_der_key(bytes.fromhex("".join(m.group().replace(":", "").split()))):
                spans.append(("der", *m.span()))
    if "-----BEGIN" in text:
        begin = None
        for m in _ARMOUR.finditer(text):
            if not _LABEL.fullmatch(m.group(2)):
                continue
            if m.group(1) == "BEGIN":
                begin = m
            elif begin and begin.group(2) == m.group(2):
                if is_armoured_key(m.group(2), text[begin.end() : m.start()]):
                    spans.append(("pem", begin.start(), m.end()))
                begin = None
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_COUNTS = [f"n_{k}" for k in KINDS]
SCHEMA = f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts by kind, digest of base spans, all spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [find_spans(t) for t in batch["text"].to_pylist()]
            base = [_listed([s for s in spans if s[0] in BASE]) for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    *[
                        pa.array([sum(s[0] == k for s in spans) for spans in found], pa.int64())
                        for k in KINDS
                    ],
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([_listed(spans) for spans in found], pa.string()),
                ],
                names=["doc_id", *_COUNTS, "base_sha256", "spans"],
            )

    return keyed_text(docs, id_col, text_col).mapInArrow(scan, SCHEMA)
