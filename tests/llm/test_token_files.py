import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import token_files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=200))
def test_pack_round_trip(values):
    control, data = token_files.pack(np.array(values, "<u4"))
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


def expected(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.public_tokenizer())
    rows = sorted(
        ((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
    )
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["documents", "odd", "none"])
def test_files_hold_what_the_library_encodes(spark, request, which):
    docs = request.getfixturevalue(which)
    folder = token_files.new_folder(spark)
    token_files.write_token_files(docs, token_files.public_tokenizer(), folder)
    files = token_files.TokenFiles(spark, folder)
    want = expected(docs)
    assert [tuple(r) for r in files.digests().orderBy("start").collect()] == want
    whole = [
        (r.doc_id, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        for r in files.documents().orderBy("start").collect()
    ]
    assert whole == want


def test_words_of_a_text_give_the_texts_ids():
    from tokenizers import Tokenizer

    path = token_files.public_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    with open(path, "rb") as f:
        own = token_files.WordTokenizer(f.read())
    texts = [
        "It's  we'll\tÁ e ́x\nΣΑΣ Σ İstanbul ß  ﬁne <|endoftext|> 12.5%",
        "a b c\x1cd\x85e\r\nf",
        "'s 's'S don't’t ... !!! ###$$$",
    ]
    got = own.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_a_large_vocabulary_are_encoded_once():
    tokenizer = token_files.WordTokenizer(Path(token_files.public_tokenizer()).read_bytes())
    encoded = []
    tokenizer._word = lambda word: encoded.append(word) or b"\0\0"
    tokenizer.known = token_files.Remembered(tokenizer._word)
    texts = [" ".join(f"w{i}" for i in range(at, at + 1_000)) for at in range(0, 480_000, 1_000)]
    for _ in range(2):
        assert [len(ids) for ids in tokenizer.encode(texts)] == [1_000] * 480
    assert len(encoded) == 480_000


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.public_tokenizer())
    return [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_all_letters_and_marks_give_the_librarys_ids():
    tokenizer = token_files.WordTokenizer(Path(token_files.public_tokenizer()).read_bytes())
    letters = [chr(c) for c in range(0x21, 0x250)]
    texts = [
        "",
        " ",
        "\n\n",
        *[f"{c} a{c} {c}b {c}. a{c}b?! {c}{c}&*| .{c}" for c in letters],
        "".join(letters),
        "word... WORD... word!?! ... !! a.b, it's. don't!",
    ]
    assert [ids.tolist() for ids in tokenizer.encode(texts)] == library_ids(texts)
    assert [ids.tolist() for ids in tokenizer.encode(["", " "])] == [[], []]
    assert tokenizer.encode([]) == []


def test_forgotten_and_long_words_give_the_same_ids(monkeypatch):
    for name, value in {
        "CACHE_WORDS": 40, "CACHE_KEPT": 20, "CACHE_WORD_BYTES": 8, "WORK_BYTES": 100
    }.items():
        monkeypatch.setattr(token_files, name, value)
    tokenizer = token_files.WordTokenizer(Path(token_files.public_tokenizer()).read_bytes())
    texts = [f"The w{i} word{chr(97 + i % 26)}, {'long' * (i % 60)}! ÉTÉ {i}." for i in range(300)]
    for _ in range(2):
        assert [ids.tolist() for ids in tokenizer.encode(texts)] == library_ids(texts)
        assert len(tokenizer.known) <= 40
        assert max(map(len, tokenizer.known.words.to_pylist())) <= 8


def test_remembered_words_take_little_memory():
    code = """
import psutil, random
from pathlib import Path
from paylake.llm import token_files

tokenizer = token_files.WordTokenizer(Path(token_files.public_tokenizer()).read_bytes())
draw = random.Random(1)
before = psutil.Process().memory_info().rss
for _ in range(100):
    text = " ".join("".join(draw.choices("etaoinsr", k=9)) for _ in range(10_000))
    tokenizer.encode([text])
print((psutil.Process().memory_info().rss - before) >> 20)
"""
    done = subprocess.run(
        [sys.executable, "-c", code],
        capture_output=True,
        text=True,
        check=True,
        cwd=Path(__file__).resolve().parents[2],
    )
    assert int(done.stdout) < 100
