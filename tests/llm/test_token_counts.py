import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paylake.llm import token_counts
from paylake.llm.common import groups


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.public_tokenizer())


def file_counter(name="byte_bpe_50k.json"):
    path = Path(token_counts.public_tokenizer()).parent / name
    return token_counts.Counter(name, path.read_bytes())


def plain(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("which", ["documents", "odd", "none"])
def test_counts_are_the_librarys(spark, request, library, which):
    docs = request.getfixturevalue(which)
    got = token_counts.count_tokens(docs, token_counts.public_tokenizer())
    want = [
        (r.doc_id, len((r.text or "").encode()), plain(library, r.text), plain(library, r.text) > 1024)
        for r in docs.select("doc_id", "text").collect()
    ]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


PARTS = [
    "a", "B", "é", "1", "²", " ", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ",
    "　", "​", "'s", "'", "'ll", "!", "?!", "😀", "́", "文", "\x00", "<|endoftext|>", "<|end",
]


def test_pieces_of_odd_texts_add_up(library):
    counter, rng = file_counter(), random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 16))) for _ in range(8000)]
    want = [plain(library, t) for t in texts]
    assert counter.counts(texts) == want
    for text, n in zip(texts, want, strict=True):
        parts = list(token_counts.stretches(text, 3))
        assert "".join(parts) == text
        assert sum(counter.counts(parts)) == n


def test_memory_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 40)
    counter, rng = file_counter(), random.Random(6)
    for _ in range(60):
        texts = [" ".join(f"w{rng.randint(0, 200)}" for _ in range(9)) for _ in range(3)]
        assert counter.counts(texts) == [plain(library, t) for t in texts]
        assert len(counter.known) <= 20 + 27 and len(counter.before) <= 20 + 27


def test_long_texts_go_by_stretches(spark, library, monkeypatch):
    texts = ["word and\nword, " * 3000, "x" * 50_000, "one two", "<|endoftext|>" * 2000, " " * 30_000]
    counter = file_counter()
    monkeypatch.setattr(token_counts, "GROUP_BYTES", 1000)
    assert [counter.count(t) for t in texts] == [plain(library, t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_counts.count_tokens(docs, token_counts.public_tokenizer(), limit=3)
    assert [r.n_tokens for r in got.orderBy("doc_id").collect()] == [plain(library, t) for t in texts]
    assert got.filter(F.col("over_limit") != (F.col("n_tokens") > 3)).isEmpty()


def test_groups_are_balanced_by_bytes():
    sizes = [5, 5, 100, 1, 1, 1, 9, 3]
    assert list(groups(sizes, 10)) == [(0, 2), (2, 3), (3, 6), (6, 7), (7, 8)]
    assert list(groups([], 10)) == []


def test_other_files_get_whole_texts():
    texts = ["It's  a\nTest of wórds", "", " x <|endoftext|> y "]
    words, model = file_counter("word_bpe_49k.json"), file_counter("piece_bpe_32k.model")
    assert not words.safe and not model.safe
    import sentencepiece
    from tokenizers import Tokenizer

    folder = Path(token_counts.public_tokenizer()).parent
    other = Tokenizer.from_file(str(folder / "word_bpe_49k.json"))
    assert words.counts(texts) == [plain(other, t) for t in texts]
    pieces = sentencepiece.SentencePieceProcessor(model_file=str(folder / "piece_bpe_32k.model"))
    assert model.counts(texts) == [len(pieces.encode(t)) for t in texts]
