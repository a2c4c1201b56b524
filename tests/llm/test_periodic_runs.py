import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import periodic_runs, queries
from paylake.llm.periodic_runs import Catchers, runs_of


def plain_runs(words, exponent=4, least=6):
    """Every period of every longest stretch, by definition; a stretch counts by its smallest."""
    n, best = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                best.setdefault((i, j - i + q), q)
            i = j
    # A multiple of a stretch's smallest period bounds the same stretch.
    return sorted((s, length, q) for (s, length), q in best.items())


def plain_documents(rows):
    """(doc_id, n, runs, kept words) of the query, word by word."""
    out = []
    for doc_id, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        n = len(words)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        out.append((doc_id, n, runs, [w for i, w in enumerate(words) if i not in dropped]))
    return out


def as_digest(doc_id, runs, kept):
    length, start, period = max(((r[1], -r[0], -r[2]) for r in runs), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), None if start is None else -start, length,
        None if period is None else -period, None if length is None else 1000 * length // -period,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


@st.composite
def repetitive(draw):
    """Sequences of repeated parts, cut and followed by others, over few or many words."""
    top, out = draw(st.sampled_from([1, 2, 3, 30])), []
    for _ in range(draw(st.integers(0, 4))):
        part = draw(st.lists(st.integers(0, top), min_size=1, max_size=9))
        out += (part * draw(st.integers(1, 9)))[draw(st.integers(0, 3)) :]
    return out


@settings(max_examples=600, deadline=None)
@given(repetitive())
def test_runs_are_those_of_the_definition(words):
    assert runs_of(np.array(words, np.int64)) == plain_runs(words)


@settings(max_examples=200, deadline=None)
@given(repetitive(), st.integers(0, 1000))
def test_chunks_do_not_matter(words, seed):
    rng, catchers, at = random.Random(seed), Catchers(), 0
    while at < len(words):
        size = rng.randint(1, 7)
        catchers.append(np.array(words[at : at + size], np.int64))
        at += size
    assert list(zip(*(x.tolist() for x in catchers.finish()), strict=True)) == plain_runs(words)


def test_every_period_at_every_offset():
    for q in range(1, 40):
        part = list(range(100, 100 + q))
        for lead in (0, 1, 2, 3, 5, 8, 13, 31):
            for extra in (0, q - 1):
                words = list(range(1000, 1000 + lead)) + part * 4 + part[:extra] + [7, 8]
                length = 4 * q + extra
                want = [(lead, length, q)] if length >= 6 else []
                assert runs_of(np.array(words)) == want


def test_periods_within_periods_and_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    nested = ([1] * 7 + [2]) * 6 + ([1, 2] * 4 + [3]) * 5
    for words in (b, nested, [1] * 500, [0, 1] * 100 + [0] * 9 + [1, 0] * 40):
        assert runs_of(np.array(words)) == plain_runs(words)


def test_squares_are_caught_while_words_are_appended():
    catchers = Catchers()
    catchers.append(np.array([9, 8, 1, 2, 3] + [1, 2, 3] * 5))
    assert any(3 in period.tolist() for _, period, _ in catchers.caught)


def test_long_repetitive_sequences_do_not_take_long():
    part = np.random.default_rng(1).integers(0, 50, 30_000)
    words = np.concatenate([np.zeros(200_000, np.int64), np.tile(part, 8), np.tile([1, 2], 90_000)])
    runs = runs_of(words)
    assert (0, 200_000, 1) in [(s, n, q) for s, n, q in runs if q == 1]
    assert any(q == 30_000 and n >= 240_000 for _, n, q in runs)
    assert any(q == 2 and n >= 180_000 for _, n, q in runs)


@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows(spark, request, which):
    docs = request.getfixturevalue(which)
    found = periodic_runs.find_runs(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = []
    for doc_id, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        runs = plain_runs(words) if len(words) < 1000 else [(0, 100_000, 5)]
        kept = words if not runs else words[:5]
        want.append((doc_id, len(words), runs, " ".join(kept)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_odd_rows_through_the_query(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect() if len(r.text or "") < 1000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(docs)))
    want = [as_digest(d, runs, kept) for d, _, runs, kept in plain_documents(rows)]
    assert sorted(repr(tuple(r)[:8]) for r in got.collect()) == sorted(map(repr, want))


def test_query_against_every_period(spark, sf_dir):
    got = queries.op11_periodic_runs(spark, sf_dir)
    columns = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect() if len((r.text or "").split()) < 2000]
    want = [as_digest(d, runs, kept) for d, _, runs, kept in plain_documents(rows)]
    ids = {d for d, _ in rows}
    found = [tuple(r) for r in got.select(*columns).collect() if r.doc_id in ids]
    assert sorted(found) == sorted(want)
    assert sum(1 for w in want if w[1]) > 5
