import itertools
import random

import numpy as np
import pytest

from paylake.llm import common, hyperminhash
from paylake.llm.components import components


def words(text):
    return common.ascii_words(text or "")


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    k = min(width, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, width, percent=80):
    """Component of each id by comparing all pairs of different sets."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and (x == y or 100 * len(x & y) >= percent * len(x | y)):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def result(docs, width):
    got = hyperminhash.near_duplicates(docs, width).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}


def edited(text, n, rng):
    w = text.split()
    for _ in range(n):
        at = rng.randrange(len(w))
        w[at] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("width", [2, 5])
def test_matches_all_pairs_on_planted_groups(spark, width):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for size in (3, 6, 9, 14, 25, 60, 200, 700):
        for _ in range(3):
            original = " ".join(rng.choices(vocabulary, k=size))
            variants = [original, original.upper()] + [
                edited(original, rng.randint(0, max(1, size // 14)), rng) for _ in range(6)
            ]
            # A chain: each differs a little more from the first.
            for _ in range(4):
                variants.append(edited(variants[-1], max(1, size // 40), rng))
            rng.shuffle(variants)
            for text in variants:
                rows.append((i, text))
                i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(docs, width) == brute(rows, width)


def test_matches_all_pairs_on_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents, 2) == brute(rows, 2)


def test_hot_group_without_a_common_centre(spark, monkeypatch):
    """A third of all rows in one bucket whose members are mostly not linked to each other."""
    monkeypatch.setattr(hyperminhash, "STARS", 1)
    monkeypatch.setattr(hyperminhash, "BLOCK", 16)
    rng = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(60))
    rows = []
    for i in range(150):
        own = " ".join(f"o{rng.randrange(40)}x{j}" for j in range(12))
        rows.append((i, f"{shared} {own}"))
    rows += [(150 + i, edited(rows[i][1], 1, rng)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs, 2) == brute(rows, 2)


def test_estimate_takes_collisions_out():
    rng = np.random.default_rng(1)
    for n, share in ((400, 0.8), (3000, 0.5), (50_000, 0.0)):
        errors = []
        for _ in range(20):
            common_part = rng.integers(0, 2**64, int(n * share), np.uint64)
            a, b = (
                np.unique(
                    np.concatenate(
                        [common_part, rng.integers(0, 2**64, n - len(common_part), np.uint64)]
                    )
                )
                for _ in range(2)
            )
            x, y = (hyperminhash.registers([s]) for s in (a, b))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            got = hyperminhash.estimate(x, y, np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(got - true)
        assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < hyperminhash.MARGIN


def test_registers_hold_zeros_and_mantissa():
    top = 5 << 56
    for zeros in (0, 1, 7, 30):
        value = top | (1 << (55 - zeros)) | (0b1010101010 << (45 - zeros))
        own = hyperminhash.registers([np.array([value], np.uint64)])[0]
        assert np.flatnonzero(own).tolist() == [5]
        assert own[5] == (zeros + 1) << 10 | 0b1010101010


def test_odd_rows(spark, odd, none):
    got = hyperminhash.near_duplicates(odd, 2).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 5)}
    assert [by_id[i].n_shingles for i in (0, 1, 2)] == [0, 0, 0]
    assert all(by_id[i].kept and by_id[i].component_id == i for i in (0, 1, 2, 3, 4, 7))
    assert by_id[6].component_id == 5 and not by_id[6].kept
    nulls = [r for r in got if r.doc_id is None]
    assert len(nulls) == 2 and all(r.kept and r.component_id is None for r in nulls)
    assert hyperminhash.near_duplicates(none, 2).count() == 0


def test_one_of_each(odd, none):
    left = hyperminhash.one_of_each(odd, 2)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 5, 7]
    assert ids.count(None) == 2
    assert hyperminhash.one_of_each(none, 2).count() == 0


def test_one_of_each_keeps_the_text_that_is_not_a_copy(spark):
    copy, own, third = ("one two three four", "five six seven eight", "nine ten eleven twelve")
    rows = [(3, copy), (9, copy), (9, own), (9, own), (20, own), (30, copy), (30, own), (30, third)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        left = sorted(tuple(r) for r in hyperminhash.one_of_each(docs, 2).collect())
        assert left == [(3, copy), (9, own), (30, third)]


def test_one_of_each_loses_no_unlike_text_of_an_id(spark):
    rows = [(5, f"{w} stands alone here") for w in ("alpha", "beta", "gamma", "delta")]
    rows += [(5, rows[0][1]), (6, rows[1][1]), (-(2**63), "the smallest id of all"), (2**63 - 1, rows[2][1])]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = sorted(tuple(r) for r in hyperminhash.one_of_each(docs, 4).collect())
        assert got == sorted([*rows[:4], rows[6]])


def test_near_copies_under_a_repeated_id_go_to_the_smaller_id(spark):
    rng = random.Random(4)
    long = " ".join(f"w{i}" for i in range(80))
    near = edited(long, 1, rng)
    rows = [(7, "something else entirely here"), (7, near), (3, long), (7, "a third text of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in hyperminhash.one_of_each(docs, 2).collect())
    assert got == sorted([rows[0], rows[2], rows[3]])


def test_no_link_of_small_sets_is_lost(spark):
    """Pairs of 4 shingles of 5, and of 5 of 6."""
    rng, rows = random.Random(9), []
    for i in range(4000):
        n = 5 if i % 2 else 6
        w = [f"x{rng.randrange(10**9)}" for _ in range(n)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w, f"y{i}"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(docs, 2).collect()}
    lost = [i for i in range(4000) if got[2 * i + 1] != 2 * i]
    assert not lost


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 160)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    rng.shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    assert {r.node: r.component for r in got} == {i: root(i) for i in parent if root(i) != i}
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, "test-none").count() == 0
