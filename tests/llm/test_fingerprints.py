import hashlib

import numpy as np
import pytest

from paylake.llm import fingerprints


def ordered(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def edited(rows):
    for i, (_, text) in enumerate(rows):
        quarter = len(text) // 4
        yield text[: len(text) - quarter] + rows[(i + 1) % len(rows)][1][:quarter]


@pytest.mark.parametrize("which", ["documents", "odd", "none"])
def test_successors_and_edited_texts(request, which):
    docs = request.getfixturevalue(which)
    rows = ordered(docs)
    want = sorted(
        (str(i), len(t), hashlib.sha256(e.encode()).hexdigest())
        for (i, t), e in zip(rows, edited(rows), strict=True)
    )
    got = fingerprints.fingerprint(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want


def test_likeness_follows_resemblance(documents):
    rows = ordered(documents)
    texts = [t for _, t in rows]
    sets = fingerprints.shingle_sets(texts, fingerprints.WIDTH)
    changed = fingerprints.shingle_sets(list(edited(rows)), fingerprints.WIDTH)
    got = {r.doc_id: r for r in fingerprints.fingerprint(documents).collect()}
    errors = []
    for (i, _), a, b in zip(rows, sets, changed, strict=True):
        true = len(np.intersect1d(a, b)) / max(len(np.union1d(a, b)), 1)
        errors.append(got[i].near_edited - true)
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.25


def test_equal_texts_have_equal_fingerprints(odd):
    got = fingerprints.fingerprint(odd).collect()
    same = [r.fingerprint for r in got if r.doc_id == 6]
    assert sum(r.fingerprint == same[0] for r in got) == 4
    assert {r.doc_id for r in got if r.fingerprint == ""} == {0, 1, 2, None}
    assert {len(r.fingerprint) for r in got} == {0, fingerprints.BINS * fingerprints.BITS // 4}


def test_packed_values_come_back():
    rows = fingerprints.signatures(["a b c d e f g", "one", ""])
    first = bytes.fromhex(fingerprints.packed(rows)[0])
    values = [v for byte in first for v in (byte >> fingerprints.BITS, byte & 15)]
    assert values == rows[0].tolist()
    assert len(set(rows[1].tolist())) > 8 and fingerprints.packed(rows)[2] == ""


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(9, "a b c d e f g h")], "doc_id long, text string")
    row = fingerprints.fingerprint(docs).first()
    assert row.near_next == 1.0
    assert row.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest()
