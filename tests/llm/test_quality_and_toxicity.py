import itertools
import random
import zlib

import numpy as np
import pytest

from paylake.llm import quality, toxicity, training


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def measured(spark, sf_dir, module, label, score):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = score(docs, module.learn(docs, labels)).collect()
    truth = {r.doc_id: r[label] for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in rows)
    return [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]


def auc(rows):
    good = [s for s, _, y in rows if y == 1]
    bad = [s for s, _, y in rows if y == 0]
    wins = sum((g > b) + (g == b) / 2 for g, b in itertools.product(good, bad))
    return wins / (len(good) * len(bad))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_quality_on_held_out_rows(spark, sf):
    rows = measured(spark, f"/root/testdata/{sf}", quality, "quality", quality.score_quality)
    assert auc(rows) > 0.99
    assert np.mean([p == y for _, p, y in rows]) > 0.95
    assert all(p == (s >= 0.3) for s, p, _ in rows)


def test_toxicity_on_held_out_rows(spark):
    rows = measured(spark, "/root/testdata/sf0.1", toxicity, "toxic", toxicity.score_toxicity)
    assert auc(rows) > 0.95
    assert np.mean([p == y for _, p, y in rows]) > 0.95
    assert all(p == (s >= 0.5) for s, p, _ in rows)


def test_sample_leaves_held_out_rows_and_bad_labels_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(40)] + [(1, 0), (1, 0), (41, None), (42, 7), (None, 1), (99, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = {r.doc_id: r.label for r in training.sample(docs, labels, "quality").collect()}
    assert got == {i: i % 2 for i in range(40) if not held(i)}
    assert training.sample(docs, labels, "quality", 7).count() == 7


def kernel_by_definition(a, b):
    """Sum over pairs of equal subsequences of the product of their weights."""

    def occurrences(s):
        for at in itertools.combinations(range(len(s)), toxicity.LENGTH):
            reach = at[-1] - at[0]
            if reach < toxicity.SPAN:
                yield "".join(s[i] for i in at), toxicity.DECAY ** (reach - toxicity.LENGTH + 1)

    mine = {}
    for u, w in occurrences(a):
        mine[u] = mine.get(u, 0) + w
    return sum(mine.get(u, 0) * w for u, w in occurrences(b))


def test_kernel_is_that_of_the_definition():
    landmarks = ["idiot", "stupid", "aaa", "clown"]
    kernel = toxicity.Kernel(landmarks, 2)
    words = ["idiot", "i.d.i.o.t", "idxiot", "edition", "stupidity", "aaaa", "clo-wn", "x", "ünd"]
    some, got = kernel.similar(words)
    rows = {words[i]: row for i, row in zip(some, got, strict=True)}
    for word in words:
        for j, landmark in enumerate(landmarks):
            want = kernel_by_definition(word, landmark) / kernel_by_definition(landmark, landmark)
            want = min(want, 1) ** toxicity.POWER if want >= toxicity.FLOOR else 0.0
            mine = rows[word][j] if word in rows else 0.0
            assert mine == pytest.approx(want, abs=1e-5)


def test_gapped_insults_are_found():
    rng = random.Random(4)
    plain = ["the", "river", "runs", "past", "old", "houses", "and", "green", "fields", "today"]
    insults = ["idiot", "moron", "stupid"]

    def text(toxic):
        words = rng.choices(plain, k=30)
        if toxic:
            words[rng.randrange(30)] = rng.choice(insults)
            words[rng.randrange(30)] = rng.choice(insults)
        return " ".join(words)

    y = np.array([i % 2 for i in range(300)])
    model = toxicity.fit([text(t) for t in y], y)
    hidden = ["the old id.iot runs", "a mo-ron and a st_upid today", "you i d i o t of the river"]
    assert (model.score(hidden) >= 0.5).all()
    assert (model.score(["the river runs past", "", "green fields and houses"]) < 0.5).all()


def words_by_definition(text):
    """Words and cut words, from the rules of the module's docstring, one character at a time."""
    spoken = "".join(c for c in text.lower() if c.isalnum() or c.isspace())
    groups, gap, word = [[]], "", ""
    for c in spoken + " ":
        if c.isspace():
            gap += c
            if word:
                groups[-1].append(word)
                word = ""
        else:
            if gap not in ("", " "):
                groups.append([])
            gap, word = "", word + c
    out = []
    for group in groups:
        merged = []
        for single, run in itertools.groupby(group, lambda w: len(w) == 1):
            run = list(run)
            merged += ["".join(run)] if single and len(run) >= toxicity.LENGTH else run
        out.append([])
        for word in merged:
            if len(word) <= toxicity.LONG:
                out[-1].append(toxicity.MARK + word)
                continue
            half = toxicity.WINDOW // 2
            out[-1].append(toxicity.MARK + word[: 2 * half])
            out += [[word[i : i + 2 * half]] for i in range(half, len(word) - half, half)]
    return out


def score_by_definition(model, text):
    kernel, marks = model.kernel, model.landmarks
    closed = {m[i : i + 3] for m in marks for i in range(len(m) - 2)}
    words = []
    for group in words_by_definition(text):
        words += group
        for a, b in itertools.pairwise(group):
            tail, head = a[-2:], b[1:3]
            over = [tail + head[0]] if len(a.removeprefix(toxicity.MARK)) > 1 else []
            over += [tail[-1] + head] if len(head) == 2 else []
            if all(t in closed for t in over):
                words.append(a[-toxicity.WINDOW :] + b[1 : 1 + toxicity.WINDOW])
    best, whole = np.zeros(len(marks)), np.zeros(kernel.telling)
    for word in words:
        for j, mark in enumerate(marks):
            k = min(kernel_by_definition(word, mark) / kernel_by_definition(mark, mark), 1)
            k = k**toxicity.POWER if k >= toxicity.FLOOR else 0.0
            best[j] = max(best[j], k)
            if j < kernel.telling:
                whole[j] += k**toxicity.SHARP
    top = np.sort(best[: kernel.telling])[::-1][:2]
    top = np.pad(top, (0, 2 - len(top)))
    row = np.concatenate(
        [best @ model.root, np.log1p(whole), toxicity.SHARED * np.append(np.log1p(whole.sum()), top)]
    )
    margin = row @ model.weights + model.offset
    return 1 / (1 + np.exp(-(model.slope * margin + model.shift)))


def test_score_is_that_of_the_definition():
    insults, plain = ["idiot", "moron", "stupid"], ["the", "river", "runs", "a", "old", "houses"]
    rng = random.Random(8)

    def text(y):
        words = rng.choices(plain, k=20)
        return " ".join([*words[:10], rng.choice(insults) if y else "and", *words[10:]])

    y = np.array([i % 2 for i in range(200)])
    model = toxicity.fit([text(t) for t in y], y)
    texts = ["", " ", "an id iot runs", "i.d.i.o.t", "s tupid", "stupi d", "mo\nron", "mor  on",
             "i d i o t", "i d  i o t a b", "the, old - mo-ron.", "idxiot id iot id iot", "a b",
             "É_ß id_iot"]
    texts += [toxicity._hidden(text(i % 2), i % 3, np.random.default_rng(i)) for i in range(12)]
    texts = [" ".join(t.split(" ")[:30]) for t in texts]
    got = model.score(texts)
    assert got == pytest.approx([score_by_definition(model, t) for t in texts], abs=1e-4)


def _hiding(random_):
    def longer(change):
        return lambda text: " ".join(change(w) if len(w) > 3 else w for w in text.split())

    def put(word, signs):
        at = random_.randrange(1, len(word))
        return word[:at] + signs[random_.randrange(len(signs))] + word[at:]

    letters = "abcdefghijklmnopqrstuvwxyz"
    return {
        "as it is": (str, 0.82),
        "dots": (longer(".".join), 0.82),
        "a blank": (longer(lambda w: put(w, " ")), 0.78),
        "a sign": (longer(lambda w: put(w, ".-_*")), 0.78),
        "a letter": (longer(lambda w: put(w, letters)), 0.68),
        "spaced out": (lambda t: "   ".join(" ".join(w) for w in t.split()), 0.8),
        "spaced out, words run on": (lambda t: " ".join(" ".join(w) for w in t.split()), 0.5),
    }


def test_hidden_insults_on_held_out_rows(spark):
    """Least recall over all toxic rows, nearly half of which hold no insult at all."""
    docs, labels = (
        spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")
    )
    model = toxicity.learn(docs, labels)
    rows = [r for r in docs.join(labels, "doc_id").collect() if held(r.doc_id)]
    toxic = np.array([r.toxic == 1 for r in rows])
    for way, (hide, least) in _hiding(random.Random(6)).items():
        texts = [hide(r.text or "") for r in rows]
        said = model.score(texts) >= 0.5
        assert said[toxic].mean() >= least, way
        assert said[~toxic].mean() <= 0.03, way


def test_very_long_and_run_on_texts():
    rng = random.Random(2)
    y = np.array([i % 2 for i in range(60)])
    model = toxicity.fit([("an idiot " if t else "the river ") + str(i) for i, t in enumerate(y)], y)
    long = "".join(rng.choices("abcdefgh", k=200_000))
    texts = [long, " ".join(long), long + "idiot" + long, ". " * 50_000, "\x02 \x02idiot \x02\x02"]
    assert ((0 <= model.score(texts)) & (model.score(texts) <= 1)).all()
    assert model.score(texts[:1])[0] < 0.5 <= model.score(["you idiot"])[0]


def test_ranking_needs_both_labels():
    x = np.zeros((4, quality.N_FEATURES))
    assert quality.fit(x, np.ones(4, int)) is None
    assert quality.fit(x[:0], np.ones(0, int)) is None
    assert toxicity.fit(["a", "b"], np.zeros(2, int)) is None


def test_odd_rows(spark, odd, none, no_labels, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    for module, score in ((quality, quality.score_quality), (toxicity, toxicity.score_toxicity)):
        assert module.learn(docs, no_labels) is None
        assert module.learn(none, labels) is None
        model = module.learn(docs, labels)
        for m in (None, model):
            rows = score(odd, m).collect()
            assert len(rows) == odd.count()
            assert all(0 <= r.score <= 1 for r in rows)
            assert all(r.held_out for r in rows if r.doc_id is None)
            assert len({r.score for r in rows if r.doc_id in (0, 1)}) == 1
            assert score(none, m).count() == 0
    kept = toxicity.without_toxic(odd, toxicity.learn(docs, labels))
    assert kept.columns == odd.columns and kept.count() == odd.count()
