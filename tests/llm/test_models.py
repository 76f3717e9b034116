"""The learned operators: held-out results, unseen spellings, calibration, odd rows."""

import zlib

import numpy as np
import pytest
from conftest_llm import ODD

from skyops.llm import language_id, queries, toxicity

MIDDLE = "/root/testdata/sf0.1"


def out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def scored(spark):
    rows = queries.QUERIES["op1_toxicity"](spark, MIDDLE).collect()
    labels = {r.doc_id: r.toxic for r in queries.table(spark, MIDDLE, "labels").collect()}
    return rows, labels


def test_toxicity_on_texts_left_out(spark, scored):
    rows, labels = scored
    assert len(rows) == queries.table(spark, MIDDLE, "documents").count()
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    known = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    rank = np.argsort(np.argsort([s for s, _ in known]))
    y = np.array([v for _, v in known])
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    said = np.array([s >= 0.3 for s, _ in known])
    assert auc > 0.9 and said[y == 0].mean() < 0.05  # 330 toxic texts to learn from, in four languages


def test_a_misspelling_shares_vectors():
    texts = [f"the day was fine {k} and calm" for k in range(60)] + [f"you dreadful nitwit number {k} go" for k in range(60)]
    m = toxicity.train(texts, [0] * 60 + [1] * 60, 0.5)
    plain, odd, far = (m.of_word(w) for w in ("nitwit", "nitwitt", "zebra"))
    assert plain > odd > 10 * abs(far)


def test_toxicity_cases(spark, docs_of):
    docs = docs_of(ODD)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (1, 1), (None, 1), (77, 0), (7, None), (8, 3)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1
    assert toxicity.score(docs.where("doc_id > 99"), none).collect() == []


def test_language_on_texts_left_out(spark):
    rows = queries.QUERIES["op2_language_id"](spark, MIDDLE).collect()
    lang = {r.doc_id: r.lang for r in queries.table(spark, MIDDLE, "documents").select("doc_id", "lang").collect()}
    known = [r for r in rows if r.held_out and lang[r.doc_id] is not None and r.lang_pred != "und"]
    right = np.array([r.lang_pred == lang[r.doc_id] for r in known])
    assert len(rows) == len(lang) and all(r.held_out == out(r.doc_id) for r in rows)
    assert right.mean() > 0.97
    assert abs(np.mean([r.score for r in known]) - right.mean()) < 0.03  # calibrated


def test_language_weights_are_sparse_and_counts_exact(spark, docs_of):
    docs = docs_of([(k, t) for k, t in enumerate(["the cat sat on the mat", "el gato come pan", None, "", "the dog"])])
    found, n = language_id._document_frequencies(docs.where("text is not null"))
    want = np.zeros(language_id.BUCKETS, int)
    for t in ("the cat sat on the mat", "el gato come pan", "", "the dog"):
        want[language_id.counts_of(t)[0]] += 1
    assert n == 4 and (found == want).all()
    m = language_id.train(["the cat sat here"] * 30 + ["el gato come pan"] * 30, ["en"] * 30 + ["es"] * 30, np.ones(language_id.BUCKETS))
    assert np.count_nonzero(m.weights) < 0.01 * m.weights.size
    assert m.languages[int(m.probabilities("the cats").argmax())] == "en"


def test_language_cases(spark, docs_of):
    docs = docs_of(ODD)
    m = language_id.fit(docs)
    rows = language_id.predict(docs, m).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred, r.score > 0) == (("en", True) if any(map(str.isalpha, r.text or "")) else ("und", False))
    assert language_id.predict(docs.where("doc_id > 99"), m).collect() == []
    nothing = language_id.fit(docs.where("doc_id > 99"))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}


def test_languages_are_learned_whatever_the_ids(spark):
    """Null ids, one id for all rows, and a text that a third of the rows repeat."""
    texts = [(f"the house and the garden number {k} were very quiet", "en") for k in range(600)]
    texts += [(f"la casa y el jard\u00edn n\u00famero {k} estaban muy tranquilos", "es") for k in range(600)]
    texts += [("the same words again and again", "en")] * 600
    for i in (None, 7):
        docs = spark.createDataFrame([(i, t, x) for t, x in texts], "doc_id long, text string, lang string")
        model = language_id.fit(docs, sample=200)
        assert model.languages == ["en", "es"]
        assert [model.languages[int(model.probabilities(t).argmax())] for t in ("where the garden is", "donde el jard\u00edn")] == ["en", "es"]


def test_leader_steps_and_temperature_by_hand():
    """Each weight by the rule of follow-the-regularised-leader, one number at a time; the temperature by a fine grid."""
    rng = np.random.default_rng(0)
    lead = language_id.Leader(3, 2)
    z, n = np.zeros((3, 2)), np.zeros((3, 2))
    for _ in range(60):
        at = np.array(sorted(rng.choice(3, 2, replace=False)))
        w = lead.weights(at)
        grad = rng.normal(0, 1, (2, 2))
        for i, row in enumerate(at):
            for c in range(2):
                plain = 0.0 if abs(z[row, c]) <= language_id.L1 else -(z[row, c] - np.sign(z[row, c]) * language_id.L1) / (
                    (language_id.BETA + n[row, c] ** 0.5) / language_id.ALPHA + language_id.L2)
                assert w[i, c] == pytest.approx(plain, abs=1e-12)
                g = grad[i, c]
                z[row, c] += g - ((n[row, c] + g * g) ** 0.5 - n[row, c] ** 0.5) / language_id.ALPHA * plain
                n[row, c] += g * g
        lead.step(at, grad, w)
    odds, label = rng.normal(0, 4, (300, 3)), rng.integers(0, 3, 300)
    label[:200] = odds[:200].argmax(axis=1)
    grid = np.exp(np.linspace(-3, 3, 6001))
    loss = [-np.log(language_id._softmax(odds / t)[np.arange(300), label]).sum() for t in grid]
    assert language_id._temperature(odds, label) == pytest.approx(grid[int(np.argmin(loss))], rel=5e-3)


def test_training_step_by_hand(monkeypatch):
    """One round over two texts, word by word and weight by weight."""
    monkeypatch.setattr(toxicity, "ROUNDS", 1)
    texts, labels = ["ab cd", "cd ef gh"], [1, 0]
    got = toxicity.train(texts, labels, 0.4)
    rng = np.random.default_rng(7)
    top, vectors, seen = rng.normal(0, 1, (toxicity.WIDTH, 2)).astype(np.float32).astype(float), {}, {}
    seen_top = np.full((toxicity.WIDTH, 2), 1e-6)
    for k in rng.permutation(2):
        words, part = texts[k].split(), {}
        for w in words:
            for g in toxicity.grams(w):
                part[g] = part.get(g, 0) + 1 / len(words) / len(toxicity.grams(w))
        mean = sum(p * vectors.get(g, np.zeros(toxicity.WIDTH)) for g, p in part.items())
        odds = mean @ top + np.log(0.5)
        p = np.exp(odds) / np.exp(odds).sum()
        p[labels[k]] -= 1
        down, grad = top @ p, np.outer(mean, p)
        seen_top += grad**2
        top = top - toxicity.STEP * grad / np.sqrt(seen_top)
        for g, share in part.items():
            seen[g] = seen.get(g, 1e-12) + share**2 * (down @ down) / toxicity.WIDTH
            vectors[g] = vectors.get(g, np.zeros(toxicity.WIDTH)) * (1 - toxicity.SHRINK) - toxicity.STEP * share / np.sqrt(seen[g]) * down
    want = {g: v @ (top[:, 1] - top[:, 0]) for g, v in vectors.items()}
    assert set(np.flatnonzero(got.weights)) <= set(want)
    for g, w in want.items():
        assert got.weights[g] == pytest.approx(w, rel=2e-3, abs=1e-4)
    assert got.intercept == pytest.approx(np.log(0.4 / 0.6))


def test_one_text_of_each_labelled_id(spark):
    docs = spark.createDataFrame([(1, "bad words here")] * 50 + [(1, "a good text")] + [(k, f"a good text {k}") for k in range(2, 30)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), *((k, 0) for k in range(2, 30)), *((k, 1) for k in range(1000, 5000))], "doc_id long, toxic int")
    seen = []
    real = toxicity.train
    toxicity.train = lambda texts, labels, share, **kw: seen.append((texts, labels, share)) or real(texts, labels, share, **kw)
    try:
        toxicity.fit(docs, labels, sample=20)
    finally:
        toxicity.train = real
    texts, found, share = seen[0]
    assert sorted(found) == [0] * 20 + [1] and "a good text" in texts and share == pytest.approx(1 / 29)
