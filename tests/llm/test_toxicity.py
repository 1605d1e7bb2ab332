import random
import zlib

import numpy as np

from placeweave.llm import toxicity

CALM = ["tree", "river", "walking", "mornings", "window", "paper", "green", "slowly", "harbour", "table"]


def rows():
    random.seed(11)
    out = []
    for k in range(600):
        words = random.choices(CALM, k=random.randint(20, 60))
        toxic = int(k % 5 == 0)
        if toxic:
            words += random.choices(["Zorkish", "zorkly", "blarg!"], k=3)
            random.shuffle(words)
        out.append((k, " ".join(words), toxic))
    return out


def test_held_out_accuracy(spark, docs):
    data = rows()
    extra = [(None, None), (9001, ""), (9002, "zorkish " * 200_000), (9001, "")]
    labels = spark.createDataFrame([(k, y, 1) for k, _, y in data] + [(None, 1, 0), (77777, 1, 1), (3, None, 1), (4, 9, 1)], "doc_id long, toxic int, text int")
    got = toxicity.scores(docs([(k, t) for k, t, _ in data] + extra), labels).collect()
    assert len(got) == len(data) + len(extra)
    toxic = {k: y for k, _, y in data}
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert len(held) > 50
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97
    assert {r.predicted for r in got if r.doc_id == 9002} == {1}
    assert {r.predicted for r in got if r.doc_id in (9001, None)} == {0}


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    data = [(k, t) for k, t, _ in rows()] + [(1000 + k, "you stupid idiot, pathetic scum") for k in range(40)]
    got = {r.doc_id: r.score for r in toxicity.scores(docs(data), none).collect()}
    assert min(got[1000 + k] for k in range(40)) > max(s for k, s in got.items() if k < 1000)
    assert toxicity.scores(docs([]), none).count() == 0


def test_label_model_discounts_copies():
    random.seed(1)
    votes, known = {}, {}
    for k in range(4000):
        y = random.random() < 0.3
        vote = lambda good: random.random() < (good if y else 1 - good)
        a, b, c = vote(0.8), vote(0.8), vote(0.8)
        bits = [a, a, a, b, c] + [False] * 11  # two voters copy the first
        m = sum(x << j for j, x in enumerate(bits))
        votes[m] = votes.get(m, 0) + 1
        if k < 3000:
            known.setdefault(m, [0, 0])[y] += 1
    masks = np.array(sorted(votes))
    p = toxicity.label_model(masks, np.array([votes[m] for m in masks], float), np.array([known.get(m, [0, 0]) for m in masks.tolist()], float))
    by = dict(zip(masks.tolist(), p))
    assert by[0b11000] > by[0b00111]  # two that agree count more than one and its copies


def test_words_in_slices(monkeypatch):
    text = "Some words, some WORDS and séance"
    whole = toxicity.words_of(text)
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 3)
    assert toxicity.words_of(text) == whole


def test_bounded_sample(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k").repartition(9)
    got = {r.k for r in toxicity._sample(rows, 700, "k").collect()}
    assert len(got) == 700 and got == {r.k for r in toxicity._sample(rows.repartition(2), 700, "k").collect()}
    assert toxicity._sample(rows, 9000, "k").count() == 5000 and toxicity._sample(rows.limit(0), 5, "k").count() == 0


def test_labels_of_other_texts_use_up_no_room(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 500)
    data = rows()
    others = [(10**6 + k, 0) for k in range(20_000)]
    labels = spark.createDataFrame([(k, y) for k, _, y in data] + others, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.scores(docs([(k, t) for k, t, _ in data]), labels).collect()}
    assert np.mean([got[k] == y for k, _, y in data]) > 0.97


def test_f18_all_labels_and_texts_count(spark, docs, monkeypatch):
    """Before, terms came from LABELLED_ROWS rows at most; 40 of 640 texts have too few of the toxic ones."""
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 40)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 40, raising=False)
    seen = []
    monkeypatch.setattr(toxicity, "find_terms", lambda labelled, f=toxicity.find_terms: seen.append(labelled.count()) or f(labelled))
    data = rows()
    labels = spark.createDataFrame([(k, y) for k, _, y in data], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.scores(docs([(k, t) for k, t, _ in data]), labels).collect()}
    assert seen == [sum(zlib.crc32(str(k).encode()) % 5 != 0 for k, _, _ in data)]
    assert np.mean([got[k] == y for k, _, y in data]) > 0.97


def test_f18_fit_weighs_equal_texts(spark):
    """Weights are those of minimising the mean loss over all texts, equal ones counted."""
    voted = spark.createDataFrame([(1, [0])] * 30 + [(0, [1])] * 60 + [(0, [])] * 10, "mask int, found array<int>")
    w = toxicity.fit(voted, {0: 0.02, 1: 0.9}, 2)
    x = np.array([[1, 0, 1]] * 30 + [[0, 1, 1]] * 60 + [[0, 0, 1]] * 10, float)
    p = np.array([0.9] * 30 + [0.02] * 70)
    slope = x.T @ (1 / (1 + np.exp(-x @ w)) - p) / 100 + toxicity.PENALTY * np.array([w[0], w[1], 0])
    assert np.abs(slope).max() < 1e-3
    assert toxicity.fit(voted.limit(0), {}, 2).tolist() == [0, 0, 0]
