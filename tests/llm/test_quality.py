import random
import zlib

import numpy as np
import pytest

from placeweave.llm import quality

WORDS = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]


def some_rows(n=900):
    random.seed(12)
    out = []
    for k in range(n):
        text = " ".join(random.choices(WORDS, k=random.randint(20, 80)))
        kind = k % 9
        if kind == 0:
            text = " ".join(w + random.choice(["###", "%%%"]) for w in text.split())
        elif kind == 1:
            text = " ".join(f"{w} {w} {w}" for w in text.split()[:20])
        elif kind == 2:
            text = text.upper() + "!!"
        out.append((k, text + ".", int(kind > 2)))
    return out


def labels_of(spark, data):
    more = [(None, 1, 0), (10**9, 0, 1), (3, None, 1), (4, 9, 1)]  # null and unknown keys, labels that are none
    return spark.createDataFrame([(k, y, 5) for k, _, y in data] + more, "doc_id long, quality int, text int")


def test_held_out_accuracy(spark, docs):
    data = some_rows()
    more = [(None, None), (None, "ban ban ban"), (9001, ""), (9002, None), (9003, "ban der fis " * 200_000), (9004, "x" * 2_000_000), (5, data[5][1])]
    got = quality.scores(docs([(k, t) for k, t, _ in data] + more), labels_of(spark, data)).collect()
    assert len(got) == len(data) + len(more)
    truth = {k: y for k, _, y in data}
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert len({r.score for r in got if r.doc_id in (9001, 9002)}) == 1
    assert len({r.score for r in got if r.doc_id == 5}) == 1


def test_held_out_labels_are_not_learned(spark, docs):
    data = some_rows(300)
    other = [(k, t, 1 - y if zlib.crc32(str(k).encode()) % 3 == 1 else y) for k, t, y in data]
    texts = docs([(k, t) for k, t, _ in data])
    a, b = ({r.doc_id: r.score for r in quality.scores(texts, labels_of(spark, x)).collect()} for x in (data, other))
    assert a == pytest.approx(b)


def test_more_labels_than_the_bound(spark, docs):
    data = some_rows(600)
    table = docs([(k, t) for k, t, _ in data] + [(k, data[7][1]) for k in range(3000, 3100)] + [(7, data[7][1])] * 50)
    rows = table.select("doc_id", "text")
    known = quality.labelled(rows, labels_of(spark, data), "doc_id", "text", "quality", 100).collect()
    assert len(known) == 100
    assert 5 < sum(r.back for r in known) < 45
    got = quality.scores(table, labels_of(spark, data), fit_rows=100).collect()
    assert len(got) == 750 and len({r.score for r in got if r.doc_id == 7 or 3000 <= (r.doc_id or 0) < 3100}) == 1


def test_without_labels_of_both_kinds(spark, docs):
    texts = docs([(1, "a b"), (2, None), (None, "c")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scores(texts, none).collect()} == {0.5}
    ones = spark.createDataFrame([(k, 1) for k in range(3)], "doc_id long, quality int")
    assert {r.predicted for r in quality.scores(texts, ones).collect()} == {1}
    assert quality.scores(docs([]), ones).count() == 0


def test_marks():
    reader = quality.Marks()
    assert reader.of("").tolist() == []
    marks = reader.of("one one ONE two\none one ONE two\n...").tolist()
    b = reader.bucket
    assert marks[:4] == [b("one"), quality.AGAIN, quality.CAPITALS, b("two")]
    assert marks[5:9] == [quality.LINE_AGAIN] * 4 and marks[-1] == b("...")


def test_slices_end_between_words(monkeypatch):
    text = "some words and some more words " * 30
    whole = quality.Marks().of(text)
    monkeypatch.setattr(quality, "SLICE_CHARS", 7)
    assert quality.Marks().of(text).tolist() == whole.tolist()


def test_contexts_are_sums_over_all_texts(spark):
    random.seed(1)
    texts = [" ".join(random.choices(WORDS[:12], k=random.randint(0, 9))) for _ in range(40)]
    places, signs = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.SIZE), np.int64)
    for t in texts:
        marks = quality.Marks().of(t).tolist()
        for i, a in enumerate(marks):
            for j in range(max(0, i - quality.WINDOW), min(len(marks), i + quality.WINDOW + 1)):
                if i != j:
                    want[a, places[marks[j]]] += signs
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    assert (quality.contexts(table) == want).all()


def test_temperature_lowers_overconfidence():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, quality.SIZE))
    y = (x[:, 0] + rng.normal(size=2000) * 2 > 0).astype(float)
    net = quality.fit(x[:300], y[:300])
    better = quality.calibrated(net, x[300:1000], y[300:1000])
    loss = lambda n: -np.mean(np.log(np.where(y[1000:] > 0, n.scores(x[1000:]), 1 - n.scores(x[1000:])) + 1e-12))
    assert better.temperature > 1 and loss(better) < loss(net)
