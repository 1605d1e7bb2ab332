import hashlib
import random
import re

import pytest

from placeweave.llm import decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, width):
    wins = []
    for k, t in items:
        w = words(t)
        wins += [("" if k is None else str(k), w[s : s + width]) for s in range(max(1, len(w) - width + 1)) if w]
    out = []
    for k, t in rows:
        w = words(t)
        hit, found = set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if w[s : s + len(win)] == win:
                    hit.update(range(s, s + len(win)))
                    found.add(item)
        out.append((k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("prefix_words", [20_000, 3])
def test_equals_brute_force(spark, docs, prefix_words):
    random.seed(2)
    pool = ["a", "b", "B", "c", "d1", "é", "x_y", "zz"]
    text = lambda n: random.choice([" ", "-", "__"]).join(random.choices(pool, k=n))
    items = [(k, text(random.choice([1, 2, 3, 4, 7, 9]))) for k in range(15)] + [(None, "é é d1"), (20, None), (21, ""), (22, "--"), (1, "zz zz d1"), (2, "never seen here")]
    rows = [(k, text(random.randint(0, 40))) for k in range(60)] + [(100, None), (101, ""), (102, "-- "), (103, "b c " * 500), (104, "a"), (104, "a"), (None, "zz zz d1 é"), (None, "zz")]
    rows += [(200, "q " + items[3][1] + " Q"), (201, (items[4][1] or "").upper())]
    bench = spark.createDataFrame([(*i, 3, "w") for i in items], "item_id long, text string, n int, window string")
    got = sorted(map(tuple, decontamination.contamination(docs(rows), bench, width=4, prefix_words=prefix_words).collect()), key=str)
    assert got == brute(rows, items, 4)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.contamination(docs([]), one).count() == 0
    got = decontamination.contamination(docs([(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]


def test_counts_without_ansi_rules(spark, docs):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = decontamination.contamination(docs([(1, "a b"), (2, "c"), (3, None)]), bench).orderBy("doc_id").collect()
        assert [r.n_items for r in got] == [1, 0, 0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
