import random

import pytest

import corpus_pipeline as cp
from placeweave.llm import simhash
from test_decontamination import words
from test_near_duplicates import roots

CALM = ["tree", "river", "walking", "mornings", "window", "paper", "green", "slowly", "harbour", "table"] + [f"w{k}" for k in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    random.seed(4)
    path = str(tmp_path_factory.mktemp("sf"))
    text = lambda n: " ".join(random.choices(CALM, k=n))
    item = text(12)
    rows, labels = [], []
    for k in range(300):
        t = text(60)
        if k % 6 == 0:
            t = " ".join(["zorkish", "zorkly", t, "blarg"])
        rows.append((k, t))
        labels.append((k, 0, int(k % 6 == 0)))
    rows += [(1000, rows[1][1]), (1001, rows[1][1] + " extra"), (1002, "so " + item.upper() + " end " + text(50)), (1003, "mail a@b.org now " + text(50)), (1004, None), (1005, ""), (2, rows[2][1]), (None, text(40))]
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, item


def test_stages(spark, sf):
    path, rows, item = sf
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {k for k, _ in rows}
    for name, stage in cp.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = cp.written(stage(spark, docs, path), "t")
        assert docs.columns == cp.COLUMNS
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            assert after.keys() == {k for k in kept if k is None or k >= 300 or k % 6}
        if name == "near copies":
            assert docs.count() == len(after)
            fingers = {k: simhash.fingerprint(t or "") for k, t in before.items()}
            ids = [k for k in before if k is not None] + [None]
            place = {k: n for n, k in enumerate(sorted(ids[:-1]))} | {None: len(ids)}
            root = roots(place.values(), [(place[a], place[b]) for a in ids for b in ids if place[a] < place[b] and (fingers[a] ^ fingers[b]).bit_count() <= 3])
            assert after.keys() == {k for k in ids if root[place[k]] == place[k]}
        if name == "decontamination":
            wins = {tuple(words(item)[s : s + 10]) for s in range(3)}
            assert after.keys() == {k for k, t in before.items() if not wins & {tuple(words(t)[s : s + 10]) for s in range(len(words(t)))}}
            assert 1002 in before and 1002 not in after
        if name == "personal data":
            assert after.keys() == before.keys()
            assert {k for k in after if after[k] != before[k]} == {1003}
            assert after[1003].startswith("mail [EMAIL] now")


def test_run_packs_all_that_is_kept(spark, sf):
    got = cp.run(spark, sf[0]).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in x) <= 1024 for x in by.values())
    assert len({r.doc_id for r in got}) > 200


def test_empty(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf[0])
        assert docs.columns == cp.COLUMNS and docs.count() == 0
    assert cp.pack(spark, docs, sf[0]).count() == 0


def test_near_copies_keep_one_row_of_each_group_whatever_its_id(spark):
    random.seed(13)
    texts = []
    for size in [3, 5, 12, 40, 300] * 8:
        w = random.choices(CALM, k=size)
        for n in (0, 0, 1, 2):
            v = list(w)
            for _ in range(n):
                v[random.randrange(size)] = random.choice(CALM)
            texts.append(" ".join(v) if random.random() < 0.7 else " \n".join(v).upper())
    texts += [None, "", " \n", "one", "One", "one two"]
    rows = [(random.choice([None, None, 7, 7, k]), t) for k, t in enumerate(texts)]
    rows += [(None, texts[0])] * 40 + [(7, texts[1])] * 3
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], SCHEMA).repartition(5)
    got = [(r.doc_id, r.text) for r in cp.drop_near_copies(spark, docs, "").collect()]
    bits = sorted({simhash.fingerprint(t or "") for _, t in rows})
    root = roots(bits, [(a, b) for k, a in enumerate(bits) for b in bits[k + 1 :] if (a ^ b).bit_count() <= 3])
    groups = {}
    for r in rows:
        groups.setdefault(root[simhash.fingerprint(r[1] or "")], []).append(r)
    assert len(got) == len(groups) < len(texts)
    for members in groups.values():
        ids = [k for k, _ in members if k is not None]
        mine = [r for r in got if r in members]
        assert len(mine) == 1 and mine[0][0] == (min(ids) if ids else None)


def test_contaminated_rows_go_alone(spark, tmp_path):
    words = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(random.choices(words, k=n))
    item = text(12)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(k, text(30)) for k in [None, None, None, 5, 5, 6]]
    bad = [(None, "so " + item), (5, item + " end")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in clean + bad], SCHEMA)
    got = [(r.doc_id, r.text) for r in cp.drop_contaminated(spark, docs, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(clean, key=str)
