"""Linkage queries return every pair of rows, as the job they stand for does."""

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from placeweave import fixed
from placeweave.operators import linkage


def part(folder):
    rng = random.Random(5)
    names, brands, types = ["red box", "blue box", "tin of red", "Brand#1 tin", "promo"], ["Brand#1", "Brand#2", "tin"], ["PROMO", "LARGE"]
    rows = [(k, rng.choice(names), rng.choice(brands), rng.choice(types), rng.choice([5, 30])) for k in range(1, 25)]
    pd.DataFrame(rows, columns=["p_partkey", "p_name", "p_brand", "p_type", "p_size"]).astype({"p_size": "int32"}).to_parquet(f"{folder}/part.parquet")
    activities = [(f"part/{k}", n, b, f"{t} {s} {t} {b}") for k, n, b, t, s in rows]
    pages = [(f"wiki/part/{k}", n, [b, t], f"{t} {s} {n}") for k, n, b, t, s in rows]
    return activities, pages + [(f"wiki/brand/{b}", b, [b], f"All about {b}") for b in sorted({r[2] for r in rows})]


def key(text):
    return re.sub("[^a-z0-9]+", "", text.lower())


def tokens(text):
    return set(re.findall("[a-z0-9]+", text.lower()))


def by_name(activities, pages):
    return [
        (a, p, len(tokens(n) & tokens(t))) for a, n, city, _ in activities for p, t, geo, _ in pages
        if key(city) == key(geo[0]) and tokens(n) & tokens(t)
    ]


def by_texts(activities, pages):
    found = [
        (a, p, len(tokens(n) & tokens(t)), len(tokens(d) & tokens(e))) for a, n, city, d in activities for p, t, geo, e in pages
        if key(city) in {key(geo[0]), *(x for g in geo for x in tokens(g))}
    ]
    return [r for r in found if r[2] >= 1 or r[3] >= 2]


def smart(activities, pages):
    def words(text, city):
        return {t for t in re.findall(r"\w+", text.lower()) if len(t) > 1 and t not in fixed.STOP_WORDS and t != city}

    found = []
    for a, n, city, _ in activities:
        for p, t, geo, _ in pages:
            k = key(city)
            shared, near = words(n, k) & words(t, k), words(n, k) & {key(g) for g in geo}
            if k == key(geo[0]) and (shared or near or k == key(t)):
                found.append((a, p, len(shared), "landmark" if shared or near else "city_page"))
    return found


def twice(activities, pages):
    return by_texts(activities + activities + [(a, f"{n} again", c, d) for a, n, c, d in activities], pages + pages)


def primary(activities, pages):
    found = smart(activities, pages)
    best = {a: min((m != "landmark", -s, p) for b, p, s, m in found if a == b)[2] for a, *_ in found}
    return [(a, p, m, best[a] == p) for a, p, _, m in found]


V1, V2, V3 = ["overlap"], ["overlap_name", "overlap_desc"], ["overlap_score", "match_type"]
EXPECTED = {
    "link_v1": (by_name, V1),
    "link_v2": (by_texts, V2),
    "link_v2_split": (by_texts, V2),
    "link_v2_repeated": (twice, V2),
    "link_v3": (smart, V3),
    "link_v3_split": (smart, V3),
    "primary_flag": (primary, ["match_type", "is_primary"]),
    "link_wide": (by_name, V1),
}


@pytest.mark.parametrize("name", EXPECTED)
def test_every_pair_of_rows_is_returned(spark, tmp_path, name):
    brute_force, scores = EXPECTED[name]
    expected = brute_force(*part(tmp_path))
    got = QUERIES[name](spark, str(tmp_path))
    assert "kind" not in got.columns  # pairs of classes and their members before
    assert sorted(map(tuple, got.select("crawler_url", "wiki_url", *scores).collect())) == sorted(expected) and len(expected) > 50


def test_many_tasks_make_the_pairs_of_few_classes(spark, monkeypatch):
    """A class of many rows is cut, and tasks are as many as their pairs of rows ask for, however few bytes these are made of."""
    monkeypatch.setattr(linkage, "PAIRS_PER_TASK", 100)
    rows = spark.range(60).withColumn("id", F.col("id").cast("string"))
    activities = rows.selectExpr("if(id = '7', NULL, id) AS url", "'Red box' AS name", "'Rome' AS city", "'x' AS description", "array('y') AS highlights")
    pages = rows.selectExpr("'Box' AS title", "id AS url", "'x' AS type", "'x y' AS abstract", "array('Rome') AS geo_parent", "NULL AS fields")
    for made in (linkage.linked_v1(activities, pages).rows(), linkage.linked_v2(activities, pages).rows()):
        of_task = made.groupBy(F.spark_partition_id()).count().collect()
        assert len(of_task) > 8 and sum(r["count"] for r in of_task) == 3600
        assert made.select("crawler_url", "wiki_url").distinct().count() == 3600
