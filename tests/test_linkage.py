import random
import re

import pytest
from pyspark.sql import functions as F

from placeweave.operators import inverted, linkage, order, places, profile, search_docs, shared, skew
from placeweave.plans import enrich
from placeweave.sources.schemas import WIKI_FIELDS

PAGE = f"title string, url string, type string, abstract string, geo_parent array<string>, fields {WIKI_FIELDS}"
ACTIVITY = "url string, name string, city string, description string, highlights array<string>"


def world(spark):
    pages = spark.createDataFrame(
        [
            ("Sagrada Família", "w1", "landmark", "A large basilica", ["Barcelona", "Spain"], (None, None, None, None, "Gaudí", "", None)),
            ("Barcelona", "w2", "city", "A city", ["Barcelona"], None),
            ("Louvre", "w3", "museum", "Art in Paris", ["Paris"], None),
            ("Belém Tower", "w4", "landmark", "x", ["Lisbon", "Belem"], None),
            ("Nowhere", "w5", "place", "x", None, None),
            ("Empty", "w6", "place", "x", [], None),
        ],
        PAGE,
    )
    activities = spark.createDataFrame(
        [
            ("a1", "Sagrada Família tour", "Barcelona", None, None),
            ("a2", "Walking tour", "Barcelona", None, None),
            ("a3", "Art lovers in Paris", None, "art of paris", ["large art"]),
            ("a4", "belem by boat", "Lisbon", None, None),
            ("a5", "Lost", " ", None, None),
        ],
        ACTIVITY,
    )
    return activities, pages


def test_smart_link_and_best_match(spark):
    activities, pages = world(spark)
    dictionary = spark.createDataFrame([(0, "from paris"), (1, "paris"), (2, "art")], "pos int, phrase string")
    pairs = enrich.link(activities, pages, None, dictionary)
    got = {(r.crawler_url, r.wiki_url): (r.match_type, r.overlap_score) for r in pairs.collect()}
    assert got == {
        ("a1", "w1"): ("landmark", 2), ("a1", "w2"): ("city_page", 0), ("a2", "w2"): ("city_page", 0),
        ("a4", "w4"): ("landmark", 0),  # only the geo parent is shared
    }
    best = {r.crawler_url: r.wiki_url for r in linkage.best_match(pairs).collect()}
    assert best == {"a1": "w1", "a2": "w2", "a4": "w4"}
    enriched = {r.url: r for r in enrich.enrich(activities, pairs, pages).collect()}
    assert len(enriched) == 5 and enriched["a3"].matches is None
    assert [m.wiki_title for m in enriched["a1"].matches] == ["Sagrada Família", "Barcelona"]
    assert enriched["a1"].primary_match.wiki_architect == "Gaudí" and enriched["a1"].first_city == "Barcelona"
    stats = profile.link_stats(pairs).first()
    assert (stats.n_pairs, stats.n_landmark, stats.n_city_page, stats.n_activities, stats.n_pages) == (4, 2, 2, 3, 3)


def test_results_do_not_depend_on_partitions(spark):
    activities, pages = world(spark)
    results = [
        sorted(map(str, linkage.link_v3(activities.repartition(n), pages.repartition(n), rows_per_slice=s).collect()))
        for n, s in ((1, 1), (8, 1), (3, 1000))
    ]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("seed", range(3))
def test_classes_stand_for_all_their_rows(spark, seed):
    rng = random.Random(seed)
    words = ["tour", "castle", "garden", "rome", "art", "the"]
    names = [" ".join(rng.choices(words, k=k % 4)) for k in range(12)] + [None]
    cities = ["Rome", "rome!", "Art", "", None]
    urls = [*"abcdefgh", None]
    activities = spark.createDataFrame([(rng.choice(urls), rng.choice(names), rng.choice(cities), None, None) for _ in range(60)], ACTIVITY)
    geo = [["Rome"], ["Rome", "castle"], ["Art", "Rome", None], [], None]
    titles = [*names, "Rome", "Art"]
    pages = spark.createDataFrame([(rng.choice(titles), rng.choice(urls), "x", None, rng.choice(geo), None) for _ in range(60)], PAGE)
    rows = linkage.link_v3(activities, pages)
    assert rows.count() > 20
    linked = linkage.linked_v3(activities, pages)
    assert sorted(map(str, linkage.best_of_classes(linked).collect())) == sorted(map(str, linkage.best_match(rows).collect()))
    assert profile.class_link_stats(linked).first() == profile.link_stats(rows).first()
    best = {r.crawler_url: r.wiki_url for r in linkage.best_match(rows).collect()}
    flags = linkage.flag_primary(linked).collect()
    assert len(flags) == rows.count() and all(r.is_primary == (best[r.crawler_url] == r.wiki_url) for r in flags)
    nothing = linkage.linked_v3(activities.limit(0), pages)
    assert linkage.best_of_classes(nothing).count() == 0 and profile.class_link_stats(nothing).first().n_pairs == 0


def test_place_backfill(spark):
    phrases = ["new_york", "from hanoi", "hanoi", "✅ oslo", "bar", "a.c", "kraków", "pass®"]
    names = {
        "From Hanoi to the sea": "from hanoi", "Hanoi, from afar": "hanoi", "Barcelona": None, "A bar crawl": "bar", "new york": None,
        "abc": None, "see a.c here": "a.c", "✅ Oslo": None, "x✅ Oslo!": "✅ oslo", "in Kraków": "kraków", "pass® x": None, "pass®x": "pass®", None: None,
    }
    dictionary = spark.createDataFrame(list(enumerate(phrases)), "pos int, phrase string")
    rows = [(f"u{i}", n, None) for i, n in enumerate(names)] + [("given", "From Hanoi", "ROME")]
    activities = spark.createDataFrame(rows, "url string, name string, city string")
    got = {r["url"]: r["city"] for r in places.backfill_city(activities, dictionary).collect()}
    assert got == {f"u{i}": c for i, c in enumerate(names.values())} | {"given": "rome"}
    empty = spark.createDataFrame([], "pos int, phrase string")
    assert places.with_place(activities, empty).count() == 1


def test_only_first_and_second_geo_parent_profiles(spark):
    _, pages = world(spark)
    row = profile.page_profile(pages, geo_index=1).first()
    assert (row.n_rows, row.geo_null, row.geo_not_null, row.key_empty) == (6, 1, 5, 4)


@pytest.mark.parametrize("rows,pairs", [(1000, 50), (3, 10**9), (7, 5), (1, 1)])
def test_keys_are_cut_by_their_pairs(spark, rows, pairs):
    left = spark.createDataFrame([(k, i) for k, n in (("a", 40), ("b", 1), ("c", 5), ("d", 3), (None, 2)) for i in range(n)], "k string, x int")
    right = spark.createDataFrame([(k, i) for k, n in (("a", 2), ("b", 30), ("c", 5), ("e", 3), (None, 2)) for i in range(n)], "k string, y int")
    cut = {r.k: (r._ln, r._rn) for r in skew.hot_pairs(left, right, ["k"], rows, pairs).collect()}
    for k, n, m in (("a", 40, 2), ("b", 1, 30), ("c", 5, 5)):
        a, b = cut.get(k, (1, 1))
        side = max(1, -(-n // a)), max(1, -(-m // b))
        assert max(side) <= rows and side[0] * side[1] <= max(pairs, 1) * 2
    got = sorted(map(tuple, skew.split_hot_join(left, right, ["k"], ["x"], ["y"], rows, pairs_per_slice=pairs).collect()))
    assert got == sorted(map(tuple, left.join(right, "k").collect())) and len(got) == 40 * 2 + 30 + 25


@pytest.fixture
def spread(spark):
    """Without joining small partitions, so that small tables lie in many."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_numbers_by_order(spark, spread):
    rng = random.Random(3)
    rows = [(rng.choice("aaaab") if rng.random() < 0.9 else None, rng.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = sorted(map(tuple, order.numbered(df, [F.desc("x")], "n").collect()), key=lambda r: r[2])
    assert [r[2] for r in got] == list(range(300)) and [r[1] for r in got] == sorted((x for _, x in rows), reverse=True)
    by = {}
    for g, x, k in order.ranked(df, "g", ["x"], "k").collect():
        by.setdefault(g, []).append((k, x))
    for g, found in by.items():
        assert sorted(found) == list(enumerate(sorted(x for h, x in rows if h == g), 1))
    assert sum(map(len, by.values())) == 300
    assert order.numbered(df.limit(0), ["x"], "n").count() == 0 and order.ranked(df.limit(0), "g", ["x"], "k").count() == 0


RAW = "url string, title string, name string, city string, description string, highlights array<string>, featured_reviews array<string>, rating string, reviewCount string"


def raw_activities(spark, names):
    return spark.createDataFrame([(u, None, n, "Barcelona", "words", ["more words"], None, "4", "10") for u, n in names], RAW)


def test_documents_keep_their_numbers(spark, spread):
    first = raw_activities(spark, [("u3", "a"), ("u1", "b"), ("u1", "b"), ("u1", "c"), (None, "d")])
    numbers = search_docs.document_numbers(first)
    one = {(r.url, r.digest): r.doc_id for r in numbers.collect()}
    assert sorted(one.values()) == [0, 1, 2, 3]
    assert {(r.url, r.digest): r.doc_id for r in search_docs.document_numbers(first.repartition(5)).collect()} == one
    more = first.where("name <> 'a'").unionByName(raw_activities(spark, [("u0", "new"), ("u3", "changed")]))
    two = {(r.url, r.digest): r.doc_id for r in search_docs.document_numbers(more, numbers).collect()}
    assert all(two[k] == n for k, n in one.items()) and sorted(two.values()) == [0, 1, 2, 3, 4, 5]
    assert search_docs.document_numbers(first.limit(0)).count() == 0


def test_texts_of_pages_in_pieces(spark, spread):
    activities = raw_activities(spark, [("a1", "Sagrada Família tour"), ("a2", "Walking tour"), ("a3", "Nothing")])
    details = spark.createDataFrame(
        [("a1", f"w{k}", "landmark" if k % 2 else "city_page", k % 3, f"t{k}", "city" if k == 4 else "museum", f"text {k} text" if k != 3 else "", "" if k < 4 else f"arch {k}", "") for k in range(40)]
        + [("a2", "w1", "landmark", 1, "t1", "museum", "Other text", None, "style")],
        "crawler_url string, wiki_url string, match_type string, overlap_score int, wiki_title string, wiki_type string, wiki_abstract string, wiki_architect string, wiki_style string",
    )
    matches = linkage.ranked_matches(details)
    nested = activities.join(linkage.nest_matches(matches), "url", "left").withColumn("matches", F.coalesce("matches", F.array().cast("array<struct<wiki_title:string,wiki_type:string,wiki_abstract:string,wiki_architect:string,wiki_style:string>>")))
    assert {r.url: len(r.matches) for r in nested.collect()} == {"a1": 40, "a2": 1, "a3": 0}
    numbers = search_docs.document_numbers(activities)
    documents, pieces = search_docs.linked_documents(activities, matches, numbers)
    whole = search_docs.search_documents(nested.join(numbers.select("url", "doc_id"), "url"))
    assert sorted(map(str, documents.collect())) == sorted(map(str, whole.drop("wiki_text").collect()))
    both = ["title", "wiki_text"]
    a, b = inverted.in_memory_index(documents, both, pieces=pieces), inverted.in_memory_index(whole, both)
    for table in ("postings", "term_stats", "field_stats"):
        assert sorted(map(str, getattr(a, table).select(*getattr(b, table).columns).collect())) == sorted(map(str, getattr(b, table).collect()))
    assert linkage.nest_matches(matches.limit(0)).count() == 0


def tokens_of(text):
    return set(re.findall("[a-z0-9]+", (text or "").lower()))


def random_rows(spark, seed):
    rng = random.Random(seed)
    words = ["tour", "castle", "garden", "rome", "art", "x"]
    text = lambda: rng.choice([None, "", *(" ".join(rng.choices(words, k=k)) for k in (1, 2, 3))])
    a = [(rng.choice([*"abcdef", None]), text(), rng.choice(["Rome", "rome!", "Art", "", None]), text(), rng.choice([None, ["art"]])) for _ in range(150)]
    geo = [["Rome"], ["Old Rome", "art"], ["Art", None], [], None]
    p = [(text(), rng.choice([*"uvwxyz", None]), "x", text(), rng.choice(geo), None) for _ in range(150)]
    return a, p, spark.createDataFrame(a, ACTIVITY), spark.createDataFrame(p, PAGE)


@pytest.mark.parametrize("seed", range(2))
def test_one_table_holds_the_links_of_all_rows(spark, seed):
    a, p, activities, pages = random_rows(spark, seed)
    key = lambda c: re.sub("[^a-z0-9]+", "", (c or "").lower())
    one, two = [], []
    for url, name, city, description, highlights in a:
        for title, page, _, abstract, geo, _ in p:
            own = key((geo or [""])[0])
            near = {own} | {t for g in (geo or [])[:2] for t in tokens_of(g)}
            names = len(tokens_of(name) & tokens_of(title))
            texts = len(tokens_of(" ".join([description or "", *(highlights or [])])) & tokens_of(abstract))
            if city is not None and key(city) == own and names:
                one.append((url, page, names))
            if city is not None and key(city) in near and (names or texts >= 2):
                two.append((url, page, names, texts))

    def listed(rows):
        return sorted(map(str, map(tuple, rows)))

    of = {k: linkage.linked_v1(activities, pages).table().where(F.col("kind") == k) for k in ("pair", "activity", "page")}
    joined = of["pair"].select("c", "w", "overlap").join(of["activity"].select("c", "crawler_url"), "c").join(of["page"].select("w", "wiki_url"), "w")
    assert one and listed(joined.select("crawler_url", "wiki_url", "overlap").collect()) == listed(one)
    assert listed(linkage.link_v1(activities, pages).select("crawler_url", "wiki_url", "overlap").collect()) == listed(one)
    assert listed(linkage.link_v2(activities, pages).select("crawler_url", "wiki_url", "overlap_name", "overlap_desc").collect()) == listed(two)
    members = {k: linkage.linked_v2(activities, pages).table().where(F.col("kind") == k) for k in ("names", "texts", "activity", "page")}
    assert members["activity"].count() == sum(r[2] is not None for r in a) and members["page"].count() == len(p)


def test_copies_are_members_and_not_pairs(spark):
    activities, pages = world(spark)
    many = spark.range(100).select(F.col("id").cast("string").alias("copy"))
    a = activities.crossJoin(many).withColumn("url", F.concat("url", "copy")).drop("copy")
    w = pages.crossJoin(many).withColumn("url", F.concat("url", "copy")).drop("copy")
    for found, once in ((linkage.linked_v1(a, w), linkage.linked_v1(activities, pages)), (linkage.linked_v3(a, w), linkage.linked_v3(activities, pages))):
        assert found.pairs.count() == once.pairs.count() and found.table().count() <= 100 * once.table().count()
        assert found.rows().count() == 100 * 100 * once.rows().count()
    owners = linkage.activity_groups(linkage.linked_v3(a, w))[1]
    assert owners.select("group").distinct().count() == linkage.activity_groups(linkage.linked_v3(activities, pages))[1].select("group").distinct().count()


@pytest.mark.parametrize("seed", range(2))
def test_groups_have_the_matches_of_their_activities(spark, seed):
    _, _, activities, pages = random_rows(spark, seed)
    pages = pages.where("url IS NOT NULL")
    linked = linkage.linked_v3(activities.where("url IS NOT NULL"), pages)
    pairs, owners = linkage.activity_groups(linked)
    rows = linked.rows()
    assert rows.count() > 10
    mine = linkage.of_activities(pairs.select("crawler_url", "wiki_url", "match_type", "overlap_score"), owners)
    assert sorted(map(tuple, mine.select("crawler_url", "wiki_url", "match_type", "overlap_score").collect())) == sorted(
        map(tuple, rows.select("crawler_url", "wiki_url", "match_type", "overlap_score").collect())
    )
    assert sorted(linkage.of_activities(linkage.best_match(pairs), owners).select("crawler_url", "wiki_url").collect()) == sorted(
        linkage.best_match(rows).select("crawler_url", "wiki_url").collect()
    )


def test_texts_of_groups_are_those_of_their_documents(spark, spread):
    activities = raw_activities(spark, [("a1", "Sagrada tour"), ("a2", "Sagrada tour"), ("a3", "Nothing"), ("a4", "Walk"), ("a4", "Walk on")])
    owners = spark.createDataFrame([("a1", "g"), ("a2", "g"), ("a4", "h")], "crawler_url string, group string")
    kinds = "crawler_url string, wiki_url string, match_type string, overlap_score int, wiki_title string, wiki_type string, wiki_abstract string, wiki_architect string, wiki_style string"
    details = spark.createDataFrame(
        [("g", f"w{k}", "landmark", k % 3, f"t{k}", "city" if k == 4 else "museum", f"text {k} text" if k != 3 else "", f"arch {k}", "") for k in range(9)]
        + [("h", "w1", "landmark", 1, "t1", "museum", "?", None, "style")], kinds,
    )
    numbers = search_docs.document_numbers(activities)
    grouped = search_docs.grouped_documents(activities, linkage.ranked_matches(details), owners, numbers)
    whole = search_docs.linked_documents(activities, linkage.ranked_matches(linkage.of_activities(details, owners)), numbers)
    assert sorted(map(str, grouped[0].collect())) == sorted(map(str, whole[0].collect()))
    assert grouped[1].count() == 9 and whole[1].count() == 18
    both = ["title", "wiki_text"]
    a = inverted.in_memory_index(grouped[0], both, pieces=grouped[1], holders=grouped[2])
    b = inverted.in_memory_index(whole[0], both, pieces=whole[1])
    for table in ("postings", "term_stats", "field_stats"):
        assert sorted(map(str, getattr(a, table).select(*getattr(b, table).columns).collect())) == sorted(map(str, getattr(b, table).collect()))


@pytest.mark.parametrize("seed, cells, rows", [(0, 7, 3), (1, 1 << 20, 1000), (2, 50, 1)])
def test_pairs_in_place_against_brute_force(spark, monkeypatch, seed, cells, rows):
    rng = random.Random(seed)
    monkeypatch.setattr(shared, "CELLS", cells)
    words = "abcdefghijkl"

    def side(n):
        return [(f"i{k}", rng.choice(["", "x", "y", "z"]), k, sorted(set(rng.choices(words, k=rng.choice([0, 1, 3, 5]))))) for k in range(n)]

    left = side(40)
    right = [(*r, rng.choice([None, [], rng.choices(words, k=2)]), rng.random() < 0.1) for r in side(50)]
    expected = sorted(
        (a[0], b[0], a[2], b[2], len({*a[3]} & {*b[3]}), bool({*a[3]} & {*b[3], *(b[4] or [])}))
        for a in left for b in right if a[1] == b[1] and (b[5] or {*a[3]} & {*b[3], *(b[4] or [])})
    )
    l = spark.createDataFrame(left, "id string, place string, n long, tokens array<string>")
    r = spark.createDataFrame(right, "id string, place string, n long, tokens array<string>, also array<string>, every boolean")
    assert sorted(map(tuple, shared.pairs_in_place(l, r, rows).collect())) == expected


def test_f2_f5_pairs_are_not_shuffled_and_low_limits_make_few_copies(spark):
    activities, pages = world(spark)
    both = linkage.linked_v2(activities, pages, rows_per_slice=1)
    for pairs in (both.names, both.texts, linkage.linked_v3(activities, pages).pairs):
        above = pairs._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")
        assert len(above) == 2 and "Join" not in above[0] and "Aggregate" not in above[0]
    rows = spark.range(2000).selectExpr("cast(id as string) as id", "'x' as place", "1L as n", "array('t') as tokens")
    cut = shared._sliced(rows, rows, 1).first()
    assert max(cut._ln, cut._rn) <= shared.SLICES  # one slice for each row before
