from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import ACTIVITIES_SQL, WIKI_SQL, activities, table, texts, wiki_pages
from checks.registry import query
from placeweave import fixed
from placeweave.functions import text as T
from placeweave.operators import linkage, places, profile
from placeweave.plans import enrich

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in fixed.STOP_WORDS) + "]"


def split_sql(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{Nd}}]+')"


def ascii_sql(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"


def unicode_sql(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{Nd}}]+', '', 'g')"


def filtered_sql(c: str, city: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+'), "
        f"lambda t: length(t) > 1 AND NOT list_contains({STOP_SQL}, t) AND t <> {city})"
    )


# ---- keys and tokens over whole texts


@query(f"SELECT doc_id, md5({ascii_sql('text')}) AS key FROM documents")
def key_ascii(spark, sf):
    return texts(spark, sf).select("doc_id", F.md5(T.ascii_key(F.col("text"))).alias("key"))


@query(f"SELECT doc_id, md5({unicode_sql('text')}) AS key FROM documents")
def key_unicode(spark, sf):
    return texts(spark, sf).select("doc_id", F.md5(T.unicode_key(F.col("text"))).alias("key"))


@query(
    f"""SELECT doc_id, length({split_sql('text')})::INT AS n_tokens,
        md5(array_to_string({split_sql('text')}, ' ')) AS tokens FROM documents"""
)
def tokens_split(spark, sf):
    tokens = texts(spark, sf).select("doc_id", T.split_tokens(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query(
    f"""WITH t AS (SELECT doc_id, {filtered_sql("concat(text, ' ', source)", 'source')} AS t FROM documents)
    SELECT doc_id, length(t)::INT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens FROM t"""
)
def tokens_filtered(spark, sf):
    both = T.description_text(F.col("text"), F.array("source"))
    tokens = texts(spark, sf).select("doc_id", T.filtered_tokens(both, F.col("source")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query(
    f"""WITH {WIKI_SQL}
    SELECT url, {unicode_sql('title')} AS title_key, {ascii_sql("coalesce(geo_parent[1], '')")} AS city_key,
      array_to_string(list_transform(geo_parent, lambda x: {ascii_sql('x')}), ' ') AS geo_tokens,
      array_to_string(list_sort(list_distinct(list_concat(
        {split_sql("coalesce(geo_parent[1], '')")}, {split_sql("coalesce(geo_parent[2], '')")}))), ' ') AS candidates
    FROM wiki"""
)
def wiki_keys(spark, sf):
    geo = F.col("geo_parent")
    return wiki_pages(spark, sf).select(
        "url",
        T.unicode_key(F.col("title")).alias("title_key"),
        T.ascii_key(T.geo_parent_at(geo)).alias("city_key"),
        F.array_join(T.ascii_keys(geo), " ").alias("geo_tokens"),
        F.array_join(F.array_sort(T.candidate_keys(geo)), " ").alias("candidates"),
    )


# ---- place backfill

DICTIONARY_SQL = """
phrases AS (SELECT DISTINCT p_name AS phrase FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 2) FROM part
            UNION SELECT DISTINCT p_type FROM part),
dictionary AS (SELECT concat('0x', substr(md5(phrase), 1, 7))::INT AS pos, phrase FROM phrases),
named AS (
  SELECT p_partkey, concat('part/', p_partkey) AS url, concat('Best ', upper(p_name), ' of ', p_brand) AS name,
         CASE p_type WHEN 'PROMO' THEN p_brand WHEN 'LARGE' THEN ' ' END AS city FROM part)"""


def dictionary(spark, sf):
    part = table(spark, sf, "part")
    phrases = (
        part.select(F.col("p_name").alias("phrase"))
        .union(part.select(F.split_part("p_name", F.lit(" "), F.lit(2))))
        .union(part.select("p_type"))
        .distinct()
    )
    # Any order will do as long as SQL has the same.
    return phrases.select(F.conv(F.substring(F.md5("phrase"), 1, 7), 16, 10).cast("int").alias("pos"), "phrase")


def named(spark, sf):
    return table(spark, sf, "part").select(
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url"),
        F.concat(F.lit("Best "), F.upper("p_name"), F.lit(" of "), "p_brand").alias("name"),
        F.when(F.col("p_type") == "PROMO", F.col("p_brand")).when(F.col("p_type") == "LARGE", " ").alias("city"),
    )


BACKFILL_SQL = f"""WITH {DICTIONARY_SQL},
found AS (
  SELECT n.url, arg_min(d.phrase, d.pos) AS city FROM named n JOIN dictionary d
  ON regexp_matches(lower(n.name), concat('\\b', d.phrase, '\\b')) WHERE trim(coalesce(n.city, '')) = '' GROUP BY n.url)
SELECT n.url, n.name, CASE WHEN trim(coalesce(n.city, '')) <> '' THEN lower(n.city) ELSE f.city END AS city
FROM named n LEFT JOIN found f USING (url)"""


@query(BACKFILL_SQL)
def dict_backfill(spark, sf):
    return places.backfill_city(named(spark, sf), dictionary(spark, sf))


@query(BACKFILL_SQL)
def dict_backfill_split(spark, sf):
    """The same with every name frequent enough to be split."""
    return places.backfill_city(named(spark, sf), dictionary(spark, sf), rows_per_slice=3)


# ---- linkage

# Every pair of rows is returned, and these grow with the square of the table.

V1_SQL = f"""WITH {ACTIVITIES_SQL}, {WIKI_SQL},
c AS (SELECT *, {ascii_sql('city')} AS k, {split_sql('name')} AS t FROM activities),
w AS (SELECT *, {ascii_sql("coalesce(geo_parent[1], '')")} AS k, {split_sql('title')} AS t FROM wiki)
SELECT c.url AS crawler_url, c.name AS crawler_name, c.city, w.title AS wiki_title, w.url AS wiki_url,
       w.type AS wiki_type, length(list_intersect(c.t, w.t))::INT AS overlap
FROM c JOIN w ON c.k = w.k WHERE length(list_intersect(c.t, w.t)) > 0"""


@query(V1_SQL)
def link_v1(spark, sf):
    return linkage.link_v1(activities(spark, sf), wiki_pages(spark, sf))


V2_SQL = f"""WITH {ACTIVITIES_SQL}, {WIKI_SQL},
c AS (SELECT *, {ascii_sql('city')} AS k, {split_sql('name')} AS t,
      {split_sql("concat_ws(' ', description, array_to_string(highlights, ' '))")} AS d FROM activities),
w AS (SELECT *, {ascii_sql("coalesce(geo_parent[1], '')")} AS k,
      list_concat({split_sql("coalesce(geo_parent[1], '')")}, {split_sql("coalesce(geo_parent[2], '')")}) AS ks,
      {split_sql('title')} AS t, {split_sql('abstract')} AS d FROM wiki),
pairs AS (SELECT c.url AS crawler_url, c.name AS crawler_name, c.city, w.title AS wiki_title, w.url AS wiki_url,
       w.type AS wiki_type, length(list_intersect(c.t, w.t))::INT AS overlap_name,
       length(list_intersect(c.d, w.d))::INT AS overlap_desc
FROM c JOIN w ON c.k = w.k OR list_contains(w.ks, c.k))
SELECT * FROM pairs WHERE overlap_name >= 1 OR overlap_desc >= 2"""


@query(V2_SQL)
def link_v2(spark, sf):
    return linkage.link_v2(activities(spark, sf), wiki_pages(spark, sf))


@query(V2_SQL)
def link_v2_split(spark, sf):
    return linkage.link_v2(activities(spark, sf), wiki_pages(spark, sf), rows_per_slice=7)


# Every row twice, once more with another name or title: a url stands for three rows.
TWICE_SQL = (
    ", activities3 AS (SELECT * FROM activities UNION ALL SELECT * FROM activities"
    " UNION ALL SELECT url, concat(name, ' again'), city, description, highlights FROM activities),"
    " wiki2 AS (SELECT * FROM wiki UNION ALL SELECT * FROM wiki)"
)


def repeated(spark, sf):
    a, w = activities(spark, sf), wiki_pages(spark, sf)
    again = a.withColumn("name", F.concat("name", F.lit(" again")))
    return a.unionByName(a).unionByName(again), w.unionByName(w)


def repeated_sql(sql: str) -> str:
    """The same SQL over the repeated rows."""
    sql = sql.replace(WIKI_SQL, WIKI_SQL + TWICE_SQL, 1)
    return sql.replace("AS k FROM activities)", "AS k FROM activities3)").replace("AS d FROM activities)", "AS d FROM activities3)").replace(
        "AS d FROM wiki)", "AS d FROM wiki2)").replace("AS g FROM wiki)", "AS g FROM wiki2)")


@query(repeated_sql(V2_SQL))
def link_v2_repeated(spark, sf):
    return linkage.link_v2(*repeated(spark, sf))


PAIRS_SQL = f"""{ACTIVITIES_SQL}, {WIKI_SQL},
c AS (SELECT *, {unicode_sql('city')} AS k FROM activities),
c2 AS (SELECT *, {filtered_sql('name', 'k')} AS t FROM c WHERE k <> ''),
w AS (SELECT *, {unicode_sql("coalesce(geo_parent[1], '')")} AS k, {unicode_sql('title')} AS tk,
      list_transform(geo_parent, lambda x: {ascii_sql('x')}) AS g FROM wiki),
w2 AS (SELECT *, {filtered_sql('title', 'k')} AS t FROM w),
pairs AS (
  SELECT c2.url AS crawler_url, c2.name AS crawler_name, c2.city, w2.title AS wiki_title, w2.url AS wiki_url,
    w2.type AS wiki_type, length(list_intersect(c2.t, w2.t))::INT AS overlap_score,
    CASE WHEN length(list_intersect(c2.t, w2.t)) > 0 OR length(list_intersect(c2.t, w2.g)) > 0
         THEN 'landmark' ELSE 'city_page' END AS match_type,
    array_to_string(c2.t, ' ') AS tokens_c_debug, c2.k AS city_norm_debug,
    w2.abstract AS wiki_abstract, w2.architect AS wiki_architect, w2.style AS wiki_style
  FROM c2 JOIN w2 ON c2.k = w2.k
  WHERE length(list_intersect(c2.t, w2.t)) > 0 OR length(list_intersect(c2.t, w2.g)) > 0 OR c2.k = w2.tk),
ranked AS (SELECT *, row_number() OVER (PARTITION BY crawler_url
  ORDER BY (match_type <> 'landmark'), overlap_score DESC, wiki_url) AS rn FROM pairs)"""
V3_COLUMNS = (
    "crawler_url, crawler_name, city, wiki_title, wiki_url, wiki_type, overlap_score, match_type, "
    "tokens_c_debug, city_norm_debug"
)
V3_SQL = f"WITH {PAIRS_SQL} SELECT {V3_COLUMNS} FROM pairs"


def linked(spark, sf):
    return linkage.linked_v3(activities(spark, sf), wiki_pages(spark, sf))


def flat(df):
    return df.withColumn("tokens_c_debug", F.array_join("tokens_c_debug", " "))


@query(V3_SQL)
def link_v3(spark, sf):
    return flat(linkage.link_v3(activities(spark, sf), wiki_pages(spark, sf)))


@query(V3_SQL)
def link_v3_split(spark, sf):
    """The same with low limits, so that many keys are split on both sides."""
    return flat(linkage.link_v3(activities(spark, sf), wiki_pages(spark, sf), rows_per_slice=7))


@query(
    f"""WITH {PAIRS_SQL} SELECT crawler_url, wiki_url, match_type, overlap_score,
    (SELECT count(*) FROM pairs p WHERE p.crawler_url = ranked.crawler_url) AS n_matches FROM ranked WHERE rn = 1"""
)
def best_match(spark, sf):
    return linkage.best_of_classes(linked(spark, sf))


@query(
    repeated_sql(
        f"""WITH {PAIRS_SQL} SELECT crawler_url, wiki_url, match_type, overlap_score,
    (SELECT count(DISTINCT wiki_url) FROM pairs p WHERE p.crawler_url = ranked.crawler_url) AS n_matches FROM ranked WHERE rn = 1"""
    )
)
def best_match_repeated(spark, sf):
    return linkage.best_of_classes(linkage.linked_v3(*repeated(spark, sf)))


@query(f"WITH {PAIRS_SQL} SELECT crawler_url, wiki_url, match_type, rn = 1 AS is_primary FROM ranked")
def primary_flag(spark, sf):
    return linkage.flag_primary(linked(spark, sf)).select("crawler_url", "wiki_url", "match_type", "is_primary")


NESTED_SQL = f"""WITH {PAIRS_SQL}
SELECT crawler_url AS url, count(*) AS n_matches, max(wiki_title) FILTER (rn = 1) AS primary_title,
  max(wiki_style) FILTER (rn = 1) AS primary_style,
  arg_min(wiki_style, rn) FILTER (wiki_style <> '') AS first_style,
  arg_min(wiki_title, rn) FILTER (wiki_type = 'city') AS first_city,
  {{order}} AS titles
FROM ranked GROUP BY crawler_url"""


@query(NESTED_SQL.replace("{order}", "md5(string_agg(wiki_title, ',' ORDER BY rn))"))
def nested_matches(spark, sf):
    pairs, owners = linkage.activity_groups(linked(spark, sf))
    nested = enrich.nest(pairs, wiki_pages(spark, sf)).select(
        "url", F.size("matches").cast("bigint").alias("n_matches"), F.col("primary_match.wiki_title").alias("primary_title"),
        F.col("primary_match.wiki_style").alias("primary_style"), "first_style", "first_city",
        F.md5(F.array_join(F.transform("matches", lambda m: m["wiki_title"]), ",")).alias("titles"),
    )
    return linkage.of_activities(nested, owners, "url")


@query(NESTED_SQL.replace("{order}", "md5(string_agg(wiki_title, ',' ORDER BY wiki_title))"))
def nested_matches_in_parts(spark, sf):
    """The long table of ranked matches, of which the nested view is made, holds the same matches."""
    pairs, owners = linkage.activity_groups(linked(spark, sf))
    matches = enrich.matches(pairs, wiki_pages(spark, sf))
    heads = linkage.match_facts(matches).select(
        "url", F.col("primary_match.wiki_title").alias("primary_title"),
        F.col("primary_match.wiki_style").alias("primary_style"), "first_style", "first_city",
    )
    titles = matches.groupBy("url").agg(
        F.max("rank").alias("n_matches"), F.md5(F.array_join(F.array_sort(F.collect_list("wiki_title")), ",")).alias("titles")
    )
    return linkage.of_activities(heads.join(titles, "url"), owners, "url")


@query(
    f"""WITH {PAIRS_SQL} SELECT count(*) AS n_pairs, count(*) FILTER (match_type = 'landmark') AS n_landmark,
    count(*) FILTER (match_type = 'city_page') AS n_city_page, count(DISTINCT crawler_url) AS n_activities,
    count(DISTINCT wiki_url) AS n_pages FROM pairs"""
)
def link_stats(spark, sf):
    return profile.class_link_stats(linked(spark, sf))


@query(
    f"""WITH {PAIRS_SQL} SELECT crawler_url, wiki_url, match_type, overlap_score,
    (SELECT count(*) FROM pairs p WHERE p.crawler_url = ranked.crawler_url) AS n_matches FROM ranked WHERE rn = 1"""
)
def best_of_pairs(spark, sf):
    """The same from pairs at hand, of one activity of each group."""
    pairs, owners = linkage.activity_groups(linked(spark, sf))
    return linkage.of_activities(linkage.best_match(pairs), owners)


@query(
    """SELECT s.s_suppkey AS crawler_s_suppkey, s.s_name AS crawler_s_name, s.s_nationkey AS crawler_s_nationkey,
    s.s_acctbal AS crawler_s_acctbal, n.n_nationkey AS wiki_n_nationkey, n.n_name AS wiki_n_name,
    n.n_regionkey AS wiki_n_regionkey FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""
)
def prefixed_join(spark, sf):
    s, n = linkage.prefixed(table(spark, sf, "supplier"), table(spark, sf, "nation"))
    return s.join(n, s["crawler_s_nationkey"] == n["wiki_n_nationkey"])


@query(
    V1_SQL.replace("SELECT c.url AS crawler_url, c.name AS crawler_name, c.city,", "SELECT c.url AS crawler_url, c.name AS crawler_name, c.city AS crawler_city, c.description AS crawler_description, array_to_string(c.highlights, ' ') AS crawler_highlights, array_to_string(w.geo_parent, ' ') AS wiki_geo_parent, w.abstract AS wiki_abstract,")
)
def link_wide(spark, sf):
    """All columns of both sides next to the score."""
    a, w = activities(spark, sf), wiki_pages(spark, sf)
    wide = linkage.widen(linkage.linked_v1(a, w), a, w).rows()
    return wide.drop("wiki_fields").withColumns(
        {c: F.array_join(c, " ") for c in ("crawler_highlights", "wiki_geo_parent")}
    )


@query(
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier"""
)
def union_missing(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return linkage.union_pages(c, s)


# ---- profile

PROFILED_SQL = """
profiled AS (SELECT text AS title, concat('doc/', doc_id) AS url,
  CASE WHEN lang = 'de' THEN NULL WHEN lang = 'es' THEN [source] ELSE [lang, source] END AS geo_parent FROM documents)"""


def profiled(spark, sf):
    return texts(spark, sf).select(
        F.col("text").alias("title"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("lang") == "de", None).when(F.col("lang") == "es", F.array("source")).otherwise(F.array("lang", "source")).alias("geo_parent"),
    )


@query(
    f"""WITH {PROFILED_SQL} SELECT count(*) AS n_rows, count(*) FILTER (geo_parent IS NULL) AS geo_null,
    count(*) FILTER (geo_parent IS NOT NULL) AS geo_not_null,
    count(*) FILTER (coalesce({unicode_sql('geo_parent[2]')}, '') = '') AS key_empty,
    count(*) FILTER (length({split_sql('title')}) <= 20) AS title_short FROM profiled"""
)
def null_profile(spark, sf):
    return profile.page_profile(profiled(spark, sf), geo_index=1, short_title=20)


@query(
    f"""WITH {PROFILED_SQL} SELECT DISTINCT {unicode_sql('geo_parent[2]')} AS geo_key FROM profiled
    ORDER BY 1 NULLS FIRST LIMIT 100"""
)
def key_preview(spark, sf):
    return profile.key_preview(profiled(spark, sf), geo_index=1)


@query(
    f"""WITH {PROFILED_SQL} SELECT title, url FROM profiled WHERE length({split_sql('title')}) <= 20
    ORDER BY title, url LIMIT 20"""
)
def short_titles(spark, sf):
    return profile.short_titles(profiled(spark, sf), max_tokens=20)


@query(
    f"""WITH {PROFILED_SQL}, k AS (SELECT {unicode_sql('geo_parent[1]')} AS geo_key FROM profiled)
    SELECT geo_key, count(*) AS n_pages FROM k WHERE geo_key IN (SELECT DISTINCT {unicode_sql('lang')} FROM documents)
    GROUP BY geo_key ORDER BY n_pages DESC, geo_key LIMIT 50"""
)
def key_coverage(spark, sf):
    cities = table(spark, sf, "documents").select(F.col("lang").alias("city"))
    return profile.key_coverage(profiled(spark, sf), cities)


@query(
    f"""WITH {PROFILED_SQL}, k AS (SELECT {unicode_sql('geo_parent[2]')} AS geo_key FROM profiled)
    SELECT count(*) AS n_rows, count(DISTINCT geo_key) AS n_keys FROM k
    WHERE geo_key IN (SELECT {unicode_sql('source')} FROM documents)"""
)
def coverage_totals(spark, sf):
    cities = table(spark, sf, "documents").select(F.col("source").alias("city"))
    return profile.coverage_totals(profiled(spark, sf), cities, geo_index=1)


COVERED_SQL = f"""WITH {PROFILED_SQL} SELECT url, {unicode_sql('geo_parent[1]')} AS geo_key FROM profiled
    WHERE {unicode_sql('geo_parent[1]')} IN (SELECT {unicode_sql('lang')} FROM documents)"""


@query(COVERED_SQL)
def covered_rows(spark, sf):
    cities = table(spark, sf, "documents").select(F.col("lang").alias("city"))
    return profile.covered_rows(profiled(spark, sf), cities).select("url", "geo_key")


@query(COVERED_SQL)
def covered_rows_split(spark, sf):
    cities = table(spark, sf, "documents").select(F.col("lang").alias("city"))
    return profile.covered_rows(profiled(spark, sf), cities, rows_per_slice=10).select("url", "geo_key")


@query(
    f"""WITH {PROFILED_SQL} SELECT title, url, array_to_string(geo_parent, '|') AS geo_parent FROM profiled
    ORDER BY title, url LIMIT 10"""
)
def sample_geo(spark, sf):
    return profile.sample_geo(profiled(spark, sf)).withColumn("geo_parent", F.array_join("geo_parent", "|"))
