from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.inputs import ACTIVITIES_SQL, table, texts, wiki_pages
from checks.linking import PAIRS_SQL
from checks.registry import query
from placeweave import fixed
from placeweave.functions import safe
from placeweave.functions.text import analysed_terms
from placeweave.operators import evaluate, fuzzy, inverted, linkage, search, search_docs
from placeweave.operators.inverted import Index
from placeweave.plans import enrich
from placeweave.sources.schemas import MATCH
from placeweave.sources.scratch import scratch_path

#: Near terms of a clause in the queries that ask for the best ones only.
FUZZY_MAX_EXPANSIONS = 50

WORDS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')"

# ---- documents: every text is an activity whose headline is its first line, enriched with
# the page of the same number, rated by its label and reviewed by the events of a user

DOCS_SQL = """
reviews AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
docs AS (
  SELECT d.doc_id,
    CASE WHEN split_part(d.text, chr(10), 1) <> '' THEN split_part(d.text, chr(10), 1) ELSE d.source END AS title,
    concat_ws(' ', d.text, concat_ws(' ', d.source, d.lang), '', CASE WHEN p.page_id IS NULL THEN '' ELSE d.source END, '') AS click_text,
    coalesce(regexp_replace(p.html, '<[^>]+>', ' ', 'g'), '') AS wiki_text,
    CASE WHEN d.lang <> 'de' THEN d.lang WHEN p.page_id IS NOT NULL AND p.url <> '' THEN lower(p.url) END AS city,
    concat('doc/', d.doc_id) AS url,
    CASE WHEN p.page_id IS NOT NULL THEN d.source END AS architect, NULL::VARCHAR AS style,
    CASE l.quality WHEN 1 THEN 4.5::DOUBLE END AS rating,
    CASE WHEN r.n IS NOT NULL THEN r.n * 10 END::BIGINT AS review_count
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN reviews r ON r.user_id = d.doc_id)"""


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    reviews = table(spark, sf, "events").groupBy(F.col("user_id").alias("doc_id")).agg(F.count("*").alias("n"))
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"),
        F.col("url").alias("page_url"),
        F.regexp_replace("html", "<[^>]+>", " ").alias("page_text"),
    )
    joined = (
        texts(spark, sf, "documents")
        .join(pages, "doc_id", "left")
        .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
        .join(reviews, "doc_id", "left")
    )
    match = F.struct(
        F.col("page_url").alias("wiki_title"),
        F.when(F.col("lang") == "de", "city").otherwise("museum").alias("wiki_type"),
        F.col("page_text").alias("wiki_abstract"),
        F.col("source").alias("wiki_architect"),
        F.lit("").alias("wiki_style"),
    ).cast(MATCH)
    has_page = F.col("page_url").isNotNull()
    return joined.select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("source").alias("name"),
        F.col("text").alias("description"),
        F.array("source", "lang").alias("highlights"),
        F.lit(None).cast("array<string>").alias("featured_reviews"),
        F.when(F.col("lang") != "de", F.upper("lang")).otherwise("").alias("city"),
        F.when(F.col("quality") == 1, "4.5").when(F.col("quality") == 0, "n/a").alias("rating"),
        F.concat(F.col("n").cast("string"), F.lit(",0")).alias("reviewCount"),
        F.lit(None).cast(MATCH).alias("primary_match"),
        F.when(has_page, F.array(match)).otherwise(F.array().cast(f"array<{MATCH}>")).alias("matches"),
    )


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Search documents, numbered like the texts so that SQL has the same ids."""
    return search_docs.search_documents(enriched(spark, sf), F.split_part("url", F.lit("/"), F.lit(2)).cast("bigint"))


_BUILT: dict[tuple[str, str], str] = {}


def build(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "index")
    inverted.write_index(documents(spark, sf), path)
    return path


def index(spark: SparkSession, sf: str) -> Index:
    """The index of a folder, built on first use and then searched many times."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf)
    return inverted.read_index(spark, _BUILT[key])


@query(
    f"""WITH {DOCS_SQL} SELECT doc_id, md5(title) AS title, md5(click_text) AS click_text, md5(wiki_text) AS wiki_text,
    city, url, architect, style, rating, review_count FROM docs"""
)
def search_doc(spark, sf):
    return documents(spark, sf).withColumns({c: F.md5(c) for c in ("title", "click_text", "wiki_text")})


@query(
    """SELECT o_orderkey, try_cast(CASE o_orderstatus WHEN 'F' THEN replace(o_totalprice::VARCHAR, '.', ',')
      ELSE o_totalprice::VARCHAR END AS DOUBLE) AS rating,
    try_cast(replace(replace(CASE o_orderstatus WHEN 'P' THEN 'about 3' ELSE concat(o_custkey, ',', o_orderkey) END, ',', ''), '.', '') AS BIGINT)
      AS reviews, trunc(o_totalprice)::BIGINT AS decimal_text, trunc(o_totalprice)::BIGINT AS decimal_number FROM orders"""
)
def safe_numbers(spark, sf):
    o = table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("string")
    count = F.when(F.col("o_orderstatus") == "P", "about 3").otherwise(
        F.concat_ws(",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    )
    return o.select(
        "o_orderkey",
        safe.rating_value(F.when(F.col("o_orderstatus") == "F", F.replace(price, F.lit("."), F.lit(","))).otherwise(price)).alias("rating"),
        safe.review_count(count).alias("reviews"),
        safe.review_count(price).alias("decimal_text"),
        safe.review_count(F.col("o_totalprice"), text=False).alias("decimal_number"),
    )


# ---- index tables

LISTS_SQL = f"""
lists AS (
  SELECT doc_id, 'title' AS field, {WORDS.format('title')} AS l FROM docs
  UNION ALL SELECT doc_id, 'click_text', {WORDS.format('click_text')} FROM docs
  UNION ALL SELECT doc_id, 'wiki_text', {WORDS.format('wiki_text')} FROM docs
  UNION ALL SELECT doc_id, 'city', [city] FROM docs WHERE city <> ''),
occurrences AS (SELECT doc_id, field, length(l)::INT AS dl, unnest(l) AS term, generate_subscripts(l, 1) - 1 AS pos FROM lists),
post AS (SELECT field, term, doc_id, dl, count(*)::INT AS tf, list(pos ORDER BY pos) AS positions
  FROM occurrences GROUP BY field, term, doc_id, dl),
tstat AS (SELECT field, term, count(*) AS df FROM post GROUP BY field, term),
fstat AS (SELECT field, count(*) AS n_docs, avg(length(l)) AS avgdl FROM lists WHERE length(l) > 0 GROUP BY field)"""
INDEX_SQL = f"{DOCS_SQL}, {LISTS_SQL}"


@query(
    f"""WITH {INDEX_SQL} SELECT field, term, doc_id, dl, tf,
    CASE WHEN field = 'title' THEN array_to_string(positions, ' ') END AS positions FROM post"""
)
def postings(spark, sf):
    return index(spark, sf).postings.drop("bucket").withColumn("positions", F.array_join("positions", " "))


@query(f"WITH {INDEX_SQL} SELECT * FROM tstat")
def term_stats(spark, sf):
    return index(spark, sf).term_stats.drop("bucket")


@query(f"WITH {INDEX_SQL} SELECT field, doc_id, length(l)::INT AS dl FROM lists WHERE length(l) > 0")
def doc_len(spark, sf):
    return inverted.doc_lengths(inverted.field_terms(documents(spark, sf)))


@query(f"WITH {INDEX_SQL} SELECT field, n_docs, round(avgdl, 6) AS avgdl FROM fstat")
def field_stats(spark, sf):
    return index(spark, sf).field_stats.withColumn("avgdl", F.round("avgdl", 6))


@query(
    f"""WITH {DOCS_SQL} SELECT doc_id, unnest({WORDS.format('city')}) AS term FROM docs"""
)
def city_words(spark, sf):
    """City field of an index that splits cities into words."""
    built = inverted.in_memory_index(documents(spark, sf), split_city=True)
    return built.postings.where("field = 'city'").select("doc_id", F.explode(F.array_repeat("term", F.col("tf"))).alias("term"))


# ---- queries asked

SYNONYMS = {"the": ["of", "der"], "la": ["une", "que de"], "hot": ["her", "in-it"], "and": ["und"]}
SYNONYMS_SQL = "synonyms(token, syn) AS (VALUES " + ", ".join(
    f"('{t}', '{s}')" for t, many in SYNONYMS.items() for s in many
) + ")"

PASSAGES_SQL = "asked AS (SELECT item_id AS query_id, text AS q FROM benchmark)"
ANY_WORD_SQL = "asked AS (SELECT item_id AS query_id, replace(text, ' ', ' or ') AS q FROM benchmark)"
NEIGHBOURS_SQL = f"""
words AS (SELECT item_id, unnest(l) AS a, generate_subscripts(l, 1) AS i FROM (SELECT item_id, {WORDS.format('text')} AS l FROM benchmark)),
asked AS (SELECT DISTINCT concat(x.a, ' ', y.a) AS query_id, concat(x.a, ' ', y.a) AS q
  FROM words x JOIN words y ON x.item_id = y.item_id AND y.i = x.i + 1 WHERE x.a <> 'or' AND y.a <> 'or')"""
NAMES_SQL = "asked AS (SELECT DISTINCT p_name AS query_id, p_name AS q FROM part)"


def passages(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("q"))


def any_word(spark, sf):
    return passages(spark, sf).withColumn("q", F.replace("q", F.lit(" "), F.lit(" or ")))


def neighbours(spark, sf):
    """Any two neighbouring words of a passage."""
    words = table(spark, sf, "benchmark").select(analysed_terms(F.col("text")).alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    asked = words.where(F.size("w") > 1).select(F.inline(pairs)).where("a <> 'or' AND b <> 'or'").select(F.concat_ws(" ", "a", "b").alias("q"))
    return asked.distinct().select(F.col("q").alias("query_id"), "q")


def names(spark, sf):
    return table(spark, sf, "part").select(F.col("p_name").alias("query_id"), F.col("p_name").alias("q")).distinct()


def boosts_sql(boosts: dict[str, float]) -> str:
    return "(VALUES " + ", ".join(f"('{f}', {b}::DOUBLE)" for f, b in boosts.items()) + ") b(field, weight)"


TOKENS_SQL = f"""
qlist AS (SELECT query_id, contains(lower(q), ' or ') AS any_token,
  flatten(list_transform(list_filter(string_split_regex(lower(q), '\\s+'), lambda w: w <> '' AND w <> 'or'),
  lambda w: {WORDS.format('w')})) AS l FROM asked),
tokens AS (SELECT query_id, any_token, length(l) AS n_tokens, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS ord FROM qlist)"""


def letters_sql(c: str) -> str:
    """SQL measures edits in bytes; one byte for each accented letter makes bytes letters."""
    return f"translate({c}, 'ßäçèéêíñóöü', 'ABCDEFGHIJK')"


def near_sql(name: str, source: str, fields: list[str], k: int, most: int | None = None) -> str:
    listed = ", ".join(f"'{f}'" for f in fields)
    return f"""
{name}_near AS (SELECT t.token, v.field, v.term, v.df, damerau_levenshtein({letters_sql('t.token')}, {letters_sql('v.term')}) AS edits
  FROM (SELECT DISTINCT token FROM tokens {source}) t JOIN tstat v
  ON v.field IN ({listed}) AND abs(length(t.token) - length(v.term)) <= {k}
  WHERE damerau_levenshtein({letters_sql('t.token')}, {letters_sql('v.term')}) <= {k}),
{name}_ranked AS (SELECT *, 1 - edits / least(length(token), length(term)) AS factor, row_number() OVER (PARTITION BY token, field
  ORDER BY 1 - edits / least(length(token), length(term)) DESC, term) AS rn FROM {name}_near),
{name}_kept AS (SELECT *, max(df) OVER (PARTITION BY token, field) AS clause_df FROM {name}_ranked
  {f'WHERE rn <= {most}' if most else ''})"""


EXACT = f"""SELECT query_id, ord, 'exact' AS kind, token AS clause, 1 AS n_terms, b.field, token AS term, b.weight, NULL::BIGINT AS clause_df
  FROM tokens, {boosts_sql(fixed.FIELD_BOOSTS)}"""
SYNONYM = f"""SELECT query_id, ord, 'synonym', syn, length(list_distinct({WORDS.format('syn')})), b.field,
  unnest(list_distinct({WORDS.format('syn')})), b.weight, NULL
  FROM tokens JOIN synonyms USING (token), {boosts_sql(fixed.SYNONYM_BOOSTS)}"""
FUZZY = "SELECT query_id, ord, 'fuzzy', token, 1, n.field, n.term, n.factor, n.clause_df FROM tokens JOIN {}_kept n USING (token)"


def scored_sql(tag: str, clauses: list[str], phrase: bool) -> str:
    """Scores of all matching documents, by the definition: join, group, sum."""
    k1, b = fixed.BM25_K1, fixed.BM25_B
    norm = f"({k1} * (1 - {b} + {b} * p.dl / f.avgdl))"
    parts = f"""
{tag}clauses AS ({' UNION ALL '.join(clauses)}),
{tag}hits AS (SELECT c.query_id, c.ord, c.clause, c.kind, c.n_terms, c.field, c.term, p.doc_id,
  ln(1 + (f.n_docs - coalesce(c.clause_df, s.df) + 0.5) / (coalesce(c.clause_df, s.df) + 0.5)) AS idf, {norm} AS norm,
  floor({search.UNIT} * (c.weight * ln(1 + (f.n_docs - coalesce(c.clause_df, s.df) + 0.5) / (coalesce(c.clause_df, s.df) + 0.5)) * p.tf / (p.tf + {norm})))::BIGINT AS score
  FROM {tag}clauses c JOIN post p ON p.field = c.field AND p.term = c.term
  JOIN tstat s ON s.field = c.field AND s.term = c.term JOIN fstat f ON f.field = c.field),
{tag}whole AS (SELECT query_id, doc_id, ord, clause, kind, field, sum(score) AS score FROM {tag}hits
  GROUP BY query_id, doc_id, ord, clause, kind, field, n_terms HAVING kind = 'fuzzy' OR count(*) = n_terms),
{tag}matched AS (SELECT w.query_id, w.doc_id, sum(score) AS score FROM {tag}whole w
  JOIN (SELECT DISTINCT query_id, any_token, n_tokens FROM tokens) t ON t.query_id = w.query_id
  GROUP BY w.query_id, w.doc_id, any_token, n_tokens HAVING any_token OR count(DISTINCT ord) = n_tokens)"""
    if not phrase:
        return parts + f", {tag}scored AS (SELECT query_id, doc_id, score / {search.UNIT}::DOUBLE AS text_score FROM {tag}matched)"
    return parts + f""",
{tag}places AS (SELECT h.query_id, h.doc_id, h.ord, h.idf, h.norm, unnest(p.positions) - h.ord AS shift FROM {tag}hits h
  JOIN post p ON p.field = 'title' AND p.term = h.term AND p.doc_id = h.doc_id WHERE h.kind = 'exact' AND h.field = 'title'),
{tag}nearest AS (SELECT s.query_id, s.doc_id, s.shift AS anchor, x.ord, min(x.shift) AS shift
  FROM (SELECT DISTINCT query_id, doc_id, shift FROM {tag}places) s
  JOIN {tag}places x ON x.query_id = s.query_id AND x.doc_id = s.doc_id AND x.shift BETWEEN s.shift AND s.shift + {fixed.PHRASE_SLOP}
  GROUP BY s.query_id, s.doc_id, s.shift, x.ord),
{tag}close AS (SELECT n.query_id, n.doc_id, anchor, 1.0::DOUBLE / (1 + max(shift) - anchor) AS c FROM {tag}nearest n
  JOIN (SELECT DISTINCT query_id, n_tokens FROM tokens) t ON t.query_id = n.query_id
  GROUP BY n.query_id, n.doc_id, anchor, n_tokens HAVING n_tokens > 1 AND count(*) = n_tokens AND count(DISTINCT shift + ord) = n_tokens),
{tag}phrases AS (SELECT query_id, doc_id, sum(c) AS tf FROM {tag}close GROUP BY query_id, doc_id),
{tag}idfs AS (SELECT query_id, doc_id, sum(idf) AS idf, min(norm) AS norm FROM
  (SELECT DISTINCT query_id, doc_id, ord, idf, norm FROM {tag}places) GROUP BY query_id, doc_id),
{tag}scored AS (SELECT m.query_id, m.doc_id,
  (m.score + coalesce(floor({search.UNIT} * ({fixed.PHRASE_BOOST} * i.idf * p.tf / (p.tf + i.norm)))::BIGINT, 0)) / {search.UNIT}::DOUBLE AS text_score
  FROM {tag}matched m LEFT JOIN {tag}phrases p ON p.query_id = m.query_id AND p.doc_id = m.doc_id
  LEFT JOIN {tag}idfs i ON i.query_id = m.query_id AND i.doc_id = m.doc_id)"""


def top_sql(tag: str, n: int = fixed.CANDIDATES) -> str:
    return f"""{tag}top AS (SELECT query_id, doc_id, text_score FROM (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY text_score DESC, doc_id) AS rn FROM {tag}scored) WHERE rn <= {n})"""


#: Ranks come from exact sums; scores are rounded for the comparison alone.
SHOW_TEXT_SCORE = "* REPLACE (round(text_score, 6) AS text_score)"


def six_places(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("text_score", "final_score") if c in df.columns})


def exact_only(spark, sf, queries):
    built, tokens = index(spark, sf), search.query_tokens(queries)
    return six_places(search.best_documents(tokens, search.exact_clauses(tokens), built, phrase=False))


@query(f"WITH {PASSAGES_SQL}, {TOKENS_SQL} SELECT query_id, any_token, n_tokens::INT AS n_tokens, token, ord::INT AS ord FROM tokens")
def query_tokens(spark, sf):
    return search.query_tokens(passages(spark, sf))


@query(f"WITH {INDEX_SQL}, {PASSAGES_SQL}, {TOKENS_SQL}, {scored_sql('', [EXACT], False)}, {top_sql('')} SELECT {SHOW_TEXT_SCORE} FROM top")
def bm25_and(spark, sf):
    return exact_only(spark, sf, passages(spark, sf))


@query(f"WITH {INDEX_SQL}, {ANY_WORD_SQL}, {TOKENS_SQL}, {scored_sql('', [EXACT], False)}, {top_sql('')} SELECT {SHOW_TEXT_SCORE} FROM top")
def bm25_or(spark, sf):
    return exact_only(spark, sf, any_word(spark, sf))


@query(
    f"""WITH {INDEX_SQL}, {NEIGHBOURS_SQL}, {TOKENS_SQL}, {SYNONYMS_SQL}, {scored_sql('', [EXACT, SYNONYM], False)}, {top_sql('')}
    SELECT {SHOW_TEXT_SCORE} FROM top"""
)
def synonyms(spark, sf):
    built, tokens = index(spark, sf), search.query_tokens(neighbours(spark, sf))
    table_of = search.synonym_table(spark, SYNONYMS)
    clauses = search.exact_clauses(tokens).unionByName(search.synonym_clauses(tokens, table_of))
    return six_places(search.best_documents(tokens, clauses, built, phrase=False))


@query(f"WITH {INDEX_SQL}, {NEIGHBOURS_SQL}, {TOKENS_SQL}, {scored_sql('', [EXACT], True)}, {top_sql('')} SELECT {SHOW_TEXT_SCORE} FROM top")
def phrase(spark, sf):
    built, tokens = index(spark, sf), search.query_tokens(neighbours(spark, sf))
    return six_places(search.best_documents(tokens, search.exact_clauses(tokens), built, phrase=True))


@query(
    f"""WITH {INDEX_SQL}, {PASSAGES_SQL}, {TOKENS_SQL}, {near_sql('weak', '', ['title'], 1)}
    SELECT token, field, term, df, edits::INT AS edits FROM weak_near"""
)
def fuzzy1(spark, sf):
    titles = index(spark, sf).term_stats.where("field = 'title'")
    return fuzzy.near_terms(search.query_tokens(passages(spark, sf)), titles, 1)


@query(
    f"""WITH {INDEX_SQL}, {NAMES_SQL}, {TOKENS_SQL}, {near_sql('far', '', ['title', 'click_text'], 2, FUZZY_MAX_EXPANSIONS)}
    SELECT token, field, term, round(factor, 6) AS factor, clause_df FROM far_kept"""
)
def fuzzy2(spark, sf):
    words = index(spark, sf).term_stats.where(F.col("field").isin("title", "click_text"))
    near = fuzzy.expansions(search.query_tokens(names(spark, sf)), words, 2, FUZZY_MAX_EXPANSIONS)
    return near.select("token", "field", "term", F.round("factor", 6).alias("factor"), "clause_df")


@query(
    f"""WITH {INDEX_SQL}, {NAMES_SQL}, {TOKENS_SQL}, {near_sql('far', '', ['title', 'click_text'], 2)}
    SELECT token, field, term, round(factor, 6) AS factor, clause_df FROM far_kept"""
)
def fuzzy2_all(spark, sf):
    """The same without a limit on near terms."""
    words = index(spark, sf).term_stats.where(F.col("field").isin("title", "click_text"))
    near = fuzzy.expansions(search.query_tokens(names(spark, sf)), words, 2)
    return near.select("token", "field", "term", F.round("factor", 6).alias("factor"), "clause_df")


FIRST_FUZZY = """SELECT query_id, ord, 'fuzzy' AS kind, token AS clause, 1 AS n_terms, n.field, n.term, n.factor AS weight, n.clause_df
  FROM tokens JOIN far_kept n USING (token)"""

FALLBACK_SQL = f"""{INDEX_SQL}, {NAMES_SQL}, {TOKENS_SQL}, {SYNONYMS_SQL},
{near_sql('weak', f'WHERE length(token) >= {fixed.WEAK_FUZZY_MIN_LENGTH}', ['title'], 1)},
{near_sql('far', '', ['title', 'click_text'], 2)},
{scored_sql('first_', [EXACT, SYNONYM, FUZZY.format('weak') + f' WHERE length(token) >= {fixed.WEAK_FUZZY_MIN_LENGTH}'], True)}, {top_sql('first_')},
{scored_sql('second_', [FIRST_FUZZY, SYNONYM], False)}, {top_sql('second_')},
answers AS (SELECT *, false AS did_you_mean FROM first_top UNION ALL
  SELECT *, true FROM second_top WHERE query_id NOT IN (SELECT query_id FROM first_top))"""


@query(f"WITH {FALLBACK_SQL} SELECT {SHOW_TEXT_SCORE} FROM answers")
def fallback(spark, sf):
    return six_places(search.candidates_with_fallback(names(spark, sf), index(spark, sf), search.synonym_table(spark, SYNONYMS)))


RERANK_SQL = f"""
shown AS (SELECT t.*, CASE WHEN d.title <> '' THEN d.title ELSE 'Unknown' END AS title, coalesce(d.city, 'N/A') AS city, d.url, d.architect, d.style,
  coalesce(d.rating, 0) AS rating, coalesce(d.review_count, 0) AS reviews,
  t.text_score * (1 + CASE WHEN coalesce(d.review_count, 0) > 0 THEN log10(d.review_count + 1) ELSE 0 END)
    * CASE WHEN coalesce(d.rating, 0) > 0 THEN d.rating / 5.0 ELSE 0.5 END AS final_score
  FROM {{found}} t JOIN docs d USING (doc_id)),
page AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY final_score DESC, doc_id))::INT AS rank FROM shown)
SELECT * REPLACE (round(text_score, 6) AS text_score, round(final_score, 6) AS final_score) FROM page WHERE rank <= {fixed.PAGE_SIZE}"""



@query(f"WITH {FALLBACK_SQL}, {RERANK_SQL.format(found='answers')}")
def misspelt_pages(spark, sf):
    """Result pages of queries most of which need the second try."""
    return six_places(search.search(names(spark, sf), index(spark, sf), search.synonym_table(spark, SYNONYMS)))


def standard_sql(most: int | None) -> str:
    return f"""{INDEX_SQL}, {NEIGHBOURS_SQL}, {TOKENS_SQL}, {SYNONYMS_SQL},
{near_sql('weak', f'WHERE length(token) >= {fixed.WEAK_FUZZY_MIN_LENGTH}', ['title'], 1, most)},
{scored_sql('', [EXACT, SYNONYM, FUZZY.format('weak') + f' WHERE length(token) >= {fixed.WEAK_FUZZY_MIN_LENGTH}'], True)}, {top_sql('')}"""


def pages_of_neighbours(spark, sf, **settings):
    built = index(spark, sf)
    found = search.candidates(neighbours(spark, sf), built, search.synonym_table(spark, SYNONYMS), **settings)
    return six_places(search.rerank(found, built.docs))


@query(f"WITH {standard_sql(None)}, {RERANK_SQL.format(found='top')}")
def rerank(spark, sf):
    """Result pages of all pairs of neighbouring words, with every kind of clause."""
    return pages_of_neighbours(spark, sf)


@query(f"WITH {standard_sql(None)}, {RERANK_SQL.format(found='top')}")
def rerank_split(spark, sf):
    """The same with terms split that have more than 20 documents."""
    return pages_of_neighbours(spark, sf, rows_per_slice=20)


@query(f"WITH {standard_sql(FUZZY_MAX_EXPANSIONS)}, {RERANK_SQL.format(found='top')}")
def rerank_best_near(spark, sf):
    """The same with the best near terms only."""
    return pages_of_neighbours(spark, sf, most_near=FUZZY_MAX_EXPANSIONS)


# ---- evaluation: the texts of a source, in the order of their numbers, judged by their label

NDCG_SQL = """WITH hits AS (SELECT source AS query_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank,
  concat('doc/', doc_id) AS title, doc_id FROM documents),
judged AS (SELECT h.query_id, h.rank, coalesce(l.quality::DOUBLE, 0) * CASE WHEN l.toxic = 1 THEN 0.5 ELSE 1 END AS relevance
  FROM hits h LEFT JOIN labels l USING (doc_id)),
j2 AS (SELECT query_id, rank, coalesce(relevance, 0) AS relevance FROM judged),
ideal AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) AS rank, relevance FROM j2),
d AS (SELECT query_id, count(*) AS n_hits, sum(relevance / log2(rank + 1)) AS dcg FROM j2 GROUP BY query_id),
i AS (SELECT query_id, sum(relevance / log2(rank + 1)) AS idcg FROM ideal GROUP BY query_id)
SELECT query_id, n_hits, round(dcg, 6) AS dcg, round(idcg, 6) AS idcg,
  round(CASE WHEN idcg > 0 THEN 100 * dcg / idcg ELSE 0 END, 6) AS ndcg FROM d JOIN i USING (query_id)"""


def judged_sources(spark, sf):
    in_order = Window.partitionBy("query_id").orderBy("doc_id")
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("query_id"), "doc_id", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("title")
    )
    hits = docs.withColumn("rank", F.row_number().over(in_order))
    labels = table(spark, sf, "labels").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("title"),
        (F.col("quality") * F.when(F.col("toxic") == 1, 0.5).otherwise(1.0)).alias("relevance"),
    )
    judgments = docs.select("query_id", "title").join(labels, "title")
    return evaluate.judge_hits(hits, judgments)


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("dcg", "idcg", "ndcg")})


@query(NDCG_SQL)
def ndcg(spark, sf):
    return rounded(evaluate.ndcg(judged_sources(spark, sf)))


@query(NDCG_SQL)
def ndcg_split(spark, sf):
    """The same from hits that lie in many tasks, in no order."""
    return rounded(evaluate.ndcg(judged_sources(spark, sf).repartition(40)))


@query(NDCG_SQL.replace("coalesce(l.quality::DOUBLE, 0) * CASE WHEN l.toxic = 1 THEN 0.5 ELSE 1 END", "(h.doc_id * 7919 % 10007) / 10007.0::DOUBLE"))
def ndcg_continuous(spark, sf):
    """Nearly every hit has a relevance of its own."""
    in_order = Window.partitionBy("query_id").orderBy("doc_id")
    docs = table(spark, sf, "documents").select(F.col("source").alias("query_id"), "doc_id", F.concat(F.lit("doc/"), "doc_id").alias("title"))
    judgments = docs.select("query_id", "title", (F.col("doc_id") * 7919 % 10007 / F.lit(10007.0)).alias("relevance"))
    return rounded(evaluate.ndcg(evaluate.judge_hits(docs.withColumn("rank", F.row_number().over(in_order)), judgments)))


# ---- from activities and pages to hits: cities filled in, linked, ranked, indexed, searched

NAMED_SQL = """
activities AS (
  SELECT concat('part/', p_partkey) AS url, concat('Best ', upper(p_name), ' of ', p_brand) AS name, lower(p_brand) AS city,
         concat(p_type, ' ', p_size) AS description, [p_type, p_brand] AS highlights
  FROM part)"""
LINKED_SQL = f"""{PAIRS_SQL.replace(ACTIVITIES_SQL, NAMED_SQL)},
heads AS (SELECT crawler_url AS url, arg_min(wiki_architect, rn) FILTER (wiki_architect <> '') AS architect,
  arg_min(wiki_style, rn) FILTER (wiki_style <> '') AS style, string_agg(wiki_abstract, ' ' ORDER BY rn) AS wiki_text
  FROM ranked GROUP BY crawler_url),
docs AS (SELECT row_number() OVER (ORDER BY a.url) - 1 AS doc_id, a.name AS title,
  concat_ws(' ', description, array_to_string(highlights, ' '), h.architect, h.style) AS click_text,
  coalesce(h.wiki_text, '') AS wiki_text, a.city, a.url, h.architect, h.style
  FROM activities a LEFT JOIN heads h ON h.url = a.url)"""


def named_activities(spark, sf):
    """Parts as activities, every row twice; only some know their city, all have it in their name."""
    part = texts(spark, sf, "part")
    none = lambda c: F.lit(None).cast("string").alias(c)
    rows = part.select(
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url"),
        F.lit("").alias("title"),
        F.concat(F.lit("Best "), F.upper("p_name"), F.lit(" of "), "p_brand").alias("name"),
        F.when(F.col("p_type") == "PROMO", F.col("p_brand")).alias("city"),
        F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("description"),
        F.array("p_type", "p_brand").alias("highlights"),
        F.lit(None).cast("array<string>").alias("featured_reviews"),
        none("rating"),
        none("reviewCount"),
    )
    return rows.unionByName(rows)


def linked_index(spark, sf):
    part, pages = table(spark, sf, "part"), wiki_pages(spark, sf)
    brands = part.select(F.lower("p_brand").alias("phrase")).distinct()
    brands = brands.select(F.conv(F.substring(F.md5("phrase"), 1, 7), 16, 10).cast("int").alias("pos"), "phrase")
    placed = linkage.written(enrich.place(named_activities(spark, sf), brands), "placed")
    landmarks, cities = pages.where("type <> 'city'"), pages.where("type = 'city'").drop("fields")
    # Activities with the same matches are a group: matches are ranked, and their texts counted, once for each.
    pairs, owners = linkage.activity_groups(enrich.linked(placed.dropDuplicates(["url"]), landmarks, cities, brands))
    ranked = enrich.matches(pairs, linkage.union_pages(landmarks, cities))
    return enrich.build_index(placed, ranked, scratch_path(spark, "linked"), owners)


@query(f"WITH {LINKED_SQL} SELECT doc_id, url, title, city, architect, style FROM docs")
def numbered_documents(spark, sf):
    """Equal rows are one document; numbers go by url."""
    return linked_index(spark, sf).docs.drop("rating", "review_count")


@query(
    f"""WITH {LINKED_SQL}, {LISTS_SQL}, {NAMES_SQL}, {TOKENS_SQL}, {scored_sql('', [EXACT], False)}, {top_sql('')}
    SELECT query_id, url, city, round(text_score, 6) AS text_score FROM top JOIN docs USING (doc_id)"""
)
def search_linked(spark, sf):
    """Activities without a city are linked by the one in their name and found, once, by the texts of their pages."""
    built, tokens = linked_index(spark, sf), search.query_tokens(names(spark, sf))
    found = search.best_documents(tokens, search.exact_clauses(tokens), built, phrase=False).join(built.docs, "doc_id")
    return six_places(found.select("query_id", "url", "city", "text_score"))
