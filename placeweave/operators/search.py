"""Batch search: a table of queries against an index.

A query is a list of tokens.  Each token is a group of alternatives (clauses): the term in
each field, near terms, synonyms.  A document matches if all groups (or, with "or", any
group) have a clause in it; its score is the sum over its clauses.

What a token earns in a document is the same for every query that has it.  So a batch of queries
reads the postings once, for its distinct clauses; the postings found are written down, added up by
token and document, and everything else (which documents match, scores, phrases) comes from these tables.

Scores are added as whole numbers of 1/UNIT, so that sums, and with them ranks, don't depend on their order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeweave import fixed
from placeweave.functions.text import analysed_terms, bind
from placeweave.operators.best import Asked, best_in_tasks
from placeweave.operators.fuzzy import expansions
from placeweave.operators.inverted import Index
from placeweave.operators.skew import ROWS_PER_SLICE, hot_keys, split_hot_join
from placeweave.sources.scratch import scratch_path

# Tokens of a query are the bits of one number; longer queries count their tokens instead.
MASK_BITS = 62
# Checking a document for a token costs a shuffle, adding up a hit does not.
CHECK_COST = 4
# Tokens of a batch of queries that is sent to all tasks; a larger batch is shuffled.
TOKENS_AT_ONCE = 200_000
UNIT = 10**12

QUERY = ["query_id", "any_token", "n_tokens"]
CLAUSE = ["token", "kind", "clause", "n_terms", "field", "term", "weight", "clause_df"]


def query_tokens(queries: DataFrame) -> DataFrame:
    """Tokens of each query (query_id, q) with their order; "or" between words means any of them."""
    words = F.filter(F.split(F.lower("q"), r"\s+"), lambda w: (w != "") & (w != "or"))
    staged = queries.select(
        "query_id",
        F.lower("q").contains(" or ").alias("any_token"),
        F.flatten(F.transform(words, analysed_terms)).alias("tokens"),
    )
    return staged.select(
        "query_id", "any_token", F.size("tokens").alias("n_tokens"), F.posexplode("tokens").alias("ord", "token")
    )


def synonym_table(spark: SparkSession, synonyms: dict[str, list[str]] | None = None) -> DataFrame:
    table = fixed.SYNONYMS if synonyms is None else synonyms
    rows = [(term, syn) for term, many in table.items() for syn in many]
    return spark.createDataFrame(rows, "token string, syn string")


def _boosted(boosts: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(f).alias("field"), F.lit(b).alias("weight")) for f, b in boosts.items()])


def exact_clauses(tokens: DataFrame) -> DataFrame:
    return tokens.select("token").distinct().select(
        "token", F.lit("exact").alias("kind"), F.col("token").alias("clause"), F.lit(1).alias("n_terms"),
        F.col("token").alias("term"), F.lit(None).cast("bigint").alias("clause_df"), F.inline(_boosted(fixed.FIELD_BOOSTS)),
    ).select(*CLAUSE)


def fuzzy_clauses(tokens: DataFrame, vocabulary: DataFrame, k: int, most: int | None = None) -> DataFrame:
    return expansions(tokens, vocabulary, k, most).select(
        "token", F.lit("fuzzy").alias("kind"), F.col("token").alias("clause"), F.lit(1).alias("n_terms"),
        "field", "term", (F.lit(fixed.FUZZY_BOOST) * F.col("factor")).alias("weight"), "clause_df",
    )


def synonym_clauses(tokens: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Synonyms are analysed like any text; one of several words needs all of them in the field."""
    asked = tokens.select("token").distinct()
    found = asked.join(synonyms, "token").withColumn("terms", F.array_distinct(analysed_terms(F.col("syn"))))
    return found.select(
        "token", F.lit("synonym").alias("kind"), F.col("syn").alias("clause"),
        F.size("terms").alias("n_terms"), F.explode("terms").alias("term"),
        F.lit(None).cast("bigint").alias("clause_df"), _boosted(fixed.SYNONYM_BOOSTS).alias("boosts"),
    ).select("*", F.inline("boosts")).select(*CLAUSE)


def standard_clauses(tokens: DataFrame, index: Index, synonyms: DataFrame, most_near: int | None = None) -> DataFrame:
    long_enough = tokens.where(F.length("token") >= fixed.WEAK_FUZZY_MIN_LENGTH)
    titles = index.term_stats.where("field = 'title'").select("field", "term", "df")
    return (
        exact_clauses(tokens)
        .unionByName(fuzzy_clauses(long_enough, titles, 1, most_near))
        .unionByName(synonym_clauses(tokens, synonyms))
    )


def spelling_clauses(tokens: DataFrame, index: Index, synonyms: DataFrame, most_near: int | None = None) -> DataFrame:
    """Clauses of the second try, for queries nothing was found for."""
    words = index.term_stats.where(F.col("field").isin("title", "click_text")).select("field", "term", "df")
    return fuzzy_clauses(tokens, words, 2, most_near).unionByName(synonym_clauses(tokens, synonyms))


def _length_norm() -> Column:
    k1, b = fixed.BM25_K1, fixed.BM25_B
    return k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))


def _units(score: Column) -> Column:
    return F.floor(score * UNIT).cast("bigint")


def _written(table: DataFrame, name: str) -> DataFrame:
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _with_idf(clauses: DataFrame, index: Index) -> DataFrame:
    """Distinct clauses whose term occurs, with what BM25 needs to know about term and field, as a written table."""
    stats = index.term_stats.select(*index.term_keys, "df")
    n, df = F.col("n_docs"), F.coalesce("clause_df", "df")
    found = (
        stats.join(_for_lookup(index.with_bucket(clauses), index), index.term_keys)
        .join(F.broadcast(index.field_stats), "field")  # one row for each field
        .withColumn("idf", F.log1p((n - df + 0.5) / (df + 0.5)))
        .drop("n_docs", "clause_df")
    )
    return _written(found, "clauses")


def _for_lookup(clauses: DataFrame, index: Index) -> DataFrame:
    """Clauses to be joined with tables in buckets; the (true) condition lets Spark read the wanted buckets only."""
    return clauses if index.buckets is None else clauses.where(F.col("bucket") >= 0)


def fetched_postings(clauses: DataFrame, index: Index, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Documents with a clause's term and what it earns there, as a written table: the one reading of the postings.

    Few clauses (the number is known) travel to the postings, of which only their buckets are read.  Otherwise
    both sides are shuffled and split, since nearly every document may have a common term.
    """
    known = _with_idf(clauses, index)
    keys = index.term_keys
    if known.count() <= rows_per_slice:
        hits = index.postings.join(F.broadcast(_for_lookup(known, index)), keys)
    else:
        hot = hot_keys(index.term_stats, keys, rows_per_slice, "_rn", count="df")
        hits = split_hot_join(known, index.postings, keys, ["token", "clause"], ["doc_id"], rows_per_slice, right_hot=hot)
    in_title = (F.col("kind") == "exact") & (F.col("field") == "title")
    score = F.col("weight") * F.col("idf") * F.col("tf") / (F.col("tf") + _length_norm())
    place = F.struct("positions", "idf", _length_norm().alias("norm"))
    return _written(
        hits.select("token", "clause", "field", "n_terms", "doc_id", _units(score).alias("units"), F.when(in_title, place).alias("place")),
        "fetched",
    )


def _complete_clauses(fetched: DataFrame) -> DataFrame:
    """(token, doc_id, units) of the clauses of several words whose words are all there."""
    counted = fetched.where("n_terms > 1").groupBy("token", "doc_id", "clause", "field", "n_terms").agg(F.sum("units").alias("units"), F.count("*").alias("n"))
    return counted.where("n = n_terms").select("token", "doc_id", "units")


def token_hits(fetched: DataFrame) -> DataFrame:
    """(token, doc_id, units): what all clauses of a token earn in a document.

    A clause of several words counts if all are there.
    """
    both = fetched.where("n_terms = 1").select("token", "doc_id", "units").unionByName(_complete_clauses(fetched))
    return _written(both.groupBy("token", "doc_id").agg(F.sum("units").alias("units")), "token-hits")


@dataclass
class Hits:
    """Documents of tokens, and how many each token has (``df``; tokens without any are not in it)."""

    rows: DataFrame
    counts: DataFrame

    def of(self, asked: DataFrame, n_asked: int, rows_per_slice: int) -> DataFrame:
        """Rows of ``asked`` tokens with the documents; many queries may ask for a token that many documents have."""
        if n_asked <= rows_per_slice:
            return self.rows.join(F.broadcast(asked), "token")
        hot = hot_keys(self.counts, ["token"], rows_per_slice, "_rn", count="df")
        return split_hot_join(asked, self.rows, ["token"], ["query_id", "ord"], ["doc_id"], rows_per_slice, right_hot=hot)

    def in_documents(self, found: DataFrame, asked: DataFrame, n_asked: int, rows_per_slice: int) -> DataFrame:
        """Rows of the tokens of a query in the documents found for it (query_id, doc_id)."""
        few = n_asked <= rows_per_slice
        checks = found.join(F.broadcast(asked) if few else asked, "query_id")
        wanted = asked.select("token").distinct()
        rows = self.rows.join(F.broadcast(wanted) if few else wanted, "token", "left_semi")
        return checks.join(rows, ["token", "doc_id"])


def hits_of(rows: DataFrame) -> Hits:
    return Hits(rows, _written(rows.groupBy("token").agg(F.count("*").alias("df")), "token-counts"))


def planned_tokens(tokens: DataFrame, hits: Hits) -> DataFrame:
    """Tokens of the queries that can match at all, as a written table with a ``way`` to find their documents.

    ``lead`` is the token of a query with the fewest documents.  A query that needs all its tokens goes
    the way "lead" (look only at documents that have the lead) if that touches fewer rows than
    simply adding up all of them, the way "all".
    """
    of_query = Window.partitionBy("query_id")
    rarest = F.col("rarest")
    led = (F.col("n_tokens") > MASK_BITS) | (rarest["df"] * F.col("n_tokens") * CHECK_COST < F.sum("df").over(of_query))
    planned = (
        tokens.select(*QUERY, "ord", "token")
        .join(hits.counts, "token")
        .withColumn("rarest", F.min(F.struct("df", "ord")).over(of_query))
        .withColumn("n_found", F.count("*").over(of_query))
        .where("any_token OR n_found = n_tokens")
        .withColumn("way", F.when(F.col("any_token"), "any").when(led, "lead").otherwise("all"))
        .withColumn("lead", rarest["ord"])
        .drop("df", "rarest", "n_found")
    )
    return _written(planned, "tokens")


def combine(
    tokens: DataFrame, clauses: DataFrame, index: Index, phrase: bool, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Matching documents of each query with their text score. tokens: ``query_tokens``; clauses: of their distinct tokens."""
    tokens = _written(tokens, "query-tokens")
    fetched = fetched_postings(clauses, index, rows_per_slice)
    hits = hits_of(token_hits(fetched))
    planned = planned_tokens(tokens, hits)
    sizes = {r["way"]: r["n"] for r in planned.groupBy("way").agg(F.count("*").alias("n")).collect()}
    of_document = ["query_id", "doc_id"]
    ways = []
    for way, n in sizes.items():
        asked = planned.where(F.col("way") == way).select("query_id", "n_tokens", "ord", "token", "lead")
        if way == "any":
            matched = hits.of(asked, n, rows_per_slice).groupBy(*of_document).agg(F.sum("units").alias("units"))
        elif way == "all":
            # Which tokens a document has is one bit each, so rows add up before they are shuffled.
            bit = F.expr("shiftleft(1L, ord)")
            matched = (
                hits.of(asked, n, rows_per_slice)
                .groupBy(*of_document, "n_tokens")
                .agg(F.sum("units").alias("units"), F.bit_or(bit).alias("bits"))
                .where(F.bit_count("bits") == F.col("n_tokens"))
            )
        else:
            found = hits.of(asked.where("ord = lead"), n, rows_per_slice).select(*of_document)
            matched = (
                hits.in_documents(found, asked, n, rows_per_slice)
                .groupBy(*of_document, "n_tokens")
                .agg(F.sum("units").alias("units"), F.count("*").alias("n"))
                .where("n = n_tokens")
            )
        ways.append(matched.select(*of_document, "units"))
    if not ways:
        return planned.select("query_id", F.lit(0).cast("bigint").alias("doc_id"), F.lit(0.0).alias("text_score"))
    matched = ways[0]
    for other in ways[1:]:
        matched = matched.unionByName(other)
    if phrase:
        matched = matched.join(phrase_scores(planned, fetched, rows_per_slice), of_document, "left").withColumn(
            "units", F.col("units") + F.coalesce("phrase_units", F.lit(0))
        )
    return matched.select(*of_document, (F.col("units") / UNIT).alias("text_score"))


def phrase_scores(planned: DataFrame, fetched: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """What documents earn whose title has all words of a query close together."""
    places = fetched.where("place IS NOT NULL").select("token", "doc_id", "place.*")
    titles = hits_of(places)
    words = planned.where("n_tokens > 1").join(titles.counts, "token")
    words = words.withColumn("n_found", F.count("*").over(Window.partitionBy("query_id"))).where("n_found = n_tokens")
    words = _written(words.select("query_id", "n_tokens", "ord", "token"), "phrase-words")
    n = words.count()
    # Positions are fetched only where all words are; a title has one row per word of the query.
    complete = (
        Hits(places.select("token", "doc_id"), titles.counts).of(words, n, rows_per_slice)
        .groupBy("query_id", "doc_id", "n_tokens")
        .agg(F.count("*").alias("n_found"))
        .where("n_found = n_tokens")
        .select("query_id", "doc_id")
    )
    place = F.struct("ord", "positions", "idf", "norm")
    found = (
        titles.in_documents(complete, words, n, rows_per_slice)
        .groupBy("query_id", "doc_id")
        .agg(F.sort_array(F.collect_list(place)).alias("places"))
    )
    return found.select("query_id", "doc_id", _units(bind(F.col("places"), phrase_score)).alias("phrase_units"))


def phrase_frequency(places: Column, slop: int = fixed.PHRASE_SLOP) -> Column:
    """How often, and how closely, the words of a phrase stand together.

    A word's position less its place in the phrase is the same for all words of an exact
    phrase.  Every such shifted position starts a match if each word has one at most
    ``slop`` further on, at a position of its own; the closer they are the more it counts.
    """
    shifted = F.array_sort(
        F.flatten(
            F.transform(
                places,
                lambda w: F.transform(w["positions"], lambda p: F.struct((p - w["ord"]).alias("at"), w["ord"].alias("ord"))),
            )
        )
    )

    def total(occurrences: Column) -> Column:
        def closeness(x: Column, i: Column) -> Column:
            # A word has one occurrence per shifted position, so what is near lies in a short run.
            run = F.slice(occurrences, i + 1, F.size(places) * (slop + 1))
            near = F.filter(run, lambda y: y["at"] <= x["at"] + slop)
            nearest = F.transform(
                places, lambda w: F.array_min(F.transform(F.filter(near, lambda y: y["ord"] == w["ord"]), lambda y: y["at"]))
            )
            repeats = F.coalesce(F.get(occurrences, i - 1)["at"] == x["at"], F.lit(False))
            return F.when(repeats, 0.0).otherwise(bind(nearest, lambda at: weight(at, x["at"])))

        return F.aggregate(F.transform(occurrences, closeness), F.lit(0.0), lambda t, c: t + c)

    def weight(nearest: Column, start: Column) -> Column:
        own = F.zip_with(nearest, places, lambda p, w: p + w["ord"])
        ok = ~F.exists(nearest, lambda p: p.isNull()) & (F.size(F.array_distinct(own)) == F.size(places))
        return F.when(ok, 1.0 / (1 + F.array_max(nearest) - start)).otherwise(0.0)

    return bind(shifted, total)


def phrase_score(places: Column) -> Column:
    idf = F.aggregate(F.transform(places, lambda w: w["idf"]), F.lit(0.0), lambda total, i: total + i)
    norm = F.get(places, F.lit(0))["norm"]
    return F.lit(fixed.PHRASE_BOOST) * idf * bind(phrase_frequency(places), lambda tf: tf / (tf + norm))


def top_hits(scored: DataFrame, score: str, n: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc(score), "doc_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def best_documents(
    tokens: DataFrame,
    clauses: DataFrame,
    index: Index,
    phrase: bool,
    n: int = fixed.CANDIDATES,
    rows_per_slice: int = ROWS_PER_SLICE,
    tokens_at_once: int = TOKENS_AT_ONCE,
) -> DataFrame:
    """The best ``n`` documents of each query: ``top_hits`` of ``combine``, without a row for each document that matches.

    A batch of up to ``tokens_at_once`` tokens travels to the hits, which are dealt by document; ``rows_per_slice`` is that of
    ``fetched_postings``. A larger batch is combined as a whole.
    """
    spark = tokens.sparkSession
    tokens = _written(tokens, "query-tokens")
    if tokens.count() > tokens_at_once:
        return top_hits(combine(tokens, clauses, index, phrase, rows_per_slice), "text_score", n).drop("rank")
    fetched = fetched_postings(clauses, index, rows_per_slice)
    place = [F.col(f"place.{c}").alias(c) for c in ("positions", "idf", "norm")]
    single = fetched.where("n_terms = 1").select("token", "doc_id", "units", *place)
    complete = _written(_complete_clauses(fetched), "complete")
    rows = single.unionByName(complete, allowMissingColumns=True)
    found = {r["token"] for r in rows.select("token").distinct().collect()}
    numbers, queries = {}, {}
    for r in tokens.select("query_id", "any_token", "n_tokens", "ord", "token").orderBy("query_id", "ord", "token").collect():
        if r["token"] in found:
            queries.setdefault(r["query_id"], []).append((r["any_token"], r["n_tokens"], r["ord"], numbers.setdefault(r["token"], len(numbers))))
    asked, names = [], []
    for query_id, words in queries.items():
        for any_token in (False, True):
            own = [w for w in words if w[0] == any_token]
            whole = [w for w in own if w[1] == len(words)]
            if not any_token and len({w[2] for w in whole}) < len(words):
                continue  # a word is nowhere
            used = own if any_token else whole
            if used:
                asked.append(Asked(any_token, max(w[1] for w in used), [w[3] for w in used], [w[2] for w in used]))
                names.append((len(names), query_id))
    kind = tokens.schema["query_id"].dataType.simpleString()
    used_numbers = {t for a in asked for t in a.tokens}
    number = spark.createDataFrame([i for i in numbers.items() if i[1] in used_numbers], "token string, number long")
    name = spark.createDataFrame(names, f"query int, query_id {kind}")
    numbered = rows.join(F.broadcast(number), "token").drop("token").withColumnRenamed("number", "token")
    if not phrase:
        numbered = numbered.select("doc_id", "token", "units")
    best = best_in_tasks(numbered, asked, n, UNIT, (fixed.PHRASE_SLOP, fixed.PHRASE_BOOST) if phrase else None)
    scored = best.join(F.broadcast(name), "query").select("query_id", "doc_id", (F.col("units") / UNIT).alias("text_score"))
    return top_hits(scored, "text_score", n).drop("rank")


def candidates(
    queries: DataFrame,
    index: Index,
    synonyms: DataFrame,
    n: int = fixed.CANDIDATES,
    rows_per_slice: int = ROWS_PER_SLICE,
    most_near: int | None = None,
) -> DataFrame:
    """The best documents of each query by text score, without a second try."""
    tokens = query_tokens(queries)
    return best_documents(tokens, standard_clauses(tokens, index, synonyms, most_near), index, True, n, rows_per_slice)


def respelled_candidates(
    queries: DataFrame,
    index: Index,
    synonyms: DataFrame,
    n: int = fixed.CANDIDATES,
    rows_per_slice: int = ROWS_PER_SLICE,
    most_near: int | None = None,
) -> DataFrame:
    """The best documents when every token may be misspelt by up to two letters."""
    tokens = query_tokens(queries)
    return best_documents(tokens, spelling_clauses(tokens, index, synonyms, most_near), index, False, n, rows_per_slice)


def candidates_with_fallback(
    queries: DataFrame,
    index: Index,
    synonyms: DataFrame,
    n: int = fixed.CANDIDATES,
    rows_per_slice: int = ROWS_PER_SLICE,
    most_near: int | None = None,
) -> DataFrame:
    """Candidates, and for queries without a single one the respelled candidates.

    The first try is written down (at most ``n`` rows per query), so that asking which
    queries came out empty does not run it again.
    """
    spark = queries.sparkSession
    path = scratch_path(spark, "first-try")
    candidates(queries, index, synonyms, n, rows_per_slice, most_near).write.parquet(path)
    first = spark.read.parquet(path)
    empty = queries.join(first.select("query_id").distinct(), "query_id", "left_anti")
    second = respelled_candidates(empty, index, synonyms, n, rows_per_slice, most_near)
    return first.withColumn("did_you_mean", F.lit(False)).unionByName(second.withColumn("did_you_mean", F.lit(True)))


def rerank(found: DataFrame, docs: DataFrame, n: int = fixed.PAGE_SIZE) -> DataFrame:
    """The page of results: text score weighed by reviews and rating, with what is shown."""
    rating, reviews = F.coalesce("rating", F.lit(0.0)), F.coalesce("review_count", F.lit(0))
    popularity = 1 + F.when(reviews > 0, F.log10(reviews + 1)).otherwise(0.0)
    quality = F.when(rating > 0, rating / 5.0).otherwise(0.5)
    shown = found.join(docs, "doc_id").select(
        *[c for c in found.columns],
        F.coalesce(F.when(F.col("title") != "", F.col("title")), F.lit("Unknown")).alias("title"),
        F.coalesce("city", F.lit("N/A")).alias("city"),
        F.coalesce("url", F.lit("#")).alias("url"),
        "architect", "style",
        rating.alias("rating"), reviews.alias("reviews"),
        (F.col("text_score") * popularity * quality).alias("final_score"),
    )
    return top_hits(shown, "final_score", n)


def search(
    queries: DataFrame,
    index: Index,
    synonyms: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    most_near: int | None = None,
) -> DataFrame:
    """Ranked result pages of all queries (query_id, q).

    A fuzzy clause stands for all near terms, or for the ``most_near`` best ones if given.
    """
    synonyms = synonym_table(queries.sparkSession) if synonyms is None else synonyms
    found = candidates_with_fallback(queries, index, synonyms, rows_per_slice=rows_per_slice, most_near=most_near)
    return rerank(found, index.docs)
