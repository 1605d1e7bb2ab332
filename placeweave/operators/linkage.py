"""Linking activities to encyclopedia pages by place and shared tokens.

Every variant asks for "same place and something in common".  Joining on the place alone
would compare all rows of a large city with each other, so rows are dealt by place and the tokens of one
side are looked up in an index of the other (``shared``).  A pair sharing several tokens comes out once, with
their number, and pairs are not shuffled.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions import text as T
from placeweave.operators.order import ranked
from placeweave.operators.shared import pairs_in_place
from placeweave.operators.skew import ROWS_PER_SLICE, hot_counted, hot_keys, split_hot_join, split_hot_lookup
from placeweave.sources.scratch import scratch_path
from placeweave.sources.tables import evened

#: Pairs of rows that a task makes of pairs of classes, about; one pair of classes may stand for more.
PAIRS_PER_TASK, MOST_TASKS = 20_000_000, 10_000


class Linked(NamedTuple):
    """Links between classes of rows, which stand for the links of all their rows.

    ``pairs`` has c, w (digests of what the rows of a class share) and what is known of the pair (n_pairs: its pairs of rows);
    ``activities`` has a row's columns and its class c, ``pages`` likewise w.
    """

    pairs: DataFrame
    activities: DataFrame
    pages: DataFrame

    def rows(self) -> DataFrame:
        """Every pair of rows, with the columns of both."""
        return _members(self.pairs, self.activities, self.pages, ["c"], ["w"], "crawler_url", "wiki_url").drop("c", "w")

    def table(self) -> DataFrame:
        """The same links in one table that grows with the rows: ``kind`` tells pairs of classes (pair) from their members (activity, page)."""
        return _one_table(pair=self.pairs.drop("n_pairs"), activity=self.activities, page=self.pages)


class Linked2(NamedTuple):
    """Links by names or by texts: rows have a class of each sort, and each sort has its own pairs.

    ``names`` has c_names, w_names and overlap_name (1 at least), ``texts`` likewise overlap_desc. Rows are linked
    if their names are, or if their texts share two tokens.
    """

    names: DataFrame
    texts: DataFrame
    activities: DataFrame
    pages: DataFrame

    def rows(self) -> DataFrame:
        """Every pair of rows, with the columns of both."""
        names, texts = written(self.names), written(self.texts)
        # Both sorts meet in classes of rows with the same names and texts, and only then become rows.
        c, w = (rows.select(f"{side}_names", f"{side}_texts").distinct() for rows, side in ((self.activities, "c"), (self.pages, "w")))
        by_name = _members(names, c, w, ["c_names"], ["w_names"], "c_texts", "w_texts").join(texts, ["c_texts", "w_texts"], "left")
        by_text = _members(texts.where("overlap_desc >= 2"), c, w, ["c_texts"], ["w_texts"], "c_names", "w_names")
        by_text = by_text.join(names, ["c_names", "w_names"], "left_anti").withColumn("overlap_name", F.lit(0))
        both = by_name.withColumn("overlap_desc", F.coalesce("overlap_desc", F.lit(0))).unionByName(by_text)
        of_c, of_w = ["c_names", "c_texts"], ["w_names", "w_texts"]
        return _members(both, self.activities, self.pages, of_c, of_w, "crawler_url", "wiki_url").drop(*of_c, *of_w)

    def table(self) -> DataFrame:
        """The same links in one table that grows with the rows: pairs of classes (``kind`` is names or texts) and their members (activity, page)."""
        return _one_table(names=self.names, texts=self.texts, activity=self.activities, page=self.pages)


def _members(pairs: DataFrame, left: DataFrame, right: DataFrame, c: list[str], w: list[str], left_id: str, right_id: str) -> DataFrame:
    """Every pair of members (rows of ``left`` and ``right``) of ``pairs`` of classes, which are told by the columns ``c`` and ``w``.

    Few classes may stand for very many rows, so tasks are counted by the pairs of members they make, not by the
    bytes they read, and a class of the right side that makes too many is cut.
    """
    spark = pairs.sparkSession
    pairs = written(pairs, "class_pairs")
    n_left = pairs.join(left.groupBy(*c).agg(F.count("*").alias("_c")), c).groupBy(*w).agg(F.sum("_c").alias("_l"))
    counted = written(n_left.join(right.groupBy(*w).agg(F.count("*").alias("_r")), w), "counts")
    total = counted.agg(F.sum(F.col("_l").cast("double") * F.col("_r"))).first()[0] or 0
    tasks = min(max(math.ceil(total / PAIRS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_TASKS)
    half = pairs.join(left.repartition(tasks, *c), c)
    hot = hot_counted(counted, w, ROWS_PER_SLICE, PAIRS_PER_TASK)
    return split_hot_join(half, right, w, [*c, left_id], [right_id], left_hot=hot.select(*w, "_ln"), right_hot=hot.select(*w, "_rn"), tasks=tasks)


def _one_table(**kinds: DataFrame) -> DataFrame:
    tables = [table.select(F.lit(kind).alias("kind"), "*") for kind, table in kinds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _side(classes: DataFrame, number: str, place: str, tokens: str, also: Column | None = None, every: Column | None = None) -> DataFrame:
    """Classes as a side of ``pairs_in_place``."""
    also = F.lit(None).cast("array<string>") if also is None else also
    return evened(classes).select(
        F.col(number).alias("id"), F.col(place).alias("place"), F.col(f"n_{number}").alias("n"), F.col(tokens).alias("tokens"),
        also.alias("also"), (F.lit(False) if every is None else every).alias("every"),
    )


def _token_set(tokens: Column) -> Column:
    return F.array_sort(F.array_distinct(tokens))


def written(table: DataFrame, name: str = "pairs") -> DataFrame:
    """A written table, for steps that look at it more than once."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def attach(
    pairs: DataFrame, table: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE, row: str | None = None
) -> DataFrame:
    """Pairs with the columns of ``table`` for their ``key``; a page or activity may be in very many pairs.

    With ``row`` the table's rows are told apart by that column too, where urls repeat.
    """
    other = "crawler_url" if key == "wiki_url" else "wiki_url"
    keys = [key] if row is None else [key, row]
    hot = hot_keys(pairs.groupBy(*keys).count(), keys, rows_per_slice, "_ln")
    return split_hot_lookup(pairs, table, keys, [other], hot, "inner")


def _class_of(*content: Column) -> Column:
    """A digest of what the rows of a class share: keys and sorted tokens, none of which has a space or a bar in it."""
    return F.md5(F.concat_ws("|", *content))


def _joined(tokens: str) -> Column:
    return F.array_join(tokens, " ")


def _classes(rows: DataFrame, number: str, content: list[str]) -> DataFrame:
    """Rows with the same class ``number`` as one: their ``content`` and ``n_<number>``, how many they are.

    ``rows`` are written, so they are read and cut into tokens once, and counted before the shuffle however many a class has.
    """
    # min, not first: content is the same in all rows of a class
    classes = rows.groupBy(number).agg(*[F.min(c).alias(c) for c in content], F.count("*").alias(f"n_{number}"))
    return written(classes, "classes")


def _v1_sides(activities: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their keys, their tokens and their class; activities without a city have no key and are left out."""
    c = activities.withColumns({"_place": T.ascii_key(F.col("city")), "_tokens": _token_set(T.split_tokens(F.col("name")))})
    w = pages.withColumns({"_place": T.ascii_key(T.geo_parent_at(F.col("geo_parent"))), "_tokens": _token_set(T.split_tokens(F.col("title")))})
    of = _class_of(F.col("_place"), _joined("_tokens"))
    return c.where("_place IS NOT NULL").withColumn("_class", of), w.withColumn("_class", of)


def linked_v1(activities: DataFrame, pages: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> Linked:
    """Same ASCII city key and at least one shared token of name and title.

    Classes of rows with the same key and tokens are compared. Rows without a city have no key and are left out.
    """
    c, w = _v1_sides(activities, pages)
    c = c.select(
        F.col("url").alias("crawler_url"),
        F.col("name").alias("crawler_name"),
        "city",
        F.col("_place").alias("city_norm"),
        F.col("_tokens").alias("keys_c"),
        F.col("_class").alias("c"),
    )
    w = w.select(
        F.col("title").alias("wiki_title"),
        F.col("url").alias("wiki_url"),
        F.col("type").alias("wiki_type"),
        F.col("_place").alias("city_norm"),
        F.col("_tokens").alias("keys_w"),
        F.col("_class").alias("w"),
    )
    c, w = written(c, "rows"), written(w, "rows")
    c_classes, w_classes = _classes(c, "c", ["city_norm", "keys_c"]), _classes(w, "w", ["city_norm", "keys_w"])
    pairs = pairs_in_place(_side(c_classes, "c", "city_norm", "keys_c"), _side(w_classes, "w", "city_norm", "keys_w"), rows_per_slice)
    pairs = pairs.select(F.col("left").alias("c"), F.col("right").alias("w"), F.col("shared").alias("overlap"))
    return Linked(pairs, c.drop("city_norm", "keys_c"), w.drop("city_norm", "keys_w"))


def link_v1(activities: DataFrame, pages: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The pairs of rows that ``linked_v1`` stands for."""
    return linked_v1(activities, pages, rows_per_slice).rows().select(
        "crawler_url", "crawler_name", "city", "wiki_title", "wiki_url", "wiki_type", "overlap"
    )


def linked_v2(activities: DataFrame, pages: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> Linked2:
    """City key equal to the page's key or to one of its candidate keys, and at least one shared
    name token or two shared description tokens.

    Names and texts are compared on their own, as classes of rows with the same keys and names, and of rows with
    the same keys and texts: of either there are far fewer than of both together. Texts are long, so only
    classes travel through the join and shared tokens are counted. Rows count, not urls.
    """
    c = activities.select(
        F.col("url").alias("crawler_url"),
        F.col("name").alias("crawler_name"),
        "city",
        F.array(T.ascii_key(F.col("city"))).alias("keys"),
        _token_set(T.split_tokens(F.col("name"))).alias("names"),
        _token_set(T.split_tokens(T.description_text(F.col("description"), F.col("highlights")))).alias("texts"),
    ).where("keys[0] IS NOT NULL")
    w = pages.select(
        F.col("url").alias("wiki_url"),
        F.col("title").alias("wiki_title"),
        F.col("type").alias("wiki_type"),
        F.array_sort(F.array_union(
            F.array(T.ascii_key(T.geo_parent_at(F.col("geo_parent")))),
            T.candidate_keys(F.col("geo_parent")),
        )).alias("keys"),
        _token_set(T.split_tokens(F.col("title"))).alias("names"),
        _token_set(T.split_tokens(F.col("abstract"))).alias("texts"),
    )

    def classified(rows: DataFrame, side: str) -> DataFrame:
        return written(rows.withColumns({f"{side}_{sort}": _class_of(_joined("keys"), _joined(sort)) for sort in ("names", "texts")}), "rows")

    def side(rows: DataFrame, number: str, sort: str) -> DataFrame:
        # an activity has one key, so no pair meets in two places
        return _side(_classes(rows, number, ["keys", sort]).withColumn("city_norm", F.explode("keys")), number, "city_norm", sort)

    c, w = classified(c, "c"), classified(w, "w")

    def pairs(sort: str, overlap: str) -> DataFrame:
        shared = pairs_in_place(side(c, f"c_{sort}", sort), side(w, f"w_{sort}", sort), rows_per_slice)
        return shared.select(F.col("left").alias(f"c_{sort}"), F.col("right").alias(f"w_{sort}"), F.col("shared").alias(overlap))

    content = ["keys", "names", "texts"]
    return Linked2(pairs("names", "overlap_name"), pairs("texts", "overlap_desc"), c.drop(*content), w.drop(*content))


def link_v2(activities: DataFrame, pages: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The pairs of rows that ``linked_v2`` stands for."""
    return linked_v2(activities, pages, rows_per_slice).rows().select(
        "crawler_url", "crawler_name", "city", "wiki_title", "wiki_url", "wiki_type", "overlap_name", "overlap_desc"
    )


def linked_v3(
    activities: DataFrame,
    pages: DataFrame,
    stop_words: list[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> Linked:
    """Same Unicode city key and a shared title token, a shared geo token, or the city's own page.

    ``activities`` should carry the backfilled city in ``city``. Rows with the same key and tokens are a class.
    """
    c = (
        activities.select(
            F.col("url").alias("crawler_url"),
            F.col("name").alias("crawler_name"),
            "city",
            T.unicode_key(F.col("city")).alias("city_norm"),
        )
        .where("city_norm <> ''")
        .withColumn("tokens_c_debug", T.filtered_tokens(F.col("crawler_name"), F.col("city_norm"), stop_words))
        .withColumns({"tokens_c": _token_set(F.col("tokens_c_debug")), "city_norm_debug": F.col("city_norm")})
    )
    w = (
        pages.select(
            F.col("title").alias("wiki_title"),
            F.col("url").alias("wiki_url"),
            F.col("type").alias("wiki_type"),
            T.unicode_key(T.geo_parent_at(F.col("geo_parent"))).alias("city_norm"),
            T.unicode_key(F.col("title")).alias("title_norm"),
            # an empty key meets no token
            _token_set(F.filter(F.coalesce(T.ascii_keys(F.col("geo_parent")), T.empty_strings()), lambda k: k != "")).alias("geo_tokens"),
        )
        .where("city_norm <> ''")
        .withColumn("tokens_w", _token_set(T.filtered_tokens(F.col("wiki_title"), F.col("city_norm"), stop_words)))
        .withColumn("own_page", F.coalesce(F.col("city_norm") == F.col("title_norm"), F.lit(False)))
        .drop("title_norm")
    )
    c = written(c.withColumn("c", _class_of(F.col("city_norm"), _joined("tokens_c"))), "rows")
    w = written(w.withColumn("w", _class_of(F.col("city_norm"), _joined("geo_tokens"), _joined("tokens_w"), F.col("own_page").cast("string"))), "rows")
    c_classes, w_classes = _classes(c, "c", ["city_norm", "tokens_c"]), _classes(w, "w", ["city_norm", "geo_tokens", "tokens_w", "own_page"])
    # A city page meets every activity of its city.
    right = _side(w_classes, "w", "city_norm", "tokens_w", F.col("geo_tokens"), F.col("own_page"))
    pairs = pairs_in_place(_side(c_classes, "c", "city_norm", "tokens_c"), right, rows_per_slice).select(
        F.col("left").alias("c"), F.col("right").alias("w"), (F.col("n_left") * F.col("n_right")).alias("n_pairs"),
        F.col("shared").alias("overlap_score"), F.when(F.col("by_token"), "landmark").otherwise("city_page").alias("match_type"),
    )
    return Linked(pairs, c.drop("city_norm", "tokens_c"), w.drop("city_norm", "geo_tokens", "tokens_w", "own_page"))


V3_COLUMNS = [
    "crawler_url", "crawler_name", "city", "wiki_title", "wiki_url", "wiki_type", "overlap_score", "match_type",
    "tokens_c_debug", "city_norm_debug",
]


def link_v3(
    activities: DataFrame,
    pages: DataFrame,
    stop_words: list[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The pairs of rows that ``linked_v3`` stands for."""
    return linked_v3(activities, pages, stop_words, rows_per_slice).rows().select(*V3_COLUMNS)


def _preference() -> list[Column]:
    """Orders the matches of an activity: landmarks first, then score, then page url."""
    return [
        (F.col("match_type") != "landmark").alias("fallback"),
        (-F.col("overlap_score")).alias("minus_score"),
        F.col("wiki_url"),
    ]


def best_match(pairs: DataFrame) -> DataFrame:
    """One row per activity url: a landmark if there is one, the city page only as a fallback.

    ``n_matches`` counts pages; a page that several rows of the activity or page are linked by counts once.
    """
    pages = pairs.groupBy("crawler_url", "wiki_url").agg(F.min(F.struct(*_preference())).alias("best"))
    best = pages.groupBy("crawler_url").agg(F.min("best").alias("best"), F.count("*").alias("n_matches"))
    return best.select(
        "crawler_url",
        F.col("best.wiki_url").alias("wiki_url"),
        F.when(F.col("best.fallback"), "city_page").otherwise("landmark").alias("match_type"),
        (-F.col("best.minus_score")).alias("overlap_score"),
        "n_matches",
    )


def _with_groups(rows: DataFrame, number: str, url: str, group: str) -> tuple[DataFrame, DataFrame]:
    """Urls whose rows lie in the same classes, equally often, as one group: (``url``, ``group``), and (``group``, ``number``, ``n`` rows in it)."""
    counted = rows.groupBy(url, number).agg(F.count("*").alias("n"))
    # A digest of a set of any size, made before the shuffle; a list of it might be long where a url is null.
    digest = [F.bit_xor(F.xxhash64(number, "n", F.lit(salt))) for salt in (1, 2)]
    owners = written(counted.groupBy(url).agg(F.concat(*[F.lpad(F.hex(d), 16, "0") for d in digest]).alias(group)), "owners")
    of = counted.join(owners.withColumnRenamed(url, "_url"), F.col(url).eqNullSafe(F.col("_url")))
    return owners, written(of.select(group, number, "n").distinct(), "groups")


def activity_groups(linked: Linked) -> tuple[DataFrame, DataFrame]:
    """Pairs of one activity of each group, and the group of each activity (crawler_url, group).

    Activities whose rows lie in the same classes have the same matches. In the pairs, which are like those of
    ``rows``, crawler_url is the group, which stands for any of its activities.
    """
    owners, groups = _with_groups(linked.activities, "c", "crawler_url", "group")
    pairs = groups.join(linked.pairs, "c").join(linked.pages, "w")
    pairs = pairs.withColumn("_row", F.explode(F.sequence(F.lit(1), "n")))  # an activity has all matches of each of its rows
    return pairs.withColumnRenamed("group", "crawler_url").drop("c", "w", "n", "_row", "n_pairs"), owners


def of_activities(found: DataFrame, owners: DataFrame, url: str = "crawler_url") -> DataFrame:
    """What was ``found`` for each group (in ``url``), for each of its activities."""
    return found.withColumnRenamed(url, "group").join(owners.withColumnRenamed("crawler_url", url), "group").drop("group")


def best_of_classes(linked: Linked) -> DataFrame:
    """``best_match`` of the rows that ``linked`` stands for, without building their pairs.

    Groups of activities are compared with groups of pages: a group's best page is the best of their
    first urls, and its matches add up over their numbers of urls.
    """
    pairs = written(linked.pairs, "class_pairs")
    owners, groups = _with_groups(linked.activities, "c", "crawler_url", "group")
    page_owners, page_groups = _with_groups(linked.pages, "w", "wiki_url", "page_group")
    # a struct, since a url may be null, which min of the url itself would pass over
    sizes = page_owners.groupBy("page_group").agg(F.min(F.struct("wiki_url")).alias("first"), F.count("*").alias("n_urls"))
    rank = F.struct((F.col("match_type") != "landmark").alias("fallback"), (-F.col("overlap_score")).alias("minus_score"))
    hits = groups.drop("n").join(pairs, "c").join(page_groups.drop("n"), "w").groupBy("group", "page_group").agg(F.min(rank).alias("rank"))
    order = F.struct("rank.fallback", "rank.minus_score", "first.wiki_url")
    best = hits.join(sizes, "page_group").groupBy("group").agg(F.min(order).alias("best"), F.sum("n_urls").alias("n_matches"))
    return best.join(owners, "group").select(
        "crawler_url",
        F.col("best.wiki_url").alias("wiki_url"),
        F.when(F.col("best.fallback"), "city_page").otherwise("landmark").alias("match_type"),
        (-F.col("best.minus_score")).alias("overlap_score"),
        "n_matches",
    )


def with_primary(linked: Linked) -> Linked:
    """Linked activities with ``primary_url``, the url of their best match (the same for all rows of an activity, where rows repeat)."""
    linked = linked._replace(pairs=written(linked.pairs, "class_pairs"))
    best = best_of_classes(linked).select(F.col("crawler_url").alias("best_of"), F.col("wiki_url").alias("primary_url"))
    # The best page goes with the activity's row, so pairs are neither written nor joined again.
    return linked._replace(activities=linked.activities.join(best, F.col("crawler_url").eqNullSafe(F.col("best_of"))).drop("best_of"))


def flag_primary(linked: Linked) -> DataFrame:
    """All pairs of rows, with ``is_primary`` marking the best match of each activity (all its rows, where rows repeat)."""
    pairs = with_primary(linked).rows()
    return pairs.withColumn("is_primary", F.col("primary_url").eqNullSafe(F.col("wiki_url"))).drop("primary_url")


def match_details(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """Pairs with the page fields that search needs, one row per pair."""
    facts = pages.select(
        F.col("url").alias("wiki_url"),
        F.col("abstract").alias("wiki_abstract"),
        F.col("fields.architect").alias("wiki_architect"),
        F.col("fields.style").alias("wiki_style"),
    )
    return attach(pairs, facts, "wiki_url")


MATCH_FIELDS = ["wiki_title", "wiki_type", "wiki_abstract", "wiki_architect", "wiki_style"]


def ranked_matches(details: DataFrame) -> DataFrame:
    """The matches of each activity, one row each: url, rank (1 is the best), MATCH_FIELDS.

    This is the form for any number of matches; ``nest_matches`` and ``match_facts`` are made of it.
    """
    rows = details.select(F.col("crawler_url").alias("url"), *_preference(), F.struct(*MATCH_FIELDS).alias("match"))
    order = ["fallback", "minus_score", "wiki_url", "match"]  # the last one for pages whose rows repeat
    return ranked(rows, "url", order, "rank").select("url", "rank", "match.*")


def match_facts(matches: DataFrame) -> DataFrame:
    """Per activity url: its best match, and the first architect, style and city title that any has, best first."""
    match = F.struct(*MATCH_FIELDS)

    def first(value: Column, wanted: Column) -> Column:
        return F.min_by(F.when(wanted, value), F.when(wanted, F.col("rank")))

    return matches.groupBy("url").agg(
        F.min_by(match, "rank").alias("primary_match"),
        first(F.col("wiki_architect"), F.col("wiki_architect") != "").alias("first_architect"),
        first(F.col("wiki_style"), F.col("wiki_style") != "").alias("first_style"),
        first(F.col("wiki_title"), F.col("wiki_type") == "city").alias("first_city"),
    )


def nest_matches(matches: DataFrame) -> DataFrame:
    """A view with one row per activity: ``match_facts`` and all matches in one array, best first."""
    match = F.struct("rank", F.struct(*MATCH_FIELDS).alias("match"))
    arrays = matches.groupBy("url").agg(F.sort_array(F.collect_list(match)).alias("rows"))
    return match_facts(matches).join(arrays, "url").select(
        "url", "primary_match", "first_architect", "first_style", "first_city", F.transform("rows", lambda r: r["match"]).alias("matches")
    )


def prefixed(left: DataFrame, right: DataFrame, left_prefix: str = "crawler_", right_prefix: str = "wiki_"):
    """Both inputs with every column prefixed, ready to be joined without name clashes."""
    return (
        left.select([F.col(c).alias(left_prefix + c) for c in left.columns]),
        right.select([F.col(c).alias(right_prefix + c) for c in right.columns]),
    )


def widen(linked: Linked, activities: DataFrame, pages: DataFrame) -> Linked:
    """The links of ``linked_v1``, whose members have all columns of their side, prefixed; urls may repeat."""
    c, w = _v1_sides(activities, pages)
    c, w = (rows.drop("_place", "_tokens") for rows in (c, w))
    a, p = prefixed(c, w)
    return linked._replace(
        activities=written(a.withColumnRenamed("crawler__class", "c"), "rows"), pages=written(p.withColumnRenamed("wiki__class", "w"), "rows")
    )


def union_pages(landmarks: DataFrame, cities: DataFrame | None) -> DataFrame:
    """Landmark pages plus, when there are any, city pages; missing columns become null."""
    return landmarks if cities is None else landmarks.unionByName(cities, allowMissingColumns=True)
