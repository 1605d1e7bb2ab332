from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import texts
from checks.registry import query
from placeweave.functions import html as H
from placeweave.operators import listing

HOST = "https://www.example.com"
WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(12288)"


def strip_sql(c: str) -> str:
    return f"trim({c}, {WHITE})"


def tags_sql(c: str) -> str:
    return strip_sql(f"regexp_replace({c}, '<[^>]+>', '', 'g')")


def pages(spark, sf):
    return texts(spark, sf, "pages")


# ---- whole pages as they are


@query(f"SELECT page_id, md5({tags_sql('html')}) AS text FROM pages")
def strip_tags(spark, sf):
    return pages(spark, sf).select("page_id", F.md5(H.strip_tags(F.col("html"))).alias("text"))


@query(
    f"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)href="([^"]+)"', 1)) AS href FROM pages)
    SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href ELSE concat('{HOST}', href) END AS url FROM l"""
)
def abs_url(spark, sf):
    links = pages(spark, sf).select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?i)href="([^"]+)"'), F.lit(1))).alias("href"))
    return links.withColumn("url", H.absolute_url(F.col("href"), HOST))


@query(
    f"""WITH l AS (SELECT page_id, list_filter(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), lambda i: {strip_sql('i')} <> '') AS items FROM pages)
    SELECT page_id, CASE WHEN length(items) > 0 THEN array_to_string(list_transform(items, lambda i: {tags_sql('i')}), '|') END AS items FROM l"""
)
def html_list_items(spark, sf):
    return pages(spark, sf).select("page_id", F.array_join(H.list_items(F.col("html")), "|").alias("items"))


@query(
    f"""SELECT page_id, {tags_sql("nullif(regexp_extract(replace(html, chr(10), ' '), '<h1[^>]*>(.*?)</h1>', 1), '')")} AS title FROM pages"""
)
def html_title(spark, sf):
    return listing.detail_records(pages(spark, sf).withColumn("url", F.col("page_id").cast("string"))).select(
        F.col("url").cast("bigint").alias("page_id"), "title"
    )


# ---- pages with destinations, cards and details put in; what they say is known from the table

LANGS = "split_part(split_part(html, 'lang=\"', 2), '\"', 1)"


def lang(c="html"):
    return F.split_part(F.split_part(c, F.lit('lang="'), F.lit(2)), F.lit('"'), F.lit(1))


def number():
    return F.col("page_id").cast("string")


def concat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def homes(spark, sf):
    return pages(spark, sf).select(
        "page_id",
        concat(
            "Top countries to visit ", F.col("html"), ' <h2>Top Destinations</h2>\n<a class="x" href="/city-l', number(),
            '/"><img>\n<div class="title">New <i>', lang(), "</i> ", number(), ' </div></a><a href="/paris-l1/"><div id="t" class="title">Paris</div></a>',
            '<a href="/about/"><div class="title">About</div></a><a href="/last-l', number(), '/" id="y"><div class="title">', lang(),
            "</div></a> top countries to visit ", F.col("html"),
        ).alias("html"),
    )


@query(
    f"""SELECT page_id, concat('new_', {LANGS}, '_', page_id) AS city_name, concat('{HOST}/city-l', page_id, '/') AS url FROM pages
    UNION ALL SELECT page_id, 'paris', '{HOST}/paris-l1/' FROM pages
    UNION ALL SELECT page_id, {LANGS}, concat('{HOST}/last-l', page_id, '/') FROM pages"""
)
def destination_links(spark, sf):
    return listing.destination_links(homes(spark, sf), HOST)


@query(f"SELECT page_id, concat('new_', {LANGS}, '_', page_id) AS city_name, concat('{HOST}/city-l', page_id, '/') AS url FROM pages")
def destinations_without(spark, sf):
    """The skip list as a table: languages are no destinations, and neither is Paris."""
    found = listing.destination_links(homes(spark, sf), HOST)
    skip = pages(spark, sf).select(lang().alias("city_name")).distinct().union(spark.createDataFrame([("paris",)], "city_name string"))
    return listing.without_skipped(found, skip).select("page_id", "city_name", "url")


def listings(spark, sf):
    """French pages mark cards by class, the others by test id."""
    mark = F.when(lang() == "fr", 'class="big vertical-activity-card__container x"').otherwise('class="vertical-activity-card__container" data-test-id="vertical-activity-card-link"')
    return pages(spark, sf).select(
        "page_id",
        concat(
            F.col("html"), "<a ", mark, ' href="/x-t', number(), '/">\n<h3 class="t"><!--[-->Visit <b>', number(),
            '</b><!--]-->\n</h3><span class="c-activity-rating__rating">4.', (F.col("page_id") % 10).cast("string"),
            '</span><span class="c-activity-rating__label">(1,', number(), ')</span><div class="activity-price x"><span>From</span><b>€ ', number(),
            "</b> <i>per person</i></div></a>between", "<a ", mark, ' href="https://other.example/', number(), '"><h3>Plain</h3></a>',
        ).alias("html"),
    )


CARDS_SQL = f"""
cards AS (SELECT page_id, 0 AS pos, concat('{HOST}/x-t', page_id, '/') AS url, concat('Visit ', page_id) AS title, concat('4.', page_id % 10) AS rating,
  concat('1', page_id) AS reviews, concat('From € ', page_id, ' per person') AS price FROM pages
  UNION ALL SELECT page_id, 1, concat('https://other.example/', page_id), 'Plain', NULL, NULL, NULL FROM pages)"""


@query(f"WITH {CARDS_SQL} SELECT page_id, pos::INT AS pos, url, title, rating, reviews, price FROM cards")
def listing_cards(spark, sf):
    return listing.listing_cards(listings(spark, sf), HOST)


def detail_pages(spark, sf):
    block = concat(
        '{"@context":"x",\n"@type" : "', F.when(lang() == "fr", "Event").otherwise("Product"), '","name":"Trip ', number(),
        '","description":"About ', number(), '","aggregateRating":{"ratingValue":4.5,"reviewCount":', number(),
        '},"offers":{"price":"', number(), '.50","priceCurrency":"EUR"}}',
    )
    return pages(spark, sf).select(
        concat(HOST, "/x-t", number(), "/").alias("url"),
        concat(
            F.regexp_replace("html", "(?s)<h1[^>]*>.*?</h1>", F.lit("")), "<h1 id='a'>The <b>", number(),
            '</b> \n</h1><script type="application/ld+json">{"@type":"Organization","name":"No"}</script><script async type="application/ld+json">',
            block, '</script><div class="h" id="highlights-point"><p>\n</p><ul class="u"><li>One <b>', number(),
            '</b></li><li> </li>\n<li>Two</li></ul></div><p class="review-highlight-card__text--v2  review-highlight-card__text"><!--[--><span>Good ',
            number(), '</span></p><p class="review-highlight-card__text--v2 review-highlight-card__text"><span> <b></b></span></p>',
            '<p class="review-highlight-card__text--v2 review-highlight-card__text"><span>Third</span></p>',
        ).alias("html"),
    )


DETAILS_SQL = f"""
details AS (SELECT concat('{HOST}/x-t', page_id, '/') AS url, concat('The ', page_id) AS title, {LANGS} <> 'fr' AS ld, page_id,
  concat('One ', page_id, '|Two') AS highlights, concat('Good ', page_id) AS featured_reviews FROM pages),
d AS (SELECT url, title, CASE WHEN ld THEN 'Product' END AS ld_type, CASE WHEN ld THEN concat('Trip ', page_id) END AS name,
  CASE WHEN ld THEN concat('About ', page_id) END AS description, CASE WHEN ld THEN 4.5::DOUBLE END AS rating,
  CASE WHEN ld THEN page_id END AS "reviewCount", CASE WHEN ld THEN concat(page_id, '.50') END AS price, CASE WHEN ld THEN 'EUR' END AS currency,
  highlights, featured_reviews FROM details)"""


def flat(df):
    return df.withColumns({c: F.array_join(c, "|") for c in ("highlights", "featured_reviews")})


@query(f"WITH {DETAILS_SQL} SELECT * FROM d")
def json_ld(spark, sf):
    """Detail records: headline, first product block, highlights, reviews."""
    return flat(listing.detail_records(detail_pages(spark, sf)))


@query(
    f"""WITH {DETAILS_SQL} SELECT url, ld_type, name, rating::VARCHAR AS rating, "reviewCount"::VARCHAR AS reviews, price, currency FROM d"""
)
def json_ld_strict(spark, sf):
    """The product block parsed as JSON."""
    p = detail_pages(spark, sf).select("url", H.product_json(H.one_line(F.col("html"))).alias("p"))
    return p.select(
        "url", F.col("p.@type").alias("ld_type"), "p.name", "p.aggregateRating.ratingValue", "p.aggregateRating.reviewCount",
        "p.offers.price", F.col("p.offers.priceCurrency").alias("currency"),
    ).withColumnsRenamed({"ratingValue": "rating", "reviewCount": "reviews"})


@query(
    f"""WITH {CARDS_SQL}, {DETAILS_SQL} SELECT c.url, coalesce(d.title, c.title) AS title, d.name, d.description, d.ld_type,
    coalesce(d.rating, c.rating::DOUBLE) AS rating, c.reviews::BIGINT AS reviews, d."reviewCount", coalesce(d.price, c.price) AS price, d.currency,
    d.highlights, d.featured_reviews FROM cards c LEFT JOIN d USING (url)"""
)
def overlay(spark, sf):
    cards = listing.listing_cards(listings(spark, sf), HOST)
    return flat(listing.overlay(cards, listing.detail_records(detail_pages(spark, sf))))
