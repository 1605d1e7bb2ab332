from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import texts
from checks.registry import query
from placeweave import fixed
from placeweave.functions import markup as M
from placeweave.functions import text as T
from placeweave.operators import wiki
from placeweave.sources import wiki_xml
from placeweave.sources.files import good_records, read_jsonl
from placeweave.sources.schemas import WIKI_PAGE
from placeweave.sources.scratch import scratch_path
from placeweave.streaming.ingest import extract_new_chunks

# ---- pages: every text becomes a page with an infobox in front and categories behind.
# Some sources make special pages: src0 redirects, src1 no category, src2 an infobox that
# never closes, src3 one of no interest, src4 no location, src5 a city.

KIND_SQL = "CASE source WHEN 'src3' THEN 'parking lot' WHEN 'src5' THEN 'city' ELSE 'museum' END"
WIKITEXT_SQL = f"""
wikitext AS (SELECT doc_id, lang, source, text AS body, split_part(text, chr(10), 1) AS title,
  concat(CASE source WHEN 'src0' THEN '#redirect [[Elsewhere]] ' ELSE '' END,
  '{{{{Infobox ', {KIND_SQL}, ' | inline = no', chr(10), '| name = ', source, ' {{{{nested|{{{{deep|x}}}}}}}}', chr(10),
  CASE source WHEN 'src4' THEN '' ELSE concat('| location = [[', lang, '|', upper(lang), ' land]], ', source,
    '<ref name="a">x | location = wrong', chr(10), '</ref>', chr(10)) END,
  '| opened = {{{{Start date|', 1900 + doc_id % 100, '|', 1 + doc_id % 12, '|', 1 + doc_id % 28, '|df=y}}}}', chr(10),
  '| coordinates = {{{{coord|', doc_id, '|2}}}}', chr(10), '| architect = first', chr(10), ' continued', chr(10),
  ' | Architect = Ann &amp; ''''Bob'''' ', doc_id, '<!-- no', chr(10), '| height = 1 -->', chr(10), '| style =', chr(10),
  '| architectural_style = Style', chr(10), 'of [http://x.y ', lang, ']', chr(10), '| height = ', doc_id, ' m = high', chr(10),
  CASE source WHEN 'src2' THEN '' ELSE '}}}}' END, chr(10), chr(10), '''''''Short''''''', chr(10), chr(10),
  '== Head ==', chr(10), '[[File:a.png|thumb|See [[that]]]]''''Caf&eacute;'''' ', text, ' {{{{cite|{{{{x}}}}}}}} [[Target|label]] [http://only.link]', chr(10), chr(10),
  CASE WHEN source = 'src1' THEN '' ELSE CASE lang WHEN 'en' THEN '[[Category:Museums in Old London|key]]' WHEN 'fr' THEN '[[category: Parks of Paris ]]'
    WHEN 'de' THEN '[[Category:In Berlin]] [[Category:List of Bridges]]' ELSE '[[Category:Things]]' END END) AS text
  FROM documents)"""

CATEGORIES_SQL = """CASE WHEN source = 'src1' THEN []::VARCHAR[] WHEN lang = 'en' THEN ['Museums in Old London'] WHEN lang = 'fr' THEN ['Parks of Paris']
  WHEN lang = 'de' THEN ['In Berlin', 'List of Bridges'] ELSE ['Things'] END"""


def clean_sql(c: str) -> str:
    def without(pattern: str, by: str = "") -> None:
        nonlocal c
        c = f"regexp_replace({c}, '{pattern.replace(chr(39), chr(39) * 2)}', '{by}', 'g')"

    without("&eacute;", "é")
    for pattern in (fixed.COMMENT, fixed.FILE_LINK, fixed.QUOTE_RUN, *[fixed.TEMPLATE] * 5, fixed.TABLE):
        without(pattern)
    without(fixed.WIKILINK, r"\1")
    without(fixed.LABELLED_LINK, r"\1")
    without(fixed.BARE_LINK)
    without(fixed.HEADING)
    without(r"\s+", " ")
    return f"trim({c})"


ABSTRACT_SQL = f"""
paragraphs AS (SELECT doc_id, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS l FROM wikitext)),
cleaned AS (SELECT doc_id, i, {clean_sql('p')} AS c FROM paragraphs WHERE NOT starts_with(p, '{{{{') AND NOT starts_with(p, '|')),
abstracts AS (SELECT doc_id, arg_min(c, i) AS abstract FROM cleaned WHERE length(c) > 50 GROUP BY doc_id)"""

# What an infobox says is known without reading it.
HAS_BOX = "source NOT IN ('src2', 'src3')"
FIELDS_SQL = f"""
fields AS (SELECT doc_id, lang, source,
  CASE WHEN {HAS_BOX} AND source <> 'src4' THEN concat(upper(lang), ' land, ', source) END AS location,
  CASE WHEN {HAS_BOX} THEN concat('{{{{coord|', doc_id, '|2}}}}') END AS coordinates,
  CASE WHEN {HAS_BOX} THEN concat(1900 + doc_id % 100, '-', lpad((1 + doc_id % 12)::VARCHAR, 2, '0'), '-', lpad((1 + doc_id % 28)::VARCHAR, 2, '0')) END AS built,
  CASE WHEN {HAS_BOX} THEN concat('Ann & Bob ', doc_id) END AS architect,
  CASE WHEN {HAS_BOX} THEN concat('Style of ', lang) END AS style,
  CASE WHEN {HAS_BOX} THEN concat(doc_id, ' m = high') END AS height
  FROM documents)"""


def wikitext(spark, sf):
    doc, source, lang = F.col("doc_id"), F.col("source"), F.col("lang")
    number = doc.cast("string")
    return texts(spark, sf).select(
        "doc_id", "lang", "source",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.concat(
            F.when(source == "src0", "#redirect [[Elsewhere]] ").otherwise(""),
            F.lit("{{Infobox "), F.when(source == "src3", "parking lot").when(source == "src5", "city").otherwise("museum"),
            F.lit(" | inline = no\n| name = "), source, F.lit(" {{nested|{{deep|x}}}}\n"),
            F.when(source == "src4", "").otherwise(
                F.concat(F.lit("| location = [["), lang, F.lit("|"), F.upper(lang), F.lit(" land]], "), source,
                         F.lit('<ref name="a">x | location = wrong\n</ref>\n'))
            ),
            F.lit("| opened = {{Start date|"), (1900 + doc % 100).cast("string"), F.lit("|"), (1 + doc % 12).cast("string"),
            F.lit("|"), (1 + doc % 28).cast("string"), F.lit("|df=y}}\n| coordinates = {{coord|"), number,
            F.lit("|2}}\n| architect = first\n continued\n | Architect = Ann &amp; ''Bob'' "), number,
            F.lit("<!-- no\n| height = 1 -->\n| style =\n| architectural_style = Style\nof [http://x.y "), lang,
            F.lit("]\n| height = "), number, F.lit(" m = high\n"),
            F.when(source == "src2", "").otherwise("}}"),
            F.lit("\n\n'''Short'''\n\n== Head ==\n[[File:a.png|thumb|See [[that]]]]''Caf&eacute;'' "), F.col("text"),
            F.lit(" {{cite|{{x}}}} [[Target|label]] [http://only.link]\n\n"),
            F.when(source == "src1", "").when(lang == "en", "[[Category:Museums in Old London|key]]")
            .when(lang == "fr", "[[category: Parks of Paris ]]").when(lang == "de", "[[Category:In Berlin]] [[Category:List of Bridges]]")
            .otherwise("[[Category:Things]]"),
        ).alias("text"),
    )


@query(f"WITH {WIKITEXT_SQL} SELECT doc_id, array_to_string({CATEGORIES_SQL}, '|') AS categories FROM wikitext")
def wiki_categories(spark, sf):
    return wikitext(spark, sf).select("doc_id", F.array_join(M.categories(F.col("text")), "|").alias("categories"))


@query(
    f"""WITH {WIKITEXT_SQL} SELECT doc_id, CASE WHEN {HAS_BOX} THEN md5(substr(text, strpos(text, '{{{{Infobox'),
    strpos(text, concat('m = high', chr(10), '}}}}')) + length('m = high') + 3 - strpos(text, '{{{{Infobox'))) END AS box FROM wikitext"""
)
def wiki_infobox(spark, sf):
    return wikitext(spark, sf).select("doc_id", F.md5(M.infobox(F.col("text"))).alias("box"))


@query(f"WITH {FIELDS_SQL} SELECT * EXCLUDE (lang, source), NULL::VARCHAR AS country FROM fields")
def wiki_fields(spark, sf):
    fields = M.record_fields(M.infobox_entries(M.infobox(F.col("text"))))
    return wikitext(spark, sf).select("doc_id", fields.alias("f")).select("doc_id", "f.*")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN NULL WHEN lang = 'de' THEN concat('New ', source) ELSE upper(lang) END AS country,
    CASE WHEN doc_id % 2 = 0 THEN concat('at ', source) END AS location FROM documents"""
)
def wiki_country(spark, sf):
    """The country of an infobox: linked, plain, empty, and given twice."""
    boxes = texts(spark, sf).select("doc_id", F.concat(
        F.lit("{{Infobox museum\n| Country = "),
        F.when(F.col("doc_id") % 3 == 2, "").when(F.col("lang") == "de", F.concat(F.lit("old\n| country = [[Land of "), "source", F.lit("|New "), "source", F.lit("]]"))).otherwise(F.upper("lang")),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\n| location = at "), "source")).otherwise(""),
        F.lit("\n}}\n"), "text",
    ).alias("text"))
    fields = M.record_fields(M.infobox_entries(M.infobox(F.col("text"))))
    return boxes.select("doc_id", fields.alias("f")).select("doc_id", "f.country", "f.location")


@query(
    f"""SELECT doc_id, 'architect=Ann & Bob ' || doc_id || ';architectural_style=Style of ' || lang || ';coordinates=;height=' || doc_id ||
    ' m = high' || CASE source WHEN 'src4' THEN '' ELSE ';location=' || upper(lang) || ' land, ' || source END || ';name=' || source || ';opened=' ||
    concat(1900 + doc_id % 100, '-', lpad((1 + doc_id % 12)::VARCHAR, 2, '0'), '-', lpad((1 + doc_id % 28)::VARCHAR, 2, '0')) || ';style=' AS entries
    FROM documents WHERE {HAS_BOX}"""
)
def wiki_entry_map(spark, sf):
    """The infobox as an open map, keys in order."""
    boxed = wikitext(spark, sf).select("doc_id", M.infobox_entries(M.infobox(F.col("text"))).alias("e")).where("e IS NOT NULL")
    pairs = F.array_sort(F.map_entries(M.entry_map(F.col("e"))))
    return boxed.select("doc_id", F.array_join(F.transform(pairs, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("entries"))


@query(f"WITH {WIKITEXT_SQL}, {ABSTRACT_SQL} SELECT w.doc_id, md5(abstract) AS abstract FROM wikitext w LEFT JOIN abstracts a ON a.doc_id = w.doc_id")
def wiki_abstract(spark, sf):
    return wikitext(spark, sf).select("doc_id", F.md5(M.abstract(F.col("text"))).alias("abstract"))


TITLE_SQL = "trim(regexp_replace(replace(lower(strip_accents(title)), '_', ' '), '[^a-z0-9 ]', '', 'g'))"
TITLE_TOKENS_SQL = "array_to_string(regexp_extract_all(lower(strip_accents(title)), '[a-z]{{2,}}'), ' ')".replace("{{", "{").replace("}}", "}")


@query(f"WITH {WIKITEXT_SQL} SELECT doc_id, {TITLE_SQL} AS normalized, {TITLE_TOKENS_SQL} AS tokens FROM wikitext")
def wiki_title(spark, sf):
    title = F.col("title")
    return wikitext(spark, sf).select(
        "doc_id", T.title_key(title).alias("normalized"), F.array_join(T.title_tokens(title), " ").alias("tokens")
    )


@query(
    f"""WITH {WIKITEXT_SQL}, {ABSTRACT_SQL},
    m AS (SELECT w.doc_id, regexp_extract(coalesce(abstract, ''), '{fixed.PLACE_IN_ABSTRACT}', ['a', 'b']) AS g FROM wikitext w LEFT JOIN abstracts a ON a.doc_id = w.doc_id)
    SELECT doc_id, CASE WHEN g.a = '' THEN NULL WHEN g.b = '' THEN g.a ELSE concat(g.a, ', ', g.b) END AS place FROM m"""
)
def wiki_place_in_abstract(spark, sf):
    return wikitext(spark, sf).select("doc_id", M.location_from_abstract(M.abstract(F.col("text"))).alias("place"))


RECORDS_SQL = f"""WITH {WIKITEXT_SQL}, {ABSTRACT_SQL}, {FIELDS_SQL},
g AS (SELECT w.doc_id, regexp_extract(coalesce(abstract, ''), '{fixed.PLACE_IN_ABSTRACT}', ['a', 'b']) AS g FROM wikitext w LEFT JOIN abstracts a ON a.doc_id = w.doc_id),
located AS (SELECT w.doc_id, w.title, w.lang, w.source, {CATEGORIES_SQL.replace('source', 'w.source').replace('lang', 'w.lang')} AS cats, a.abstract,
  f.* EXCLUDE (doc_id, lang, source, location), coalesce(f.location, CASE w.lang WHEN 'en' THEN 'Old London' WHEN 'fr' THEN 'Paris' WHEN 'de' THEN 'Bridges' END,
    CASE WHEN g.a = '' THEN NULL WHEN g.b = '' THEN g.a ELSE concat(g.a, ', ', g.b) END) AS location
  FROM wikitext w JOIN fields f ON f.doc_id = w.doc_id JOIN g ON g.doc_id = w.doc_id LEFT JOIN abstracts a ON a.doc_id = w.doc_id
  WHERE w.source NOT IN ('src0', 'src1')),
parents AS (SELECT *, list_filter(list_concat(list_transform(list_slice(string_split_regex(coalesce(location, ''), '[,;/]'), 1, 3), lambda x: trim(x)),
  CASE lang WHEN 'en' THEN ['Old London'] WHEN 'fr' THEN ['Paris'] WHEN 'de' THEN ['Berlin'] ELSE [] END), lambda x: x <> '' AND length(x) < 50) AS p FROM located)
SELECT doc_id, md5(title) AS title, {TITLE_SQL} AS normalized, {TITLE_TOKENS_SQL} AS tokens,
  md5(concat('{fixed.WIKI_BASE}', replace(title, ' ', '_'))) AS url, array_to_string(cats, '|') AS categories, md5(abstract) AS abstract,
  CASE lang WHEN 'en' THEN 'museum' WHEN 'fr' THEN 'park' WHEN 'de' THEN 'bridge' ELSE 'place' END AS type,
  location, built, architect, style, height, coordinates,
  array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i), '|') AS geo_parent,
  array_to_string(list_transform(list_filter(p, lambda x, i: list_position(p, x) = i),
    lambda x: array_to_string(regexp_extract_all(lower(strip_accents(x)), '[a-z]{{2,}}'), ' ')), '|') AS geo_parent_tokens FROM parents"""


def flat_records(records):
    """Records in flat columns."""
    return records.select(
        F.md5("title").alias("title"), "normalized", F.array_join("tokens", " ").alias("tokens"), F.md5("url").alias("url"),
        F.array_join("categories", "|").alias("categories"), F.md5("abstract").alias("abstract"), "type",
        "fields.location", "fields.built", "fields.architect", "fields.style", "fields.height", "fields.coordinates",
        F.array_join("geo_parent", "|").alias("geo_parent"),
        F.array_join(F.transform("geo_parent_tokens", lambda t: F.array_join(t, " ")), "|").alias("geo_parent_tokens"),
    )


@query(RECORDS_SQL.replace("SELECT doc_id, md5(title)", "SELECT md5(title)"))
def wiki_records(spark, sf):
    """Whole page records."""
    return flat_records(wiki.page_records(wikitext(spark, sf)))


@query(
    f"""SELECT CASE source WHEN 'src3' THEN 'parking' WHEN 'src5' THEN 'city' ELSE 'museum' END AS infobox, count(*) AS n_pages
    FROM documents GROUP BY 1 ORDER BY n_pages DESC, infobox LIMIT 50"""
)
def infobox_stats(spark, sf):
    return wiki.top_infoboxes(wikitext(spark, sf))


@query("SELECT count(DISTINCT CASE source WHEN 'src3' THEN 'parking' WHEN 'src5' THEN 'city' ELSE 'museum' END) AS n_infoboxes FROM documents")
def infobox_names(spark, sf):
    return wiki.distinct_infoboxes(wikitext(spark, sf))


@query("SELECT count(*) AS pages_scanned, count(*) FILTER (source NOT IN ('src0', 'src1')) AS records_kept FROM documents")
def wiki_scan_counts(spark, sf):
    return wiki.scan_counts(wikitext(spark, sf))


@query(
    """SELECT md5(split_part(text, chr(10), 1)) AS title, 'city' AS type, concat(upper(lang), ' land, ', source) AS location
    FROM documents WHERE source = 'src5'"""
)
def wiki_cities(spark, sf):
    cities = wiki.city_records(wikitext(spark, sf))
    return cities.select(F.md5("title").alias("title"), "type", "fields.location")


# ---- dump files: the pages written as XML and read back

@query(f"WITH {WIKITEXT_SQL} SELECT md5(title) AS title, md5(text) AS text FROM wikitext WHERE title <> ''")
def wiki_xml_pages(spark, sf):
    path = scratch_path(spark, "dump")
    wiki_xml.write_pages(wikitext(spark, sf), path)
    return wiki_xml.read_pages(spark, path).select(F.md5("title").alias("title"), F.md5("text").alias("text"))


@query(RECORDS_SQL.replace("SELECT doc_id, md5(title)", "SELECT md5(title)") + " WHERE title <> ''")
def wiki_stream(spark, sf):
    """Records of a dump that grew between two runs of the incremental extraction."""
    base = scratch_path(spark, "stream")
    pages = wikitext(spark, sf)
    for chunk in (pages.where("lang = 'en'"), pages.where("lang <> 'en'")):
        wiki_xml.write_pages(chunk, f"{base}/chunks", mode="append")
        extract_new_chunks(spark, f"{base}/chunks", f"{base}/records", f"{base}/checkpoint").awaitTermination()
    return flat_records(good_records(read_jsonl(spark, f"{base}/records", WIKI_PAGE)))


@query(
    f"""WITH r AS ({RECORDS_SQL.replace("SELECT doc_id, md5(title)", "SELECT md5(title)") + " WHERE title <> ''"})
    SELECT 1 AS run, 0::BIGINT AS n_records UNION ALL SELECT 2, count(*) FROM r UNION ALL SELECT 3, count(*) FROM r"""
)
def wiki_stream_empty_chunk(spark, sf):
    """Records there are after a chunk without any, after one with all, and after a run without a new chunk."""
    base = scratch_path(spark, "stream")
    pages, counts = wikitext(spark, sf), []
    for chunk in (pages.withColumn("title", F.lit("")), pages, None):
        if chunk is not None:
            wiki_xml.write_pages(chunk, f"{base}/chunks", mode="append")
        extract_new_chunks(spark, f"{base}/chunks", f"{base}/records", f"{base}/checkpoint").awaitTermination()
        records = good_records(read_jsonl(spark, f"{base}/records", WIKI_PAGE))
        counts.append(records.agg(F.lit(len(counts) + 1).alias("run"), F.count("*").alias("n_records")).collect()[0])
    return spark.createDataFrame(counts, "run int, n_records long")
