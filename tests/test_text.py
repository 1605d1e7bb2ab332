import html

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placeweave import fixed
from placeweave.functions import html as H
from placeweave.functions import markup as M
from placeweave.functions import safe
from placeweave.functions import text as T
from placeweave.operators import listing

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return df.orderBy("i").select(*[e(F.col("t")).alias(f"c{n}") for n, e in enumerate(exprs)]).collect()


@FEW
@given(st.lists(st.text(max_size=30), min_size=20, max_size=20))
def test_keys_are_idempotent(spark, texts):
    rows = values(
        spark, texts, T.ascii_key, lambda c: T.ascii_key(T.ascii_key(c)), T.unicode_key, lambda c: T.unicode_key(T.unicode_key(c))
    )
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows)


def test_tokenisers(spark):
    row = values(
        spark, ["Old Park: Sagrada Família, Güell old"], T.split_tokens, lambda c: T.filtered_tokens(c, F.lit("güell")), T.title_key, T.title_tokens
    )[0]
    assert row[0] == ["old", "park", "sagrada", "família", "güell", "old"]
    assert row[1] == ["old", "sagrada", "família", "old"]  # no stop word, no city, doubles kept
    assert row[2] == "old park sagrada familia guell old"
    assert row[3] == ["old", "park", "sagrada", "familia", "guell", "old"]
    assert values(spark, [None], T.split_tokens, lambda c: T.filtered_tokens(c, F.lit("x")))[0] == ([], [])
    # The key of a two-word city is one word, so the city's own words stay.
    assert values(spark, ["New York pizza"], lambda c: T.filtered_tokens(c, F.lit("newyork")))[0][0] == ["new", "york", "pizza"]


def test_geo_parents_beyond_the_end(spark):
    df = spark.sql("SELECT array('New York', 'USA') AS g UNION ALL SELECT array('Rome') UNION ALL SELECT NULL")
    got = df.select(T.geo_parent_at(F.col("g"), 1).alias("second"), T.candidate_keys(F.col("g")).alias("keys")).collect()
    assert {(r.second, tuple(sorted(r["keys"]))) for r in got} == {("USA", ("new", "usa", "york")), ("", ("rome",)), ("", ())}


def test_numbers(spark):
    ratings = values(spark, ["4.5", " 4 ", "4,5", "good", None], safe.rating_value)
    assert [r[0] for r in ratings] == [4.5, 4.0, None, None, None]
    counts = values(spark, ["3,400", "3.400", " 12 ", "many", None, "3400.0", "1.234.567", "1,234.567", "12.5"], safe.review_count)
    assert [r[0] for r in counts] == [3400, 3400, 12, None, None, 3400, 1234567, 1234567, 12]
    numbers = spark.createDataFrame([(3400.0,), (None,)], "n double").select(safe.review_count(F.col("n"), text=False)).collect()
    assert [r[0] for r in numbers] == [3400, None]


def test_entities_like_the_standard_library(spark):
    texts = [
        "a &amp; b &lt;x&gt; &eacute;", "&copy2 &notit; &not it", "&#233;&#xe9;&#x1F600;&#150;", "& &bogus; &amp &amp;amp;", "none", "&#0; &#xD800;",
        "&nbsp;x&hellip;&ThickSpace;", "&&amp;&&", "&#1114112;", "a&#1;b&#xfdd0;c&#11;d&#127;e&#x1fffe;f", "&#x100000041;", "&#x0000000041;&#x0;",
    ]
    assert [r[0] for r in values(spark, texts, M.decode_entities)] == [html.unescape(t) for t in texts]


def test_detail_pages_with_any_line_ends(spark):
    page = """<h1 class="t">The{e}Tower</h1>{e}<script type="application/ld+json">{e}{{"@type": "Product",{e} "name": "Tower"}}{e}</script>"""
    ends = ["\n", "\r\n", "\r", "\u0085", "\u2028"]
    pages = spark.createDataFrame([(str(k), page.format(e=e)) for k, e in enumerate(ends)], "url string, html string")
    got = listing.detail_records(pages).orderBy("url").collect()
    assert [(r.ld_type, r.name) for r in got] == [("Product", "Tower")] * len(ends)
    assert all(r.title.split() == ["The", "Tower"] for r in got)


def test_price_labels_in_any_case(spark):
    block = '<div class="activity-price"><span>{}</span><b>€ 12</b><i>{}</i></div>'
    texts = [block.format(*x) for x in (("From", "per person"), ("from", "Per Person"), ("FROM", "PER GROUP UP TO 4"))]
    got = [r[0].casefold() for r in values(spark, texts, H.price_text)]
    assert got == ["from € 12 per person", "from € 12 per person", "from € 12 per group up to 4"]


def test_clean_markup(spark):
    cases = {
        "'''Bold''' ''it'' [[A|label]] [[plain]]": "Bold it label plain",
        "x {{a|{{b|{{c}}}}}} y <!-- no\nno --> z": "x y z",
        "{| class=x\n|-\n| a\n|} after": "after",
        "[http://a.b label here] [http://only.it] end": "label here end",
        "== Head ==\ntext with a = b and c = d": "text with a = b and c = d",  # equal signs in text are no heading
        "[[File:x.jpg|thumb|See [[there]] now]]rest": "rest",  # file links go before links are simplified
    }
    assert [r[0] for r in values(spark, list(cases), M.clean_markup)] == list(cases.values())


def test_start_dates(spark):
    cases = {
        "{{Start date|1999|1|2|df=y}}": "1999-01-02",
        "a {{start date |df=y| 2001 |11|30}} b {{Start date|1900|1|2}}": "a 2001-11-30 b 1900-01-02",
        "{{Start date|1999|1}}": "{{Start date|1999|1}}",
        "{{Start date|99|1|2}}": "{{Start date|99|1|2}}",
    }
    assert [r[0] for r in values(spark, list(cases), M.start_dates_to_iso)] == list(cases.values())


def test_infobox_braces_and_names(spark):
    closed = "{{Infobox museum\n| a = {{x|{{y}}}}\n}}"
    texts = ["intro {{z}} " + closed + " tail }}", "{{Infobox museum\n| a = {{x}", "{{Infobox parking lot\n|a=b\n}}", "no box", "{{ infobox  Tourist attraction|a}}"]
    got = [r[0] for r in values(spark, texts, M.infobox)]
    assert got == [closed, None, None, None, "{{ infobox  Tourist attraction|a}}"]


def test_every_landmark_name_opens_an_infobox(spark):
    texts = ["{{Infobox %s\n|a=b\n}}" % n for n in fixed.LANDMARK_INFOBOXES]
    assert [r[0] for r in values(spark, texts, M.infobox)] == texts


def test_infobox_entries(spark):
    box = "{{Infobox museum | inline = 1\n| name = A\nB\n|Name= last\n| = no key\n| no value\nstray\n| x = 1 = 2\n}}\n| after = no"
    got = values(spark, [box], lambda c: M.entry_map(M.infobox_entries(c)))[0][0]
    assert got == {"name": "last", "x": "1 = 2"}


def test_places(spark):
    assert values(spark, ["x"], lambda c: M.geo_parents(F.lit("Paris, France; Europe/World"), F.array(F.lit("In Berlin wall"), F.lit("List of things"), F.lit("Works of Art in Old Rome"))))[0][0] == [
        "Paris", "France", "Europe", "Berlin wall", "Old Rome"
    ]
    got = [r[0] for r in values(spark, ["It is in Rome, Italy today", "nothing here", "built in Ávila"], M.location_from_abstract)]
    assert got[0].startswith("Rome, Italy") and got[1] is None


def test_types_first_hit_wins(spark):
    cats = [["City museums"], ["Gardens in X"], ["Towers"], ["Towns"], ["Nothing"]]
    df = spark.createDataFrame([(c,) for c in cats], "c array<string>")
    assert [r[0] for r in df.select(M.page_type(F.col("c"))).collect()] == ["museum", "park", "landmark", "city", "place"]


def test_html_pieces(spark):
    assert [r[0] for r in values(spark, ["/a", "http://b", "", None], lambda c: H.absolute_url(c, "https://h"))] == ["https://h/a", "http://b", None, None]
    assert values(spark, ["<ul></ul>"], H.list_items)[0][0] is None
    assert values(spark, ["no title"], lambda c: H.first_match(c, "<h1>(.*?)</h1>"))[0][0] is None
    card = '<div class="activity-price"><b>From</b> <b>€ 12</b><s>$30.50 </s><i>per group up to 4</i></div>'
    assert values(spark, [card], H.price_text)[0][0] == "From € 12 per group up to 4"
