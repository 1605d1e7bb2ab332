"""Wiki markup as column expressions."""

from __future__ import annotations

import html.entities
import json
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeweave import fixed
from placeweave.functions.text import bind, blank_to_null, strip

PAGE_TAG = r"\{\{|\}\}|[^{}]+|[{}]"


@cache
def _entity_names() -> tuple[dict[str, str], list[str]]:
    """Named entities with their text, and the names that also count without a semicolon."""
    table = html.entities.html5
    bare = sorted((n for n in table if not n.endswith(";")), key=lambda n: (-len(n), n))
    return {n: v for n, v in table.items()}, bare


def _code_point(number: Column) -> Column:
    """The character of a numeric entity, nothing for what is no character; the C1 range means Windows-1252 there."""
    windows = {c: bytes([c]).decode("cp1252", "replace") for c in range(0x80, 0xA0)}
    remapped = F.get(
        F.lit([windows[c] if windows[c] != "�" else chr(c) for c in range(0x80, 0xA0)]),
        (number - 0x80).cast("int"),
    )
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
    no_character = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    known = F.when(number.between(0x80, 0x9F), remapped).when(valid & (control | no_character), "")
    return known.when(valid, plain).otherwise("�")


def _from_hex(digits: Column) -> Column:
    """The number, or one beyond all characters if it is too long."""
    digits = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(F.length(digits) <= 8, F.conv(digits, 16, 10).try_cast("bigint")).otherwise(0x110000)


def _entity_text(e: Column) -> Column:
    names, bare = _entity_names()
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")
    decimal = F.regexp_extract(e, r"^&#([0-9]+)", 1)
    hexadecimal = F.regexp_extract(e, r"^&#[xX]([0-9a-fA-F]+)", 1)
    prefix = F.regexp_extract(e, f"^&({'|'.join(bare)})", 1)
    name = F.substring(e, 2, 1 << 20)
    return (
        F.when(decimal != "", _code_point(F.coalesce(decimal.try_cast("bigint"), F.lit(0x110000))))
        .when(hexadecimal != "", _code_point(_from_hex(hexadecimal)))
        .otherwise(
            F.coalesce(
                F.try_element_at(table, name),
                F.when(
                    prefix != "",
                    F.concat(F.try_element_at(table, prefix), F.substr(e, F.length(prefix) + F.lit(2))),
                ),
                e,
            )
        )
    )


def decode_entities(c: Column) -> Column:
    """Text with HTML entities replaced; text without ``&`` is passed through untouched."""
    pieces = F.regexp_extract_all(c, F.lit(r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{1,31};?)|&|[^&]+"), F.lit(0))
    decoded = F.array_join(
        F.transform(pieces, lambda p: F.when(p.startswith("&") & (F.length(p) > 1), _entity_text(p)).otherwise(p)), ""
    )
    return F.when(c.contains("&"), decoded).otherwise(c)


def strip_comments_and_refs(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, fixed.COMMENT, ""), fixed.REF_TAG, "")


def drop_templates(c: Column, depth: int) -> Column:
    """Remove ``{{...}}`` from the inside out, ``depth`` levels deep."""
    for _ in range(depth):
        c = F.regexp_replace(c, fixed.TEMPLATE, "")
    return c


def clean_markup(c: Column) -> Column:
    """Plain text of wiki markup."""
    c = F.regexp_replace(decode_entities(c), fixed.COMMENT, "")
    c = F.regexp_replace(c, fixed.FILE_LINK, "")
    c = F.regexp_replace(c, fixed.QUOTE_RUN, "")
    c = drop_templates(c, 5)
    c = F.regexp_replace(c, fixed.TABLE, "")
    c = F.regexp_replace(c, fixed.WIKILINK, "$1")
    c = F.regexp_replace(c, fixed.LABELLED_LINK, "$1")
    c = F.regexp_replace(c, fixed.BARE_LINK, "")
    c = F.regexp_replace(c, fixed.HEADING, "")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def _iso_date(template: Column) -> Column:
    parts = F.transform(F.split(F.regexp_replace(template, r"[{}]", ""), r"\|"), lambda p: strip(p))
    numbers = F.filter(F.slice(parts, 2, 1 << 20), lambda p: p.rlike("^[0-9]+$"))

    def padded(i: int) -> Column:
        n = F.get(numbers, F.lit(i))
        return F.when(F.length(n) < 2, F.concat(F.lit("0"), n)).otherwise(n)

    is_date = (F.size(numbers) >= 3) & (F.length(F.get(numbers, F.lit(0))) == 4)
    return F.when(is_date, F.concat_ws("-", F.get(numbers, F.lit(0)), padded(1), padded(2))).otherwise(template)


def start_dates_to_iso(c: Column) -> Column:
    """``{{Start date|Y|M|D}}`` becomes ``Y-MM-DD``; anything less complete stays."""
    templates = F.array_distinct(F.regexp_extract_all(c, F.lit(fixed.START_DATE), F.lit(0)))
    return F.aggregate(templates, c, lambda text, t: F.replace(text, t, _iso_date(t)))


def categories(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(fixed.CATEGORY), F.lit(1)), lambda x: strip(x))


def infobox_name(c: Column) -> Column:
    """First word of the first infobox's name in lower case; null without an infobox."""
    name = F.lower(strip(F.regexp_extract(c, fixed.INFOBOX_NAME, 1)))
    return blank_to_null(F.get(F.split(name, r"[\s|{<]"), F.lit(0)))


def _infobox_start(names: list[str]) -> str:
    words = "|".join(n.replace(" ", r"\s*") for n in names)
    return rf"(?i)\{{\{{\s*Infobox\s+(?:{words})\b"


def infobox(c: Column, names: list[str] | None = None) -> Column:
    """From the first infobox of one of ``names`` to its matching braces; null if they never match."""
    start = F.lit(_infobox_start(fixed.LANDMARK_INFOBOXES if names is None else names))

    def closed(rest: Column) -> Column:
        # Walk over the braces carrying only the depth, the offset and where depth fell back to 0.
        state = F.aggregate(
            F.regexp_extract_all(rest, F.lit(PAGE_TAG), F.lit(0)),
            F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end")),
            lambda s, p: F.when(s["end"] > 0, s).otherwise(_step(s, p)),
        )
        return bind(state["end"], lambda end: F.when(end > 0, F.substr(rest, F.lit(1), end)))

    def from_start(at: Column) -> Column:
        return F.when(at > 0, bind(F.substr(c, at), closed))

    return bind(F.regexp_instr(c, start), from_start)


def _step(s: Column, p: Column) -> Column:
    depth = s["depth"] + F.when(p == "{{", 1).when(p == "}}", -1).otherwise(0)
    at = s["at"] + F.length(p)
    return F.struct(
        depth.alias("depth"), at.alias("at"), F.when((p == "}}") & (depth == 0), at).otherwise(0).alias("end")
    )


def infobox_entries(box: Column) -> Column:
    """Key and cleaned value of each ``| key = value`` of an infobox, in page order.

    A line that starts with ``|`` opens an entry and the lines after it continue it; a line
    that starts with braces closes the box.
    """
    text = F.regexp_replace(strip_comments_and_refs(box), r"\R", "\n")
    body = F.regexp_replace(text, r"(?s)^[^\n]*(\n|$)", "\n")
    body = F.regexp_replace(body, r"(?s)\n[^\S\n]*\}\}.*", "")
    entries = F.slice(F.split(body, r"\n[^\S\n]*\|"), 2, 1 << 20)
    keyed = F.filter(entries, lambda e: e.rlike(r"^[^\n=]*[^\s=][^\n=]*="))
    return F.transform(
        keyed,
        lambda e: F.struct(
            F.lower(strip(F.regexp_extract(e, r"^([^\n=]*)=", 1))).alias("key"),
            clean_markup(drop_templates(start_dates_to_iso(F.regexp_replace(e, r"^[^\n=]*=", "")), 3)).alias("value"),
            strip(F.regexp_replace(F.regexp_replace(e, r"^[^\n=]*=", ""), r"(?U)\s+", " ")).alias("raw"),
        ),
    )


def last_value(entries: Column, key: str, part: str = "value") -> Column:
    """Value of the last entry with this key; empty counts as missing."""
    hit = F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))
    return blank_to_null(hit[part])


def entry_map(entries: Column) -> Column:
    """All entries as a map; the last of several with one key wins."""
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, 1 << 20), e["key"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def record_fields(entries: Column) -> Column:
    """The seven record fields, each from the first of its keys that has a value.

    Coordinates are mostly a template, which cleaning would delete, so they are taken raw.
    """

    def fields(e: Column) -> Column:
        return F.struct(
            *[
                F.coalesce(*[last_value(e, k, "raw" if name == "coordinates" else "value") for k in keys]).alias(name)
                for name, keys in fixed.FIELD_SOURCES.items()
            ]
        )

    return bind(entries, fields)


def abstract(c: Column, min_length: int = 50) -> Column:
    """First paragraph that is no template or table row and has more than ``min_length`` plain characters."""
    paragraphs = F.filter(
        F.split(c, "\n\n"),
        lambda p: ~p.startswith("{{") & ~p.startswith("|") & (F.length(p) > min_length),  # cleaning never lengthens
    )

    def plain(p: Column) -> Column:
        return F.get(F.filter(F.transform(F.array(p), clean_markup), lambda t: F.length(t) > min_length), F.lit(0))

    # The fold leaves the paragraphs after the first hit uncleaned.
    return F.aggregate(paragraphs, F.lit(None).cast("string"), lambda hit, p: F.when(hit.isNotNull(), hit).otherwise(plain(p)))


def page_type(cats: Column) -> Column:
    joined = F.lower(F.array_join(cats, " "))
    out = F
    for name, words in fixed.TYPE_WORDS:
        out = out.when(joined.rlike("|".join(words)), name)
    return out.otherwise(fixed.DEFAULT_TYPE)


def location_from_categories(cats: Column) -> Column:
    places = F.transform(cats, lambda x: strip(F.regexp_extract(x, fixed.PLACE_IN_CATEGORY, 1)))
    first = F.slice(F.array_distinct(F.filter(places, lambda p: p != "")), 1, 3)
    return blank_to_null(F.array_join(first, ", "))


def location_from_abstract(c: Column) -> Column:
    def part(i: int) -> Column:
        return blank_to_null(F.regexp_extract(c, fixed.PLACE_IN_ABSTRACT, i))

    return blank_to_null(F.concat_ws(", ", part(1), part(2)))


def geo_parents(location: Column, cats: Column) -> Column:
    """Parts of the location, then the place after the last "in" or "of" of each category."""
    parts = F.transform(F.slice(F.split(location, "[,;/]"), 1, 3), lambda p: strip(p))

    def place(x: Column) -> Column:
        after_in = F.regexp_extract(x, r"(?is)^.*\bin\s+(.*)$", 1)
        after_of = F.regexp_extract(x, r"(?is)^.*\bof\s+(.*)$", 1)
        return strip(
            F.when(x.rlike(r"(?i)\bin\s"), after_in)
            .when(x.rlike(r"(?i)\bof\s") & ~x.rlike("(?i)^list"), after_of)
            .otherwise("")
        )

    every = F.concat(F.coalesce(parts, F.array().cast("array<string>")), F.transform(cats, place))
    return F.array_distinct(F.filter(every, lambda p: (p != "") & (F.length(p) < 50)))
