"""Normalising and tokenising column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeweave import fixed

WORD = r"[\p{L}\p{N}_]+"
ANALYSED_WORD = r"[\p{L}\p{M}\p{N}_]+"


WHITESPACE = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.trim(c, F.lit(WHITESPACE))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def ascii_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def unicode_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{Nd}]+", "")


def split_tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits; null gives no tokens."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0)), empty_strings())


def filtered_tokens(c: Column, city_key: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-case words longer than one letter, without stop words and the city key itself."""
    stop = fixed.STOP_WORDS if stop_words is None else stop_words
    words = F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))
    kept = F.filter(
        words,
        lambda w: (F.length(w) > 1) & ~w.isin(stop) & ~F.coalesce(w == city_key, F.lit(False)),
    )
    return F.coalesce(kept, empty_strings())


def analysed_terms(c: Column) -> Column:
    """Terms as the index stores them: Unicode words in lower case."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(ANALYSED_WORD), F.lit(0)), empty_strings())


def description_text(description: Column, highlights: Column) -> Column:
    return F.concat_ws(" ", description, F.array_join(highlights, " "))


def geo_parent_at(geo_parent: Column, index: int = 0) -> Column:
    return F.coalesce(F.get(geo_parent, F.lit(index)), F.lit(""))


def ascii_keys(values: Column) -> Column:
    return F.transform(values, ascii_key)


def candidate_keys(geo_parent: Column) -> Column:
    """Distinct tokens of the first two geo parents."""
    return F.array_union(split_tokens(geo_parent_at(geo_parent, 0)), split_tokens(geo_parent_at(geo_parent, 1)))


@cache
def _accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one ASCII character plus marks."""
    accented, plain = [], []
    for code in range(0x80, 0x30000):
        ch = chr(code)
        parts = unicodedata.normalize("NFD", ch)
        base = [p for p in parts if unicodedata.category(p) != "Mn"]
        if parts != ch and len(base) == 1 and base[0] < "\x80":
            accented.append(ch)
            plain.append(base[0])
    return "".join(accented), "".join(plain)


def fold_accents(c: Column) -> Column:
    accented, plain = _accent_table()
    return F.translate(F.regexp_replace(c, r"\p{Mn}+", ""), accented, plain)


def title_key(c: Column) -> Column:
    """Accent-free lower-case title of letters, digits and spaces."""
    lowered = F.replace(F.lower(fold_accents(c)), F.lit("_"), F.lit(" "))
    return strip(F.regexp_replace(lowered, "[^a-z0-9 ]", ""))


def title_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(fold_accents(c)), F.lit("[a-z]{2,}"), F.lit(0))
