"""Casts that give null instead of an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeweave.functions.text import strip


def rating_value(c: Column) -> Column:
    return strip(c.cast("string")).try_cast("double")


def review_count(c: Column, text: bool = True) -> Column:
    """Whole number of reviews.

    In text, commas and dots are grouping marks; a single dot that no group of three digits
    follows is a decimal point, as in a JSON number that was read as text.
    """
    if not text:
        return c.try_cast("bigint")
    c = strip(c)
    decimal = c.rlike(r"^[0-9]+\.[0-9]+$") & ~c.rlike(r"^[0-9]{1,3}\.[0-9]{3}$")
    whole = F.when(decimal, F.substring_index(c, ".", 1)).otherwise(F.regexp_replace(c, "[,.]", ""))
    return whole.try_cast("bigint")
