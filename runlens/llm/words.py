"""Words and lines of whole texts as native column expressions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a longest run of characters other than these.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words in order; none for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, others: str) -> Column:
    """Characters left when those matched by the pattern ``others`` are taken away."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where there is no whole."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))
