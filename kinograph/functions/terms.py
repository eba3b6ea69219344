"""Keyword and genre terms: how an array element becomes a term."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, as a class in Java's patterns.
SPACE_CODES = ("0085", "00a0", "1680", "2000-200a", "2028", "2029", "202f", "205f", "3000")
SPACE_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}" + "".join("-".join(rf"\x{{{c}}}" for c in code.split("-")) for code in SPACE_CODES) + "]+"


def term(element: Column) -> Column:
    """Lower case, runs of white space (no-break spaces too) made one space, trimmed; blank stays blank."""
    return F.lower(F.trim(F.regexp_replace(element, SPACE_CLASS, " ")))


def term_list(elements: Column) -> Column:
    """The terms of an array in order, repeats kept, null and blank elements left out; a null array gives none."""
    made = F.transform(F.coalesce(elements, F.array().cast("array<string>")), term)
    return F.filter(made, lambda t: t.isNotNull() & (t != ""))


def term_set(elements: Column) -> Column:
    """The distinct terms of an array."""
    return F.array_distinct(term_list(elements))
