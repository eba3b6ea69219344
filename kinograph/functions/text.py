"""Text functions with the semantics of the catalogue's sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the white space that ``trim`` of the sources removes, as a character class for Java and RE2.
TRIM_CLASS = r"[\t\n\x{0b}\x{0c}\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"


def trim_all(text: Column) -> Column:
    """Without outer white space of any kind, line ends and no-break spaces included."""
    return F.regexp_replace(text, f"^{TRIM_CLASS}|{TRIM_CLASS}$", "")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: a character beyond the basic plane counts twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def slugify(text: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def empty_to_null(text: Column) -> Column:
    """The falsy default: the empty string becomes null."""
    return F.nullif(text, F.lit(""))


def prefixed(path: Column, prefix: str) -> Column:
    """``prefix`` and ``path``, null where there is no path or an empty one."""
    return F.when(path != "", F.concat(F.lit(prefix), path))


def year_of(iso_date: Column) -> Column:
    """The year of an ISO date string, null if it is null, empty or no year."""
    return F.substring(iso_date, 1, 4).try_cast("int")


def months_back(day: Column, months: int) -> Column:
    """``day`` so many months ago where a day that the month lacks runs over into the next month (31 August - 6 = 3 March)."""
    return F.date_add(F.add_months(F.trunc(day, "MM"), -months), F.dayofmonth(day) - 1)


def matches_patterns(text: Column, patterns: Sequence[str]) -> Column:
    """Whether the lower-cased text has one of the patterns: one with a space anywhere, one without at the start of a word.

    All phrases are one alternation and all word roots another, so a row is scanned twice however many there are.
    """
    phrases = [p for p in patterns if " " in p]
    roots = [p for p in patterns if " " not in p]
    low = F.lower(text)
    out = F.lit(False)
    if phrases:
        out = out | low.rlike("|".join(map(_quoted, phrases)))
    if roots:
        out = out | low.rlike(f"(?:^|[^A-Za-z0-9_])(?:{'|'.join(map(_quoted, roots))})")
    return out


def _quoted(pattern: str) -> str:
    return "".join("\\" + c if c in r".\+*?[^]$(){}=!<>|:-#/" else c for c in pattern)
