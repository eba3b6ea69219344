"""Dense vectors as ``array<double>`` columns: reading, writing and arithmetic in built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinograph.functions.terms import SPACE_CLASS

_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"
_GAP = r"[ \t\n\r]*"


def literal_pattern(dim: int | None = None) -> str:
    """The pattern of a JSON array of numbers, of ``dim`` numbers if given, with outer white space."""
    outer = SPACE_CLASS[:-1] + "*"
    more = "*" if dim is None else f"{{{dim - 1}}}"
    return rf"^{outer}\[{_GAP}{_NUMBER}(?:{_GAP},{_GAP}{_NUMBER}){more}{_GAP}\]{outer}$"


def parse_literal(text: Column, dim: int | None = None) -> Column:
    """``array<double>`` of a number list in text, null if it is not wholly a JSON array of (``dim``) numbers."""
    inner = F.regexp_replace(text, r"[\[\]\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", "")
    return F.when(text.rlike(literal_pattern(dim)), F.split(inner, ",").cast("array<double>"))


def to_literal(vector: Column) -> Column:
    """A vector as the text ``[x,y,...]``."""
    return F.concat(F.lit("["), F.array_join(vector.cast("array<string>"), ","), F.lit("]"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row.

    Catalyst writes an expression out wherever its column is used, inside a
    lambda too, where it then runs once an element; bound to a lambda variable
    it runs once.
    """
    return F.transform(F.array(value), use)[0]


def dot(a: Column, b: Column) -> Column:
    """Sum of products, first to last; null where the lengths differ."""
    return let(
        F.struct(a.alias("a"), b.alias("b")),
        lambda s: F.when(F.size(s["a"]) == F.size(s["b"]), F.aggregate(F.zip_with(s["a"], s["b"], lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)),
    )


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))


def normalize(vector: Column) -> Column:
    """The vector over its length; a zero vector stays as it is."""
    return let(
        vector,
        lambda v: let(F.struct(v.alias("v"), norm(v).alias("n")), lambda s: F.when(s["n"] == 0, s["v"]).otherwise(F.transform(s["v"], lambda x: x / s["n"]))),
    )


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance; null where the lengths differ."""
    return let(
        F.struct(a.alias("a"), b.alias("b")),
        lambda s: F.when(F.size(s["a"]) == F.size(s["b"]), F.aggregate(F.zip_with(s["a"], s["b"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)),
    )


def dist(a: Column, b: Column) -> Column:
    return F.sqrt(sq_dist(a, b))


def usable(vector: Column) -> Column:
    """Not null, no null or infinite or NaN element, and not all zero."""
    return let(
        vector,
        lambda v: v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)),
    )
