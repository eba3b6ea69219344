from datetime import date

import pytest
from pyspark.sql import functions as F

from kinograph.functions import terms, text, vectors
from kinograph.operators.keywords import FORMAT_PATTERNS, SENSITIVE_PATTERNS


def values(spark, column, data, kind):
    return [r[0] for r in spark.createDataFrame([(x,) for x in data], f"x {kind}").select(column(F.col("x"))).collect()]


def test_terms(spark):
    given = ["  Neo  NOIR\t", "a\n b", "   ", "", None, "Ünder"]
    assert values(spark, terms.term, given, "string") == ["neo noir", "a b", "", "", None, "ünder"]
    assert values(spark, terms.term_list, [given, None, []], "array<string>") == [["neo noir", "a b", "ünder"], [], []]
    assert values(spark, terms.term_set, [["A", "a ", "b"]], "array<string>") == [["a", "b"]]


@pytest.mark.parametrize(
    ("literal", "wanted"),
    [
        ("[1,2]", [1.0, 2.0]), ("  [ -1.5 , 2e1 ]\n", [-1.5, 20.0]), ("[1,2,3]", None), ("[1,null]", None), ("[1,2", None), ("[1,2]x", None),
        ("", None), ("null", None), ("[01,2]", None), ("[1,+2]", None), ("[NaN,1]", None), ('["1",2]', None), ("[1 2]", None), ("[1.,2]", None), (None, None),
    ],
)
def test_parse_literal(spark, literal, wanted):
    assert values(spark, lambda x: vectors.parse_literal(x, 2), [literal], "string") == [wanted]


def test_vector_arithmetic(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [1.0])], "a array<double>, b array<double>, c array<double>")
    r = df.select(
        vectors.norm(F.col("a")).alias("norm"),
        vectors.normalize(F.col("a")).alias("unit"),
        vectors.normalize(F.col("b")).alias("zero"),
        vectors.dist(F.col("a"), F.col("b")).alias("dist"),
        vectors.dist(F.col("a"), F.col("c")).alias("other_length"),
        vectors.usable(F.col("b")).alias("usable"),
        vectors.to_literal(F.col("a")).alias("text"),
    ).first()
    assert (r.norm, r.unit, r.zero, r.dist, r.other_length, r.usable, r.text) == (5.0, [0.6, 0.8], [0.0, 0.0], 5.0, None, False, "[3.0,4.0]")


def test_text(spark):
    assert values(spark, text.trim_all, ["\n a  ", "﻿b", None], "string") == ["a", "b", None]
    assert values(spark, text.utf16_length, ["a😀", "", None], "string") == [3, 0, None]
    assert values(spark, text.slugify, ["  The B--Side! ", "***", "Éa"], "string") == ["the-b-side", "", "a"]
    assert values(spark, text.year_of, ["1999-01-02", "", None, "x"], "string") == [1999, None, None, None]
    assert values(spark, lambda x: text.prefixed(x, "p"), ["/a", "", None], "string") == ["p/a", None, None]
    assert values(spark, lambda x: text.months_back(x, 6), [date(2026, 8, 31), date(2026, 3, 15)], "date") == [date(2026, 3, 3), date(2025, 9, 15)]


def test_patterns(spark):
    words = ["grape", "rape and revenge", "Pedophile", "drug trafficking", "human trafficking", "sexploitation", "spin-off", "club movie", "b movie", "érape", "pov (point of view)"]
    bad = values(spark, lambda x: text.matches_patterns(x, FORMAT_PATTERNS + SENSITIVE_PATTERNS), words, "string")
    assert bad == [False, True, True, False, True, False, True, True, True, True, True]
