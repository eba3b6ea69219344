import random
from collections import Counter
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinograph.llm import cooccur, setjoin, termfreq

SCHEMA = "id string, ks array<string>, term string, n int, record int"


def baskets(n=300, seed=2, words=25, longest=12):
    rng = random.Random(seed)
    pool = [f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(500)]
    out = []
    for i in range(n):
        ks = [rng.choice([*pool, "W1 ", " w2\t", None, "  "]) for _ in range(rng.randrange(longest))]
        out.append((f"r{i:03d}", rng.choice([ks, ks, ks, None]) if i % 9 == 0 else ks))
    return out


def clean(ks):
    return [" ".join(k.lower().split()) for k in ks or [] if k and k.strip()]


def frame(spark, data):
    return spark.createDataFrame([(i, k, "clash", 7, 7) for i, k in data], SCHEMA)


@pytest.mark.parametrize(("item_block", "long_basket", "held"), [(4, 4096, True), (4096, 4, True), (3, 4, False)])
def test_cooccurrence(spark, rows, monkeypatch, item_block, long_basket, held):
    if not held:
        monkeypatch.setattr(cooccur, "MOST_HELD", 0)
    data = baskets()
    df = frame(spark, data + data[:40] + [(None, ["w1", "w2"])])  # repeated rows count once, a null record not at all
    single, pair = Counter(), Counter()
    for _, ks in data:
        t = sorted(set(clean(ks)))
        single.update(t)
        pair.update(combinations(t, 2))
    want = sorted((a, b, n, single[a], single[b], len(data)) for (a, b), n in pair.items() if n >= 5)
    got = cooccur.cooccurrence(df, "id", "ks", 5, item_block=item_block, block_ones=64, long_basket=long_basket, most_cells=50)
    assert rows(got, "term_a", "term_b", "n_ab", "n_a", "n_b", "n") == want
    assert rows(cooccur.above_chance(got, 2), "term_a", "term_b") == sorted((a, b) for a, b, n, x, y, m in want if n * m >= 2 * x * y)
    assert cooccur.cooccurrence(df.limit(0), "id", "ks").count() == 0


def test_rows_of_one_record_with_other_terms_are_joined(spark, rows):
    df = spark.createDataFrame([("a", ["x"]), ("a", ["y", "x"]), ("b", ["x", "y"]), ("b", ["x", "y"]), ("c", None)], "id string, ks array<string>")
    assert rows(cooccur.cooccurrence(df, "id", "ks", 1), "term_a", "term_b", "n_ab", "n_a", "n_b", "n") == [("x", "y", 2, 2, 2, 3)]
    assert rows(termfreq.term_frequencies(df, "id", "ks")) == [("x", 3, 2), ("y", 2, 2)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), max_size=12), max_size=20), st.sampled_from([3, 8, 64]), st.sampled_from([5, 1000]), st.sampled_from([1, 4]))
def test_gram(sets, block, pending, per_add):
    gram, got = cooccur.Gram(block, pending), Counter()
    for at in range(0, len(sets), per_add):
        part = [sorted(s) for s in sets[at : at + per_add]]
        gram.add(np.cumsum([0, *map(len, part)]), np.array([x for s in part for x in s], np.int32), limit=pending)
    assert set(gram.counted) | set(gram.waiting) == {(a // block, b // block) for s in sets for a, b in combinations(sorted(s), 2)}
    for batch in gram.drain():
        for x, y, c in zip(*(c.to_pylist() for c in batch.columns)):
            assert (x, y) not in got
            got[x, y] = c
    assert got == Counter(p for s in sets for p in combinations(sorted(s), 2)) and gram.cells == 0


def test_a_basket_of_very_many_terms_ends(spark):
    """A million terms that no other record has, and fifteen hundred that four others have."""
    shared = [f"s{i}" for i in range(1500)]
    df = spark.createDataFrame([(i, shared if i else []) for i in range(5)], "id int, ks array<string>")
    df = df.selectExpr("id", "if(id = 0, concat(ks, transform(sequence(1, 1000000), x -> concat('t', x))), ks) ks")
    df = df.selectExpr("id", f"if(id = 0, concat(ks, array({','.join(repr(x) for x in shared)})), ks) ks")
    assert cooccur.cooccurrence(df, "id", "ks", 5, long_basket=1000).selectExpr("count(*)", "min(n_ab)", "max(n_ab)").first() == (1500 * 1499 // 2, 5, 5)


@pytest.mark.parametrize("burst", [1, 3, 256])
def test_term_frequencies(spark, rows, burst):
    data = baskets(words=60) + [("long", ["x" * 5000, "x" * 5000, ""]), ("uni", ["é", "éa", "日本", "日"])]
    df = frame(spark, data + data[:40] + [(None, ["w1"])])
    occurrences, records = Counter(), Counter()
    for _, ks in data:
        occurrences.update(clean(ks))
        records.update(set(clean(ks)))
    want = sorted((t, occurrences[t], records[t]) for t in occurrences)
    assert sorted(rows(termfreq.term_frequencies(df, "id", "ks", burst=burst, flush=20, route_terms=5))) == want
    marks = dict(rows(termfreq.marked(df, "id", "ks"), "term", "mark"))
    assert marks == {t: "common" if 20 * records[t] > len(data) else "rare" if records[t] < 15 else None for t in records}
    assert termfreq.marked(df.limit(0), "id", "ks").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=5)), st.integers(1, 4))
def test_burst_trie(terms, burst):
    trie = termfreq.BurstTrie(burst)
    for t in terms:
        trie.add(t, 1, 2)
    found = {p + s: tuple(c) for p, k in trie.containers() for s, c in k.items()}
    assert found == {t: (n, 2 * n) for t, n in Counter(terms).items()} and trie.size == len(found)


def jaccard_pairs(sets, t):
    return sorted((a, b) for (a, x), (b, y) in combinations(sorted(sets.items()), 2) if x and y and Fraction(len(x & y), len(x | y)) >= t)


@pytest.mark.parametrize(
    ("threshold", "max_keys", "hot", "digest"),
    [("0.7", 96, 50_000, F.xxhash64), ("0.7", 3, 10, lambda x: F.size(x).cast("bigint")), ("0.5", 40, 5, F.xxhash64), ("1", 96, 50_000, lambda x: F.xxhash64(x) % 7)],
)  # digests that different sets share, and lists that are scanned in shares
def test_similar_sets(spark, rows, threshold, max_keys, hot, digest):
    rng = random.Random(5)
    data = {}
    for i in range(160):
        base = [f"v{rng.randrange(40)}" for _ in range(rng.choice([1, 2, 4, 6, 9, 12, 15, 25]))]
        data[f"s{i:03d}"] = base
        if i % 3 == 0:  # near copies and copies
            data[f"s{i:03d}x"] = [v for v in base if rng.random() > 0.12] + ([f"v{rng.randrange(40)}"] if rng.random() < 0.5 else [])
            data[f"s{i:03d}y"] = base[::-1] + base[:1]
    df = spark.createDataFrame([*((k, [*v, None], 1, "c") for k, v in data.items()), ("null", None, 1, "c"), ("empty", [], 1, "c")], "id string, vs array<string>, cls int, strings string")
    pairs, members = setjoin.similar_sets(df, "id", "vs", threshold, max_keys, hot, digest)
    sets = {k: frozenset(v) for k, v in data.items()}
    assert rows(setjoin.member_pairs(pairs, members)) == jaccard_pairs(sets, Fraction(threshold))
    assert members.count() == len(data)
    assert pairs.count() == pairs.select("cls_a", "cls_b").distinct().count()


def test_one_hot_class(spark):
    """A third of all rows are copies: one class, its pairs with itself are not listed."""
    df = spark.range(3000).selectExpr("cast(id as string) id", "if(id % 3 = 0, array('a','b','c','d'), array(concat('x', id), concat('y', id), concat('z', id))) vs")
    pairs, members = setjoin.similar_sets(df, "id", "vs")
    assert pairs.count() == 0 and members.count() == 3000 and members.select("cls").distinct().count() == 2001


def test_no_sets(spark):
    pairs, members = setjoin.similar_sets(spark.createDataFrame([], "id string, vs array<string>"), "id", "vs")
    assert pairs.count() == members.count() == 0
