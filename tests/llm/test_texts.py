import random
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinograph.llm import contamination, fmindex, packing, quality


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(1, 4), st.sampled_from([1, 3, 8]))
def test_fm_index(text, length, sample):
    index = fmindex.FMIndex(np.array(text), 5, sample)
    patterns = np.array([[(p // 4**j) % 4 + 1 for j in range(length)] for p in range(4**length)])
    which, place = index.occurrences(patterns)
    got = defaultdict(set)
    for w, p in zip(which.tolist(), place.tolist()):
        got[w].add(p)
    for i, p in enumerate(patterns.tolist()):
        assert got[i] == {k for k in range(len(text) - length + 1) if text[k : k + length] == p}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200))
def test_wavelet_tree(text):
    tree = fmindex.WaveletTree(np.array(text), 10)
    places = np.arange(len(text) + 1)
    for symbol in range(10):
        assert tree.rank(np.full(len(places), symbol), places).tolist() == [text[:i].count(symbol) for i in places]
    assert tree.access(np.arange(len(text))).tolist() == text


def leak_case(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 30])))) for i in range(12)]
    items += [(50, items[3][1] + " tail"), (51, None), (52, "")]
    docs = []
    for d in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append(" ".join(rng.choice([*vocabulary, "other", "İstanbul"]) for _ in range(rng.randrange(40))))
            words = rng.choice([t for _, t in items if t]).split()
            a = rng.randrange(len(words))
            parts.append(rng.choice([", ", " _ ", "\n"]).join(w.upper() for w in words[a : a + rng.randrange(1, 25)]))
        docs.append((d, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, items[2][1] * 50), (None, items[2][1]), (3, docs[3][1])]
    return docs, items


def grams(text, n=12):
    w = contamination.words(text or "")
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.mark.parametrize(("shard", "block"), [(1_000_000, 2_000_000), (50, 20)])
def test_leaks(spark, shard, block):
    docs, items = leak_case()
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id bigint, text string, item_id int, word_from string")
    e = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id bigint, text string, doc_id int")
    spans = contamination.leaked_spans(d, e, shard_words=shard, block_words=block).collect()
    want = {(a, i) for a, t in docs if a is not None for i, u in items if grams(t) & grams(u)}
    assert {(r.doc_id, r.item_id) for r in spans} == want and want
    text = dict(docs)
    for r in spans:
        inside = contamination.words(text[r.doc_id])[r.word_from : r.word_to]
        assert len(inside) >= 12 and contamination.words(text[r.doc_id][r.char_from : r.char_to]) == inside
    assert contamination.leaked_spans(d.limit(0), e).count() == 0
    assert contamination.leaked_spans(d, e.limit(0)).count() == 0


def test_best_fit():
    fit = packing.BestFit(10, 2)
    assert [fit.place(x) for x in (6, 7, 3, 4, 9, 2, 1)] == [0, 1, 1, 0, 2, 3, 2]
    fit = packing.BestFit(10, 2)
    assert [fit.place(x) for x in (6, 7, 8, 4)] == [0, 1, 2, 0]  # the fullest, 1, closed


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60), st.integers(1, 5))
def test_best_fit_never_overfills(sizes, bins):
    fit, load = packing.BestFit(20, bins), defaultdict(int)
    for s in sizes:
        load[fit.place(s)] += s
        assert fit.open <= bins
    assert all(x <= 20 for x in load.values())
    assert fit.open == sum(len(x) for x in fit.by_free.values())


def test_pack(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "Beta", "čtyři", "5"]) for _ in range(rng.choice([0, 1, 5, 30, 200, 3000]))) for _ in range(400)]
    docs = [(i, t, 5, "x") for i, t in enumerate(texts)] + [(7, texts[7], 5, "x"), (None, "a", 5, "x"), (999, None, 5, "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, tokens int, profile string")
    got = packing.pack(df, [("s", 64), ("l", 512)], shard_docs=100)
    rows = got.collect()
    again = packing.pack(df.repartition(3), [("s", 64), ("l", 512)], shard_docs=100).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))  # whatever the layout
    encode = packing.tokenizer(packing.TOKENIZERS, "byte_bpe_50k.tiktoken").encode_ordinary
    tokens = {i: len(encode(t)) for i, t in enumerate(texts)}
    for profile, capacity in (("s", 64), ("l", 512)):
        load, pieces = defaultdict(int), defaultdict(list)
        for r in rows:
            if r.profile == profile:
                load[r.container] += r.token_to - r.token_from
                pieces[r.doc_id].append((r.piece, r.token_from, r.token_to))
        assert max(load.values()) <= capacity and set(pieces) == set(tokens)
        for doc, p in pieces.items():
            copies = 2 if doc == 7 else 1
            assert sum(b - a for _, a, b in p) == copies * tokens[doc]
            assert len(p) == pieces_of(tokens[doc], capacity) * copies
        assert sum(load.values()) / capacity / len(load) > 0.9
    assert packing.pack(df.limit(0), [("s", 64)]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, [("s", 0)])


def pieces_of(tokens, capacity):
    return 1 if tokens <= capacity else -(-tokens // capacity)


PROSE = ["The music follows the detective from the aquarium to the harbour, and nobody says what they mean.", "Le film n'est pas tranquille, mais il laisse une impression de tendresse qui dure.", "She arrives with a caravan, a debt and a quiet coat, and leaves with none of them."]


def written(form, rng):
    n = rng.randrange(6, 20)
    if form == "prose":
        return rng.choice(["\n", " ", "\n\n"]).join(rng.choice(PROSE) for _ in range(n))
    if form == "list":
        mark = rng.choice(["- ", "* ", "{}. ", "", "#"])
        return "\n".join(mark.format(i + 1) + rng.choice(["silver inn", "The Old Lantern", "Kas Beljik", "sailor, regret"]) for i in range(n))
    if form == "table":
        return "\n".join(rng.choice(["| Silver Inn | 1931 | 3.3 | 120 min |", "| Pale Mirror | 1999 | 8.1 | 88 min |"]) for _ in range(n)) if rng.random() < 0.5 else "\n".join(f"{rng.randrange(9999)}.{rng.randrange(9)} " * 6 for _ in range(n))
    return "\n".join("".join(rng.choice("\\/<>=_#~|*-.") for _ in range(40)) for _ in range(n)) if rng.random() < 0.5 else " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(8)) for _ in range(n * 5))


def test_quality_on_held_out_texts(spark):
    rng = random.Random(3)
    docs = [(i, quality.FORMS[i % 4]) for i in range(320)]
    texts = {i: written(f, rng) for i, f in docs}
    labels = [(i, f) for i, f in docs if i < 160] + [(0, "list"), (1, None), (2, "unheard of"), (None, "list"), (5000, "prose")] + [(8, "prose")] * 2
    d = spark.createDataFrame([*((i, texts[i], "x") for i, _ in docs), (900, None, "x"), (901, " \n ", "x"), (902, texts[0] * 300, "x"), (903, PROSE[0] + "\n" + texts[1], "x")], "doc_id bigint, text string, form string")
    lab = spark.createDataFrame(labels, "doc_id bigint, form string")
    model = quality.fit_model(d, lab)
    got = {r.doc_id: r for r in quality.document_quality(d, model).collect()}
    right = sum(got[i].form == f for i, f in docs if i >= 160)
    assert right >= 0.95 * 160
    assert got[900].form is None and got[900].n_words == 0 and got[901].form is None
    assert got[902].form == "prose" and got[902].n_words == 300 * got[0].n_words or got[902].form == "prose"
    r = got[0]
    assert abs(r.share_prose + r.share_list + r.share_table + r.share_junk - 1) < 1e-9
    assert quality.document_quality(d.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        quality.fit_model(d, lab.limit(0))


def test_common_words_of_a_language_without_labels(spark):
    rng = random.Random(4)
    docs = [(i, written(quality.FORMS[i % 4], rng), rng.choice(["en", "EN", "en-GB"])) for i in range(320)]
    docs += [(1000 + i, f"Byl jednou jeden král, který měl přece jen {w}. Nikdo se ho nebál, a tak šel do světa.", "cs") for i, w in enumerate("les hrad most koně strach poklad".split())]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    model = quality.fit_model(d, spark.createDataFrame([(i, quality.FORMS[i % 4]) for i in range(320)], "doc_id bigint, form string"))
    assert {"byl", "se", "tak"} <= model.common and "poklad" not in model.common
    assert all(r.common_word_share > 0.8 for r in quality.document_quality(d.where("lang = 'cs'"), model).collect())


def test_viterbi_smooths():
    model = quality.LineModel(None, np.log(np.full(4, 0.25)), np.log(np.full((4, 4), 0.01) + np.eye(4) * 0.96), frozenset())
    like = np.log(np.array([[0.9, 0.1, 1e-3, 1e-3]] * 3 + [[0.4, 0.6, 1e-3, 1e-3]] + [[0.9, 0.1, 1e-3, 1e-3]] * 2))
    assert model.states(like, [6]).tolist() == [0] * 6
    assert model.states(like, [6], np.tile([False, True, True, False], (6, 1))).tolist() == [1] * 6
    assert model.states(like[:0], []).tolist() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=6), st.integers(0, 1000))
def test_viterbi_of_many_documents_at_once(lengths, seed):
    rng = np.random.default_rng(seed)
    start, move, like = np.log(rng.dirichlet(np.ones(4))), np.log(rng.dirichlet(np.ones(4), 4)), np.log(rng.random((sum(lengths), 4)))
    got, at = quality.LineModel(None, start, move, frozenset()).states(like, lengths), 0
    for n in lengths:
        part = like[at : at + n]
        best = max(product(range(4), repeat=n), key=lambda p: start[p[0]] + part[0, p[0]] + sum(move[p[i - 1], p[i]] + part[i, p[i]] for i in range(1, n)))
        assert tuple(got[at : at + n].tolist()) == best
        at += n


def statistics(*lines):
    return quality.line_statistics([list(lines)], quality._WordKinds(frozenset({"the"})), quality._Characters())


def test_long_lines_take_linear_time():
    import time

    lines = ["." * 100_000 + " a b c d e f", "1" * 100_000 + "x", "<" * 100_000, "a" * 100_000, '.")' * 50_000 + "x", "a..." * 50_000 + " b c d e f g", " " * 100_000 + "x", "1,2.3 -4 x5"]
    began = time.perf_counter()
    stats, sums = statistics(*lines)
    assert time.perf_counter() - began < 5
    number = quality.STATISTICS.index("number_tokens")
    assert stats.shape == (8, len(quality.STATISTICS))
    assert stats[-1][number] == np.float32(2 / sums[-1][0]) and stats[1][number] == 0


def test_no_statistic_depends_on_the_length_of_a_line():
    """The same ends and starts, after or before text of any length."""
    column = lambda x, name: x[:, quality.STATISTICS.index(name)].tolist()
    sizes = (50, 990, 1200, 5000)
    x, _ = statistics(*("word " * (n // 5) + end for n in sizes for end in ("Harbour ..... 12", "he left." + "”)" * 60, "he left")))
    assert column(x, "leader") == [1, 0, 0] * 4 and column(x, "ends_sentence") == [0, 1, 0] * 4
    x, _ = statistics(*(y for n in sizes for y in ("a" * n + " - 1", "b" * n + " - 1", "b" * n + " = 1")))
    assert column(x, "like_next") == [1, 0, 0] * 4


def test_statistics_by_hand():
    name = lambda x, row, n: float(x[row, quality.STATISTICS.index(n)])
    x, sums = statistics("<b>The cat's</b>, two  dogs;", "| 12 | 3,4 |\t")
    assert sums.tolist() == [[4, 15, 1, 0], [3, 4, 0, 0]]
    assert name(x, 0, "wide_gaps") == pytest.approx(1 / 3) and name(x, 0, "semicolons_a_word") == 0.25 and name(x, 0, "commas_a_word") == 0.25
    assert name(x, 1, "pipes") == 1 and name(x, 1, "number_tokens") == pytest.approx(2 / 3) and name(x, 1, "tight_commas") == pytest.approx(1 / 3)
    assert name(x, 0, "distinct_words") == 1 and name(x, 0, "longest_word") == pytest.approx(5 / 40) and name(x, 0, "tag_chars") == pytest.approx(7 / 24)
    empty, none = statistics()
    assert empty.shape == (0, len(quality.STATISTICS)) and len(none) == 0


def test_too_many_capacity_profiles_are_an_error(spark, tmp_path):
    from kinograph.llm import queries

    spark.range(1001).selectExpr("concat('p', id) profile", "cast(512 + id as int) max_tokens").write.parquet(f"{tmp_path}/pack_capacities.parquet")
    spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.raises(ValueError, match="1000"):
        queries.p8_containers(spark, str(tmp_path))
