import json

import numpy as np
import pytest

from kinograph.llm import birch, knn
from kinograph.llm.vectors import double_units, unit, unit_vectors


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("[3,4]", [0.6, 0.8]), (" [ 3e2 , 4.0E2 ]　", [0.6, 0.8]), ("[0,0]", None), ("[0,-0.0]", None), ("[1]", None), ("[1,2,3]", None), ("[1,null]", None), ("[1,true]", None),
        ("[NaN,1]", None), ("[1e999,1]", None), ("[1,2", None), ("[1,2] x", None), ("", None), (None, None), ('{"a":1}', None), ("[1e-320,0]", [1.0, 0.0]), ("[1e300,0]", [1.0, 0.0]), ("[01,2]", None),
    ],
)
def test_unit(text, wanted):
    got = unit(text, 2)
    assert (got is None) == (wanted is None)
    if wanted:
        assert np.allclose(got, wanted)


def test_unit_vectors(spark):
    df = spark.createDataFrame([("a", "[3,4]", 1), ("a", "[3,4]", 2), ("a", "bad", 3), ("b", None, 1), (None, "[1,1]", 1), ("c", "[0,5]", 1)], "id string, v string, vector int")
    assert {r.record: np.frombuffer(r.vector, np.float32).tolist() for r in unit_vectors(df, "id", "v", 2).collect()} == {"a": pytest.approx([0.6, 0.8], abs=1e-6), "c": [0.0, 1.0]}
    arrays = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [None, 1.0])], "id string, v array<float>")
    assert [r.record for r in double_units(arrays, "id", "v", 2).collect()] == ["a"]


def cloud(n=1500, dim=12, groups=15, seed=0, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[np.arange(n) % groups] + rng.normal(0, spread / dim**0.5, (n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), centres, np.arange(n) % groups


def frame(spark, x, names=None):
    return spark.createDataFrame([((names or [f"v{i:05d}" for i in range(len(x))])[i], [float(c) for c in r], "clash", 0) for i, r in enumerate(x)], "record string, vector array<float>, query string, part int")


def exact(x, names, k):
    """The k nearest of each; names are in order."""
    s = x.astype(np.float64) @ x.astype(np.float64).T
    np.fill_diagonal(s, -np.inf)
    return {names[i]: [(-s[i, j], names[j]) for j in np.argsort(-s[i], kind="stable")[:k]] for i in range(len(x))}


def test_recall_of_learned_partitions(spark):
    x, _, _ = cloud()
    names = [f"v{i:05d}" for i in range(len(x))]
    df = frame(spark, x)  # an array of numbers serves too
    got = knn.nearest(df, 12, k=10, part_rows=100, sample=1000, cell_rows=64).collect()
    want = exact(x, names, 10)
    per = {}
    for r in got:
        per.setdefault(r["query"], {})[r.rnk] = (r.neighbour, r.cosine)
    assert set(per) == set(names) and all(sorted(v) == list(range(1, 11)) for v in per.values())
    hits = sum(len({n for n, _ in per[q].values()} & {n for _, n in want[q]}) for q in names)
    assert hits / (10 * len(names)) >= 0.9
    assert all(abs(c - float(x[int(q[1:])].astype(float) @ x[int(n[1:])].astype(float))) < 1e-6 for q in names[:50] for n, c in per[q].values())


def test_one_part_is_exact_with_ties_and_a_threshold(spark):
    x, _, _ = cloud(200)
    x[50:80] = x[50]  # copies: equal cosines go by name
    names = [f"v{i:05d}" for i in range(len(x))]
    df = frame(spark, x)
    got = {}
    for r in knn.nearest(df, 12, k=5).collect():
        got.setdefault(r["query"], []).append((r.rnk, r.neighbour))
    want = exact(x, names, 5)
    for q in names[50:80]:
        assert [n for _, n in sorted(got[q])] == [n for n in names[50:80] if n != q][:5]
    others = [q for q in names if not 50 <= int(q[1:]) < 80]
    same = sum({n for _, n in got[q]} == {n for _, n in want[q]} for q in others)
    assert same >= 0.97 * len(others)  # the rest are ties at the last place within rounding
    near = knn.nearest(df, 12, k=5, least=0.99).collect()
    assert {(r["query"], r.neighbour) for r in near} == {(q, n) for q in got for _, n in got[q] if float(x[int(q[1:])].astype(float) @ x[int(n[1:])].astype(float)) >= 0.99}


def dense(n=3000, dim=12, seed=5):
    """A third of the rows in one theme without directions, which is cut into many parts; the rest in small ones."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(41, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[np.where(np.arange(n) % 3, 1 + np.arange(n) % 40, 0)] + rng.normal(0, 0.12, (n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_a_least_cosine_misses_nothing_in_a_dense_theme(spark):
    x = dense()
    names = [f"v{i:05d}" for i in range(len(x))]
    got = {(r["query"], r.neighbour) for r in knn.nearest(frame_of(spark, x), 12, k=10, least=0.93, part_rows=50, sample=2000).collect()}
    want = {(q, n) for q, near in exact(x, names, 10).items() for s, n in near if -s >= 0.93}
    assert got == want and len(want) > 1000


def test_recall_in_a_dense_theme(spark):
    x = dense()
    names = [f"v{i:05d}" for i in range(len(x))]
    got = {(r["query"], r.neighbour) for r in knn.nearest(frame_of(spark, x), 12, k=10, part_rows=50, sample=2000).collect()}
    want = {(q, n) for q, near in exact(x, names, 10).items() for _, n in near if int(q[1:]) % 3 == 0}
    assert len(got & want) >= 0.9 * len(want)


def test_queries_and_small_tables(spark):
    x, _, _ = cloud(40)
    df = frame(spark, x)
    some = df.where("record < 'v00003'")
    assert {r["query"] for r in knn.nearest(df, 12, k=3, queries=some).collect()} == {"v00000", "v00001", "v00002"}
    assert knn.nearest(df.limit(0), 12).count() == 0
    assert knn.nearest(df.limit(1), 12).count() == 0
    assert knn.nearest(df.where("record < 'v00003'"), 12).count() == 6


def test_balanced_parts():
    x, _, _ = cloud(900)
    parts = knn.balanced_parts(x, knn.neighbour_graph(x, 8), 9)
    assert np.bincount(parts, minlength=9).max() <= 1.25 * 100


def test_two_levels_of_parts(spark):
    x = dense(1500)
    names = [f"v{i:05d}" for i in range(len(x))]
    df = frame_of(spark, x)
    two = dict(part_rows=60, fan_out=6, sample=1000, cell_rows=50, query_rows=400)  # 25 parts: 5 of the first level, about 5 in each
    got = {(r["query"], r.neighbour) for r in knn.nearest(df, 12, k=10, least=0.93, **two).collect()}
    want = exact(x, names, 10)
    assert got == {(q, n) for q, near in want.items() for s, n in near if -s >= 0.93}
    got = {(r["query"], r.neighbour) for r in knn.nearest(df, 12, k=10, **two).collect()}
    assert len(got & {(q, n) for q, near in want.items() for _, n in near}) >= 0.9 * 10 * len(names)


@pytest.mark.parametrize("spread", [0.25, 2.0])
def test_features_add_up(spread):
    x, _, _ = cloud(900, spread=spread)
    x = x.astype(float)
    tree, out = birch.CFTree(12, 0.1, width=4), []
    for lo in range(0, 900, 64):
        part = x[lo : lo + 64]
        tree.insert(np.ones(len(part)), part, (part**2).sum(1))
        if tree.leaves > 80:
            out.append(tree.relieve(80))
            assert tree.leaves <= 60
    n, ls, ss = (np.concatenate(p) for p in zip(tree.entries(), *out))
    assert n.sum() == 900 and np.allclose(ls.sum(0), x.sum(0)) and np.isclose(ss.sum(), (x**2).sum())
    assert birch.fits(n, ls, ss, 0.1).all()  # the radius never grows
    assert (len(out) > 0) == (spread > 1)


def test_equal_vectors_are_one_feature():
    tree = birch.CFTree(2, 0.1, width=4)
    tree.insert(np.ones(5000), np.tile([0.6, 0.8], (5000, 1)), np.ones(5000))
    assert tree.entries()[0].tolist() == [5000]


def planted(clusters, each, dim=32, noise=0.25, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = np.repeat(centres, each, axis=0) + rng.normal(0, noise / dim**0.5, (clusters * each, dim))
    x = x[rng.permutation(len(x))]
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), centres


@pytest.mark.parametrize(("clusters", "each"), [(3000, 10), (6000, 5)])
def test_planted_clusters_are_found_however_many(spark, clusters, each):
    x, centres = planted(clusters, each)
    found = birch.fit(frame_of(spark, x).repartition(4), 32, 0.1)
    met = np.concatenate([(centres[a : a + 500] @ found.centroids.T).max(1) for a in range(0, clusters, 500)])
    assert (met > 0.9).mean() >= 0.95


def frame_of(spark, x):
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame({"record": [f"v{i:05d}" for i in range(len(x))], "vector": [r.tobytes() for r in x]}), "record string, vector binary")


def test_a_small_theme_among_single_vectors_gets_a_centroid(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 32))
    themes = rng.normal(size=(6, 32))
    themes /= np.linalg.norm(themes, axis=1, keepdims=True)
    for t in range(6):  # ten members each, far apart in the table
        x[t * 7 + 299 * np.arange(10)] = themes[t] + rng.normal(0, 0.03, (10, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = frame_of(spark, x).repartition(4)  # every vector is in one feature:
    assert birch.summaries(df, 32, 0.1, max_leaves=60, per_cell=100).selectExpr("sum(n)").first()[0] == 3000
    assert (themes @ birch.fit(df, 32, 0.1, max_leaves=60, per_cell=(100, 80)).centroids.T).max(1).min() > 0.9


def test_more_centroids_than_are_held(spark):
    x, centres = planted(300, 6, 16, 0.1)
    df = frame_of(spark, x)
    found = birch.fit(df, 16, 0.1, most_held=20)
    assert found.centroids is None and found.table.count() >= 290
    rows = birch.assign(df, 16, found).collect()
    assert len(rows) == len(x) and sum(r.cosine > 0.9 for r in rows) >= 0.97 * len(x)
    refs = [(f"c{i}", c) for i, c in enumerate(centres[:40])]
    want = {(f"v{i:05d}", f"c{j}") for i, j in zip(*np.nonzero(x.astype(float) @ centres[:40].T >= 0.9))}
    assert {(r.record, r.reference) for r in birch.near_references(df, 16, found, refs, 0.9).collect()} == want


def test_assignment_is_exact_and_the_same_however_many_centroids(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x, centres = planted(300, 5, 16, 0.1)
    x[::3] = rng.normal(size=(500, 16))  # rows in no cluster have many centroids about as near
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres[200] = centres[3]  # equal centroids: the first
    x[:5] = centres[3]
    table = spark.createDataFrame([(i, c.tobytes()) for i, c in enumerate(centres)], "cluster bigint, vector binary").repartition(3)
    sims = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True) @ centres.T
    df, refs = frame_of(spark, x), [(f"c{i}", c) for i, c in enumerate(centres[:40])]
    many, few = birch.Clusters(table, None), birch.Clusters(table, centres)
    rows = [sorted((r.record, r.cluster, r.cosine) for r in birch.assign(df, 16, found).collect()) for found in (many, few)]
    assert rows[0] == rows[1] and len(rows[0]) == len(x)
    cluster, cosine = np.array([r[1] for r in rows[0]]), np.array([r[2] for r in rows[0]])
    assert (cluster[:5] == 3).all() and 200 not in cluster
    assert np.abs(cosine - sims.max(1)).max() < 1e-14 and np.abs(sims[np.arange(len(x)), cluster] - sims.max(1)).max() < 1e-14
    near = [sorted((r.record, r.reference, r.cosine) for r in birch.near_references(df, 16, found, refs, 0.8).collect()) for found in (many, few)]
    assert near[0] == near[1] and {r[:2] for r in near[0]} == {(f"v{i:05d}", f"c{j}") for i, j in zip(*np.nonzero(x.astype(float) @ centres[:40].T >= 0.8))}
    for sizes in ((256, 1024, 1 << 15), (7, 11, 5)):
        for name, size in zip(("ROWS", "BLOCK", "PAIRS"), sizes):
            monkeypatch.setattr(birch, name, size)
        got = many.shipped.nearest(x)
        assert got[0].tolist() == cluster.tolist() and got[1].tolist() == cosine.tolist()


def test_clusters_are_numbered_from_0_on_by_size(spark):
    x, _ = planted(300, 6, 16, 0.1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the sort has several tasks, as in a large table
    try:
        many, few = birch.fit(frame_of(spark, x), 16, 0.1, most_held=20), birch.fit(frame_of(spark, x), 16, 0.1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    numbers = [r.cluster for r in many.table.orderBy("cluster").collect()]
    assert numbers == list(range(len(numbers))) and len(numbers) >= 290
    assert (many.shipped.rows() == few.centroids).all()


def test_ward_joins_the_nearest_first():
    centres = np.array([[0.0, 0], [0.1, 0], [5, 0], [5.1, 0], [20, 0]])
    n = np.array([2.0, 1, 1, 3, 1])
    label = birch.ward(n, centres * n[:, None], (centres**2).sum(1) * n, 0.5)
    assert label[0] == label[1] and label[2] == label[3] and len(set(label)) == 3


def test_clusters_of_blobs(spark):
    x, centres, truth = cloud(900, spread=0.2)
    df = frame(spark, x).repartition(5)
    assigned, found = birch.similarity_clusters(df, 12, radius2=0.15)
    rows = assigned.collect()
    assert len(rows) == 900 and len(found.centroids) >= 15
    groups = {}
    for r in rows:
        groups.setdefault(r.cluster, []).append(truth[int(r.record[1:])])
    pure = sum(max(np.bincount(g)) for g in groups.values()) / 900
    assert pure > 0.97
    table = birch.describe(assigned, 3).collect()
    assert sum({r.cluster: r.size for r in table}.values()) == 900
    assert all(r.rnk <= 3 for r in table)


def test_references_are_complete(spark):
    rng = np.random.default_rng(3)
    x, centres, _ = cloud(700)
    x[:100] = rng.normal(size=(100, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = frame(spark, x)
    found = birch.fit(df, 12, 0.15)
    refs = [(f"c{i}", c) for i, c in enumerate(centres)]
    want = {(f"v{i:05d}", f"c{j}") for i, j in zip(*np.nonzero(x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True) @ centres.T >= 0.8))}
    assert {(r.record, r.reference) for r in birch.near_references(df, 12, found, refs, 0.8).collect()} == want
    table = spark.createDataFrame([(n, c.astype(float).tobytes()) for n, c in refs], "record string, vector binary")
    assert {(r.record, r.reference) for r in birch.references_in_blocks(df, 12, found, table, 0.8, block=4).collect()} == want


def test_no_vectors(spark):
    df = spark.createDataFrame([], "record string, vector array<float>")
    assigned, found = birch.similarity_clusters(df, 12)
    assert assigned.count() == 0 and len(found.centroids) == 0
    assert json.dumps(birch.describe(assigned).columns)
