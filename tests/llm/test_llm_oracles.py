import pytest
from compare import assert_same
from conftest import DATA

from kinograph.llm import queries as q

QUERIES, SQL = q.queries(), q.oracle_sql()


@pytest.mark.parametrize("name", sorted(set(SQL) - {"p10_held_out"}))  # too few labels at this scale
def test_same_as_sql(spark, duck, name):
    assert_same(spark, duck, QUERIES[name], SQL[name], DATA)


def test_the_clusters_decide_what_is_met(spark, monkeypatch):
    """With random centroids no theme is met by a cluster of its own, as p3_themes_met would show."""
    import numpy as np

    from kinograph.llm import birch

    real = birch.fit

    def random(vectors, dim, *_):
        rows = np.random.default_rng(0).normal(size=(40, dim))
        found = real(vectors.limit(0), dim)
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        table = vectors.sparkSession.createDataFrame([(i, r.tobytes()) for i, r in enumerate(rows)], "cluster bigint, vector binary")
        return birch.Clusters(table, rows) if found.centroids is not None else found

    folder = DATA.replace("sf0.001", "sf0.01")
    assert (lambda r: r.n_met == r.n_themes > 5)(q.p3_themes_met(spark, folder).first())
    monkeypatch.setattr(birch, "fit", random)
    assert q.p3_themes_met(spark, folder).first().n_met == 0


@pytest.mark.parametrize("name", ["p3_clusters", "p8_containers", "p9_spans", "p10_plain"])
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
