from datetime import date

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from kinograph import schemas
from kinograph.operators import catalog, clustering, credits, keywords, rails
from kinograph.plans import queries


def test_latest_and_not_in(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None), ("b", 2), (None, 9)], "id string, n int")
    assert rows(catalog.latest_per_key(df, "id", F.col("n").desc_nulls_last())) == sorted([("a", 3), ("b", 2), (None, 9)], key=repr)
    other = spark.createDataFrame([("a",), (None,), ("a",)], "x string")
    assert rows(catalog.not_in(df, other, "id", "x")) == sorted([("b", None), ("b", 2), (None, 9)], key=repr)
    many = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    assert catalog.not_in(many, many.where("id < 4000"), "id").count() == 1000


def test_tiered_rank(spark, rows):
    first = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("b", 6.0)], "id string, s double")
    second = spark.createDataFrame([("b", 99.0), ("c", 7.0), ("d", 7.0), ("e", None)], "id string, s double")
    assert rows(catalog.tiered_rank([(first, "s"), (second, "s")], 4), "rank", "id", "tier") == [(1, "b", 0), (2, "a", 0), (3, "c", 1), (4, "d", 1)]
    assert catalog.tiered_rank([(first.limit(0), "s")], 4).count() == 0


def test_recent_cutoff_runs_over(spark, rows):
    movies = spark.createDataFrame([("old", "2026-03-02", 50.0, 0), ("new", "2026-03-03", 20.0, 0), ("dull", "2026-05-01", 19.9, 20), ("bad", "", 99.0, None)], "id string, release_date string, popularity double, vote_count int")
    from kinograph.functions.text import months_back

    cutoff = months_back(F.lit(date(2026, 8, 31)), 6)
    assert rows(catalog.recent_and_established(movies, cutoff), "rank", "id") == [(1, "new"), (2, "dull")]


def test_flat_movie(spark):
    detail = [
        '{"id":1,"title":"T","release_date":"","tagline":"","budget":0,"poster_path":"/p","backdrop_path":"","genres":[{"name":"G"}],"keywords":{"keywords":[{"name":"K"}]},'
        '"credits":{"cast":[' + ",".join(f'{{"name":"c{i}"}}' for i in range(12)) + '],"crew":[{"name":"d","job":"Director"},{"name":"e","job":"Editor"}]}}',
        '{"id":2,"release_date":"1999-05-01"}',
    ]
    df = spark.createDataFrame([(x,) for x in detail], "j string").select(F.from_json("j", schemas.MOVIE_DETAIL).alias("d")).select("d.*")
    one, two = catalog.flat_movie(df, "http://i/").orderBy("tmdb_id").collect()
    assert (one.release_date, one.release_year, one.tagline, one.budget, one.poster_url, one.backdrop_url) == (None, None, None, 0, "http://i/w500/p", None)
    assert one.top_cast == [f"c{i}" for i in range(10)]
    assert (one.directors, one.keywords, one.genres, one.production_companies) == (["d"], ["K"], ["G"], [])
    assert (two.release_year, two.top_cast, two.poster_url) == (1999, [], None)


def test_page_and_missing(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", []), ("c", ["x"])], "id string, k array<string>")
    assert rows(catalog.page(df, "id", "a", 1), "id") == [("b",)]
    assert rows(catalog.page(df, "id", None, 2), "id") == [("a",), ("b",)]
    assert rows(catalog.missing_values(df, "k"), "id") == [("a",), ("b",)]


def blobs(spark, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.eye(3, 8) * 10
    data = [(str(i), i % 3, [float(x) for x in centres[i % 3] + rng.normal(0, 0.3, 8)]) for i in range(150)]
    return spark.createDataFrame(data, "id string, blob int, v array<double>")


def recovered(pairs):
    return len({frozenset(i for i, c in pairs if c == k) for k in {c for _, c in pairs}}), {c for _, c in pairs}


def test_mean_vectors(spark, rows):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), (None, [5.0, 6.0]), ("b", None)], "g string, v array<double>")
    assert rows(clustering.mean_vectors(df, "g", "v")) == sorted([("a", [2.0, 3.0], 2), (None, [5.0, 6.0], 1)], key=repr)
    assert clustering.mean_vectors(df.limit(0), "g", "v").count() == 0
    with pytest.raises(Exception, match="different lengths"):
        clustering.mean_vectors(spark.createDataFrame([("a", [1.0]), ("a", [3.0, 4.0])], "g string, v array<double>").coalesce(1), "g", "v").collect()


def test_sums_of_more_groups_than_are_held():
    import pyarrow as pa

    names = [f"g{i % 40}" for i in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array(names[a : a + 50]), pa.array([1] * 50), pa.array([[float(i)] for i in range(a, a + 50)])], names=["g", "n", "v"]) for a in range(0, 400, 50)]
    total = {}
    for batch in clustering._add_up(batches, most=7):
        for g, n, v in zip(*(c.to_pylist() for c in batch.columns)):
            m, x = total.get(g, (0, 0.0))
            total[g] = m + n, x + v[0]
    assert total == {f"g{k}": (10, sum(range(k, 400, 40))) for k in range(40)}


def test_start_never_repeats_a_row(spark):
    same = spark.createDataFrame([(str(i), [float(i % 4), 0.0]) for i in range(60)], "id string, v array<double>")
    start = clustering.weighted_start(same, "id", "v", 4)
    assert len(start) <= 4 and len(np.unique(start, axis=0)) == len(start)


@pytest.mark.parametrize("cells", [4_000_000, 10])
def test_lloyd_stops_when_no_row_moves(spark, monkeypatch, cells):
    monkeypatch.setattr(clustering, "BLOCK_CELLS", cells)  # the sums go straight to the driver, or by cluster
    df = blobs(spark)
    start = np.eye(3, 8) * 9
    centroids, rounds = clustering.lloyd(df, "v", start, 50)
    assert rounds <= 3
    again, _ = clustering.lloyd(df, "v", start, 5, -1.0)
    assert np.allclose(centroids, again)


def test_by_votes(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9), ("d", 5)], "id string, vote_count int")
    assert [r[2] for r in rows(catalog.by_votes(df), "rank", "vote_count", "id")] == ["b", "c", "a", "d"]
    assert [r[1] for r in rows(catalog.by_votes(df, nulls_first=False), "rank", "id")] == ["c", "a", "d", "b"]
    assert catalog.by_votes(df.limit(0)).count() == 0


def test_one_row_of_a_movie_is_always_the_same(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 1, None)], "id string, vote_count int, title string")
    for order in (F.col("title"), F.desc("title")):
        assert catalog.movies_once(df.orderBy(order).coalesce(1)).first().title == "y"


def test_three_blobs_own_and_mllib(spark):
    df = blobs(spark)
    truth = dict(df.select("id", "blob").collect())
    start = clustering.weighted_start(df, "id", "v", 3)
    centroids, rounds = clustering.lloyd(df, "v", start)
    assert rounds < 100
    own = clustering.assign_nearest(df, "id", "v", ["a", "b", "c"], centroids, 1, None).select("item_id", "cluster_id").collect()
    for got in (own, clustering.kmeans_mllib(df, "id", "v", 3).collect()):
        assert len({(truth[i], c) for i, c in got}) == 3 and len(got) == 150
    with pytest.raises(ValueError):
        clustering.kmeans_mllib(df, "id", "v", 151)


def test_lloyd_keeps_an_empty_cluster(spark):
    df = spark.createDataFrame([("1", [0.0, 0.0]), ("2", [2.0, 0.0])], "id string, v array<double>")
    centroids, _ = clustering.lloyd(df, "v", np.array([[1.0, 0.0], [50.0, 50.0]]))
    assert centroids.tolist() == [[1.0, 0.0], [50.0, 50.0]]


def test_kmeans_own_asks_for_as_many_clusters_as_the_reference(spark, monkeypatch):
    asked, start = [], clustering.weighted_start
    monkeypatch.setattr(clustering, "weighted_start", lambda items, key, vector, k: asked.append(k) or start(items, key, vector, k))
    assert queries.kmeans_own(spark, DATA).count() > 0 and asked == [200]


def test_assign_nearest(spark, rows):
    items = spark.createDataFrame([("x", [0.0, 0.0]), ("short", [1.0]), ("none", None)], "id string, v array<double>")
    names, centroids = ["a", "b", "c", "d", "e"], np.array([[1.0, 0], [0, 1.0], [0, 1.3], [0, 1.5], [0, 1.2]])
    got = rows(clustering.assign_nearest(items, "id", "v", names, centroids, 4, 1.4), "rank", "cluster_id", "distance")
    assert got == [(1, "a", 1.0), (2, "b", 1.0), (3, "e", 1.2), (4, "c", 1.3)]  # ties by name, at most four
    assert rows(clustering.assign_nearest(items, "id", "v", names, centroids, 4, 1.1), "cluster_id") == [("a",), ("b",)]
    assert clustering.assign_nearest(items, "id", "v", [], np.zeros((0, 0))).count() == 0
    counts = clustering.clusters_per_item(clustering.assign_nearest(items, "id", "v", names, centroids, 4, 1.1))
    assert rows(counts) == [(1, 0), (2, 1), (3, 0), (4, 0)]


def test_popularity_and_recount(spark, rows):
    a = spark.createDataFrame([("m", "x"), ("m", "x"), ("n", "x"), ("n", "y"), ("gone", "y")], "movie_id string, cluster_id string")
    v = spark.createDataFrame([("m", 10), ("n", None)], "movie_id string, vote_count int")
    assert rows(clustering.popularity(a, v)) == [("x", 2, 10.0), ("y", 1, None)]
    affected = spark.createDataFrame([("x",), ("x",), ("z",), (None,)], "cluster_id string")
    assert rows(clustering.recount(a, affected, "cluster_id")) == [("x", 3), ("z", 0)]


def test_vocabulary(spark, rows):
    df = spark.createDataFrame([(["a", "a", None, "sequel"],), (["a", "sequel", "b"],), (None,), ([],)], "k array<string>")
    assert rows(keywords.vocabulary(df, "k", 2)) == [("a", 3)]


def test_slugs(spark, rows):
    df = spark.createDataFrame([(1, "X"), (2, "x!"), (3, "X 2"), (4, "x"), (5, None)], "id int, label string")
    assert rows(keywords.unique_slugs(df, "id", "label")) == [(1, "x"), (2, "x-2"), (3, "x-2-2"), (4, "x-3"), (5, "")]


def test_labels(spark, rows):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("h", " ")], "group string, item string")
    assert dict(rows(keywords.label_of(df, "group", "item")))["h"] == "Untitled Group"
    assert rows(keywords.sample_per_group(df, "group", "item", 1)) == rows(keywords.sample_per_group(df.orderBy("item"), "group", "item", 1))


REPLIES = [
    (1, '{"cast":[{"id":1,"name":"A","character":"x","order":0},{"id":1,"name":"A","character":"","order":1}],"crew":[{"id":1,"name":"A2","job":"Director","profile_path":"/z"},{"id":"2","name":"B","job":"Director"},{"id":3,"name":"C","job":"Editor"}]}'),
    (2, '{"cast":null,"crew":[]}'),
]


def test_credits(spark, rows):
    df = spark.createDataFrame(REPLIES, "movie_id bigint, j string").select("movie_id", F.from_json("j", schemas.CREDITS).alias("r")).select("movie_id", "r.*")
    billed = credits.billed(df)
    assert rows(billed, "movie_id", "tmdb_person_id", "credit_type", "character", "job") == sorted(
        [(1, 1, "cast", "x", None), (1, 1, "cast", None, None), (1, 1, "crew", None, "Director"), (1, 2, "crew", None, "Director")], key=repr
    )
    people = credits.people_last_wins(billed, "u/")
    assert rows(people, "tmdb_person_id", "name", "profile_url") == [(1, "A2", "u/w185/z"), (2, "B", None)]
    assert [[tuple(d) for d in r.director_credits] for r in credits.director_lists(billed).collect()] == [[(1, "A2"), (2, "B")]]
    assert credits.billed(df, cast_limit=1).where("credit_type = 'cast'").count() == 1


def test_upsert_and_patch(spark, rows):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "done")], "id int, name string, status string")
    source = spark.createDataFrame([(2, None), (3, "c")], "id int, name string")
    assert rows(credits.upsert(target, source, "id")) == sorted([(1, "a", "keep"), (2, None, "done"), (3, "c", None)], key=repr)
    assert rows(credits.patch(target, source, "id")) == sorted([(1, "a", "keep"), (2, None, "done")], key=repr)


def unit(x):
    return [float(v) for v in x / np.linalg.norm(x)]


def rail_movies(spark, n=60, seed=1):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(f"m{i:02d}", unit(rng.normal(size=6)), int(v)) for i, v in enumerate(rng.integers(0, 900, n))], "id string, vector array<double>, vote_count int")


P = rails.RailParams(top_k=5, net_size=20, visibility_floor=200, vote_ceiling=600, top_dims=2, gap=0.1)


def test_rails_are_disjoint_and_gated(spark):
    df = rail_movies(spark)
    votes, v = {r.id: r.vote_count for r in df.collect()}, {r.id: np.array(r.vector) for r in df.collect()}
    got = rails.rails(df, P).collect()
    assert len({(r.source_id, r.neighbour_id) for r in got}) == len(got)
    for r in got:
        assert r.source_id != r.neighbour_id and votes[r.neighbour_id] >= 200 and 1 <= r["rank"] <= 5
        if r.rail == "hidden_gem":
            assert votes[r.neighbour_id] < 600
        if r.rail == "darker_pick":
            assert v[r.neighbour_id][0] >= v[r.source_id][0] + 0.1
        if r.rail == "more_accessible":
            assert v[r.neighbour_id][0] <= v[r.source_id][0] - 0.1


def test_net_in_blocks_is_exact(spark, rows):
    df = rail_movies(spark)
    one = rows(rails.net(df.select("id", "vector"), df.select("id", "vector"), "closest_match", P), "source_id", "candidate_id")
    assert one == rows(rails.net(df.select("id", "vector"), df.select("id", "vector"), "closest_match", P, block_rows=7), "source_id", "candidate_id")
    x = {r.id: np.array(r.vector) for r in df.collect()}
    want = sorted((a, b) for a in x for b in sorted((b for b in x if b != a), key=lambda b: (-round(float(x[a] @ x[b]), 9), b))[:20])
    assert one == want


def test_rails_are_those_of_one_rail_after_the_other(spark):
    df = rail_movies(spark, 90, 5)
    rows_of = {r.id: (np.array(r.vector), r.vote_count) for r in df.collect()}
    taken, want = {s: [] for s in rows_of}, []
    for rail in rails.RAILS:
        for s, (q, _) in rows_of.items():
            cand = sorted(c for c, (_, v) in rows_of.items() if c != s and v >= 200 and (rail != "hidden_gem" or v < 600))
            m = np.array([rows_of[c][0] for c in cand])
            score = rails._scores(rail, q[None], m, q[None] @ m.T, P)[0]
            ranked = sorted((-round(float(x), 9), c) for x, c in zip(score, cand) if np.isfinite(x))[: P.net_size]
            for k, (x, c) in enumerate([r for r in ranked if r[1] not in taken[s]][: P.top_k]):
                want.append((s, rail, k + 1, c, -x))
            taken[s] += [c for a, r, _, c, _ in want if a == s and r == rail]
    got = [(r.source_id, r.rail, r["rank"], r.neighbour_id, r.score) for r in rails.rails(df, P).collect()]
    assert sorted(got) == sorted(want)


def test_incomplete(spark, rows):
    scored = spark.createDataFrame([("full",), ("one rail",), ("none",)], "id string")
    n = [("full", r) for r in rails.RAILS[2:] for _ in range(10)] + [("one rail", "darker_pick")] * 10 + [(None, "darker_pick")]
    df = spark.createDataFrame(n, "source_movie_id string, recommendation_type string")
    assert rows(rails.incomplete(scored, df, rails.RAILS[2:])) == [("none", 0), ("one rail", 0)]
    assert rows(rails.incomplete(scored, df, rails.RAILS[2:], observed=True)) == [("none", 0)]


def test_ties_at_the_last_place_go_by_name(spark, rows):
    centroids = np.array([[9.0, 0.0]] * 3 + [[0.0, 1.0]] * 8 + [[9.0, 0.0]] * 9 + [[1.0, 0.0]])
    names = [f"c{i:02d}" for i in range(len(centroids))]
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0])], "id string, v array<double>")
    for most, near, far in [(1, ["c20"], ["c03"]), (3, ["c20", "c03", "c04"], ["c03", "c04", "c05"]), (10, ["c20", *names[3:11], "c00"], [*names[3:11], "c20", "c00"])]:
        got = rows(clustering.assign_nearest(items, "id", "v", names, centroids, most, None), "item_id", "rank", "cluster_id")
        assert got == sorted([("a", i + 1, n) for i, n in enumerate(near)] + [("b", i + 1, n) for i, n in enumerate(far)], key=repr)
