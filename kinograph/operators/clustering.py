"""Clusters of vectors: assignment by relative distance, statistics, k-means."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinograph import session
from kinograph.functions.vectors import normalize

#: Centroids that one task holds at a time; more are an error, not a slow plan.
MOST_CENTROIDS = 100_000
#: Distances that a task holds at a time.
BLOCK_CELLS = 4_000_000
_ASSIGNED = pa.schema([("item_id", pa.string()), ("cluster_id", pa.string()), ("rank", pa.int32()), ("distance", pa.float64())])


def centroid_table(clusters: DataFrame, key: str, vector: Column, normalized: bool) -> tuple[list[str], np.ndarray]:
    """The usable centroids, by key, on the driver: a table of a known small size, which is checked."""
    unit = normalize(vector) if normalized else vector
    rows = clusters.select(F.col(key).cast("string").alias("k"), unit.alias("v")).where(F.col("v").isNotNull()).orderBy("k").limit(MOST_CENTROIDS + 1).collect()
    if len(rows) > MOST_CENTROIDS:
        raise ValueError(f"more than {MOST_CENTROIDS} centroids")
    dims = {len(r.v) for r in rows}
    if len(dims) > 1:
        raise ValueError("centroids of different lengths")
    return [r.k for r in rows], np.array([r.v for r in rows]).reshape(len(rows), -1)


def assign_nearest(items: DataFrame, key: str, vector: str, names: list[str], centroids: np.ndarray, most: int = 4, multiplier: float | None = 1.4) -> DataFrame:
    """(item_id, cluster_id, rank, distance): each item's nearest centroids.

    At most ``most`` of them, and beyond the nearest only those within
    ``multiplier`` times its distance (None: no such bound).  Equal distances:
    by cluster_id.  Items without a vector of the centroids' length are left
    out.  Row-local: no shuffle; a batch of items meets the centroids in one
    matrix product.
    """
    most = min(most, max(1, len(names)))
    labels = np.array(names, dtype=object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(names):
            return
        squares = (centroids**2).sum(1)
        at_once = max(1, min(2048, BLOCK_CELLS // len(names)))
        for batch in batches:
            for lo in range(0, batch.num_rows, at_once):
                part = batch.slice(lo, at_once)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                own = (x**2).sum(1)
                rough = own[:, None] + squares - 2 * x @ centroids.T
                rounding = 16 * (dim + 4) * np.finfo(float).eps * (own + squares.max())
                bound = np.partition(rough, most - 1, axis=1)[:, most - 1] + rounding
                rows, near = np.nonzero(rough <= bound[:, None])  # all ties of the last place
                exact = np.concatenate([np.sqrt(((x[rows[b : b + 65536]] - centroids[near[b : b + 65536]]) ** 2).sum(1)) for b in range(0, len(rows), 65536)])
                order = np.lexsort((near, exact, rows))  # centroids come by name, so places order names
                rows, near, exact = rows[order], near[order], exact[order]
                first = np.searchsorted(rows, rows)
                rank = (np.arange(1, len(rows) + 1) - first).astype(np.int32)
                keep = rank <= most
                if multiplier is not None:
                    keep &= (exact <= exact[first] * multiplier) | (rank == 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows[keep])), pa.array(labels[near[keep]], pa.string()), pa.array(rank[keep]), pa.array(exact[keep])], schema=_ASSIGNED
                )

    dim = centroids.shape[1] if len(names) else 0
    usable = items.select(F.col(key).cast("string").alias("item_id"), F.col(vector).alias("v")).where(F.size("v") == dim)
    return usable.mapInArrow(run, "item_id string, cluster_id string, rank int, distance double")


def clusters_per_item(assigned: DataFrame, item: str = "item_id", most: int = 4) -> DataFrame:
    """(n_clusters, n_items) for 1 to ``most`` clusters an item, zero counts included."""
    counts = assigned.groupBy(item).agg(F.count("*").alias("n_clusters")).groupBy("n_clusters").agg(F.count("*").alias("c"))
    bins = assigned.sparkSession.range(1, most + 1).select(F.col("id").alias("n_clusters"))
    return bins.join(counts, "n_clusters", "left").select("n_clusters", F.coalesce("c", F.lit(0)).cast("bigint").alias("n_items"))


def popularity(assigned: DataFrame, votes: DataFrame) -> DataFrame:
    """(cluster_id, film_count, avg_vote_count) over all assignment rows; ``votes`` is (movie_id, vote_count), one row each."""
    return (
        assigned.select("movie_id", "cluster_id")
        .distinct()
        .join(votes, "movie_id")
        .groupBy("cluster_id")
        .agg(F.count("*").alias("film_count"), F.avg("vote_count").alias("avg_vote_count"))
    )


def recount(members: DataFrame, affected: DataFrame, group: str, name: str = "n") -> DataFrame:
    """The exact number of members of each affected group; one without members has 0."""
    ids = affected.select(group).where(F.col(group).isNotNull()).distinct()
    counts = members.join(ids, group, "left_semi").groupBy(group).agg(F.count("*").alias(name))
    return ids.join(counts, group, "left").select(group, F.coalesce(name, F.lit(0)).cast("bigint").alias(name))


_SUM = "g string, n bigint, v array<double>"


def _add_up(batches: Iterable[pa.RecordBatch], most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows (g, n, v) added up by g, in any order; ``most`` groups are held, the others go on as they are.

    Rows of a group that come together give one row as long as no more groups come in one batch.
    """
    held: dict[str | None, list] = {}

    def out(keys: list) -> pa.RecordBatch:
        rows = [held.pop(k) for k in keys]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["g", "n", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        groups = pc.dictionary_encode(batch.column(0), null_encoding="encode")
        code, names = groups.indices.to_numpy(), groups.dictionary.to_pylist()
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        if len(x) % batch.num_rows or pc.min(pc.list_value_length(batch.column(2))).as_py() * batch.num_rows != len(x):
            raise ValueError("vectors of different lengths")
        sums = np.zeros((len(names), len(x) // batch.num_rows))
        np.add.at(sums, code, x.reshape(batch.num_rows, -1))
        counts = np.bincount(code, weights=batch.column(1).to_numpy(), minlength=len(names))
        for i, g in enumerate(names):
            have = held.setdefault(g, [0, 0.0])
            have[0] += int(counts[i])
            have[1] = have[1] + sums[i]
        if len(held) > most:
            last = names[code[-1]]
            yield out([g for g in held if g != last])
    if held:
        yield out(list(held))


def vector_sums(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(g string, n, v): rows and sum of the vectors of each group.  A task sends one row a group, which are added up by group; null vectors do not count."""
    first = df.select(F.col(group).cast("string").alias("g"), F.lit(1).cast("bigint").alias("n"), F.col(vector).alias("v")).where(F.col("v").isNotNull()).mapInArrow(_add_up, _SUM)
    return first.repartition(session.shuffle_partitions(df.sparkSession), "g").sortWithinPartitions("g").mapInArrow(_add_up, _SUM)


def mean_vectors(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, centroid, n): the mean vector of each group; a null group is one."""
    sums = vector_sums(df, group, vector)
    return sums.select(F.col("g").cast(dict(df.dtypes)[group]).alias(group), F.transform("v", lambda x: x / F.col("n")).alias("centroid"), "n")


def component_means(df: DataFrame, group: str, vector: str) -> DataFrame:
    """``mean_vectors`` as (group, pos, mean, n), a row per component."""
    return mean_vectors(df, group, vector).select(group, F.posexplode("centroid").alias("pos", "mean"), "n")


_ROUND = pa.schema([("g", pa.string()), ("n", pa.int64()), ("v", pa.list_(pa.float64()))])


def lloyd(items: DataFrame, vector: str, start: np.ndarray, most_rounds: int = 100, tolerance: float = 0.0) -> tuple[np.ndarray, int]:
    """k-means from given centroids: (centroids, rounds).

    Each round is one pass: a task sums its rows per cluster.  The sums go to
    the driver where they are BLOCK_CELLS numbers at most, else they are first
    added up by cluster, so that k rows reach it.  A cluster without rows
    keeps its centroid.  Stops when no row changes its cluster (each row meets
    the centroids of the round before too, so nothing is kept between rounds),
    or when no centroid moves more than ``tolerance``; below 0 neither stops
    it.  Equal distances: the first centroid.
    """
    rows = items.select(F.col(vector).alias("v")).where(F.size("v") == start.shape[1])
    centroids, before = start.astype(float), None
    direct = rows.rdd.getNumPartitions() * start.size <= BLOCK_CELLS
    for r in range(1, most_rounds + 1):
        sums, counts, changed = _round(rows, centroids, before, direct)
        if before is not None and not changed and tolerance >= 0:
            return centroids, r - 1
        new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
        moved = np.sqrt(((new - centroids) ** 2).sum(1)).max(initial=0.0)
        before, centroids = centroids, new
        if moved <= tolerance:
            return centroids, r
    return centroids, most_rounds


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    at_once = max(1, BLOCK_CELLS // len(centroids))
    squares = (centroids**2).sum(1)
    return np.concatenate([(squares - 2 * x[a : a + at_once] @ centroids.T).argmin(1) for a in range(0, len(x), at_once)])


def _round(rows: DataFrame, centroids: np.ndarray, before: np.ndarray | None, direct: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(sums, counts, rows whose cluster is another than with the centroids ``before``)."""
    k, dim = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, changed = np.zeros((k, dim)), np.zeros(k, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                near = _nearest(x, centroids)
                order = np.argsort(near, kind="stable")
                used, first = np.unique(near[order], return_index=True)
                sums[used] += np.add.reduceat(x[order], first, axis=0)
                counts += np.bincount(near, minlength=k)
                changed += 0 if before is None else int((near != _nearest(x, before)).sum())
        used = np.flatnonzero(counts)
        names, n, v = [*map(str, used), "changed"], [*counts[used].tolist(), changed], [*sums[used], np.zeros(dim)]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n, pa.int64()), pa.array(v, pa.list_(pa.float64()))], schema=_ROUND)

    parts = rows.mapInArrow(run, _SUM)
    if not direct:
        width = min(k + 1, session.shuffle_partitions(rows.sparkSession))
        parts = parts.repartition(width, "g").sortWithinPartitions("g").mapInArrow(_add_up, _SUM)  # k + 1 rows
    total = parts.toArrow()
    sums, counts, changed = np.zeros((k, dim)), np.zeros(k), 0
    if total.num_rows:
        names, n = total["g"].to_pylist(), total["n"].to_numpy()
        v = total["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        at = np.array([-1 if g == "changed" else int(g) for g in names])
        order = np.lexsort((v[:, 0], at))  # the same sums whatever the order in which tasks end
        at, n, v = at[order], n[order], v[order]
        changed = int(n[at < 0].sum())
        np.add.at(sums, at[at >= 0], v[at >= 0])
        np.add.at(counts, at[at >= 0], n[at >= 0])
    return sums, counts, changed


def _counts(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """How many rows are nearest to each centroid."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += np.bincount(_nearest(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), centroids), minlength=len(centroids))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centroids))), pa.array(counts)], names=["c", "n"])

    out = np.zeros(len(centroids))
    for row in rows.mapInArrow(run, "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n")).collect():  # a row per centroid
        out[row.c] = row.n
    return out


def nearest_squares(items: DataFrame, key: str, vector: str, centroids: np.ndarray) -> DataFrame:
    """(key string, vector, d2): the squared distance of every row to its nearest centroid."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centroids**2).sum(1)
        at_once = max(1, BLOCK_CELLS // len(centroids))
        for batch in batches:
            for lo in range(0, batch.num_rows, at_once):
                part = batch.slice(lo, at_once)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                d2 = np.maximum((x**2).sum(1) + (squares - 2 * x @ centroids.T).min(1), 0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(d2)], names=[key, vector, "d2"])

    rows = items.select(F.col(key).cast("string").alias(key), F.col(vector).alias(vector)).where(F.size(vector) == centroids.shape[1])
    return rows.mapInArrow(run, f"`{key}` string, `{vector}` array<double>, d2 double")


def weighted_start(items: DataFrame, key: str, vector: str, k: int, seed: int = 42, oversample: int = 2, rounds: int = 5) -> np.ndarray:
    """k starting centroids, far apart with high probability: each round every row is drawn with a chance in proportion to its
    squared distance from those drawn so far; the draws, weighted by the rows nearest to them, are then thinned to k the same way.

    The chance of a row comes from a hash of its key, so the draw does not depend on the layout.  The draws of a round are
    k * oversample by expectation, whatever the number of rows; all of them are taken.  This is the distributed form of
    drawing one centroid after the other.
    """
    rows = items.select(F.col(key).cast("string").alias("k"), F.col(vector).alias("v")).where(F.col("v").isNotNull())
    first = rows.orderBy(F.xxhash64(F.lit(seed), "k"), "k").limit(1).collect()
    if not first:
        raise ValueError("no vector to start from")
    chosen = np.array([first[0].v])
    for r in range(rounds):
        far = nearest_squares(rows, "k", "v", chosen)
        total = far.agg(F.sum("d2")).first()[0] or 0.0
        if total <= 1e-12:
            break
        chance = F.pmod(F.xxhash64(F.lit(seed + r + 1), "k"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = far.where(chance < F.col("d2") * F.lit(oversample * k / total)).collect()
        if drawn:
            chosen = np.concatenate([chosen, np.array([d.v for d in sorted(drawn, key=lambda d: d.k)])])
    if len(chosen) <= k:
        return chosen
    weight = _counts(rows.select("v"), chosen)
    rng = np.random.default_rng(seed)
    picked = [int(weight.argmax())]
    d2 = ((chosen - chosen[picked[0]]) ** 2).sum(1)
    while len(picked) < k:
        p = d2 * np.maximum(weight, 1e-9)
        p[picked] = 0
        left = np.setdiff1d(np.arange(len(chosen)), picked)
        picked.append(int(rng.choice(len(chosen), p=p / p.sum())) if p.sum() > 0 else int(left[0]))
        d2 = np.minimum(d2, ((chosen - chosen[picked[-1]]) ** 2).sum(1))
    return chosen[picked]


def kmeans_mllib(items: DataFrame, key: str, vector: str, k: int, seed: int = 42, most_rounds: int = 100) -> DataFrame:
    """(item_id, cluster) by MLlib's k-means on vectors of length 1, Euclidean, so that centroids stay plain means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    unit = items.select(F.col(key).cast("string").alias("item_id"), array_to_vector(normalize(F.col(vector))).alias("features"))
    if unit.limit(k).count() < k:
        raise ValueError(f"fewer rows than k = {k}")
    model = KMeans(k=k, seed=seed, maxIter=most_rounds, distanceMeasure="euclidean").fit(unit)
    return model.transform(unit).select("item_id", F.col("prediction").alias("cluster"))
