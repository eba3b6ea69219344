"""Recommendation rails: five ordered lists of neighbours per movie that never repeat each other, and their audit.

Scores and gates are this library's own reading of a service whose body is not
public; every threshold is a parameter.  Nearest movies are found exactly, in
one pass for all rails: candidates are cut into blocks of ``block_rows``, every
query goes to every block once, and only a block's best of each rail leave the
task.  As each rail drops at most ``top_k`` picks of each rail before it, the
first (i + 1) * top_k of rail i's net are all that can be picked, so no more
are kept.  The work is queries x candidates by nature; memory is one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinograph import session

RAILS = ("closest_match", "same_mood", "darker_pick", "more_accessible", "hidden_gem")
_HITS = pa.schema([("source_id", pa.string()), ("rail", pa.int32()), ("candidate_id", pa.string()), ("score", pa.float64())])


@dataclass(frozen=True)
class RailParams:
    top_k: int = 10
    net_size: int = 300
    visibility_floor: int = 250
    vote_ceiling: int = 5000
    top_dims: int = 5
    gap_dim: int = 0
    gap: float = 0.15


def _scores(rail: str, q: np.ndarray, c: np.ndarray, cosine: np.ndarray, p: RailParams) -> np.ndarray:
    """The rail's score of every query with every candidate; -inf where its gate bars."""
    if rail == "same_mood":
        # cosine on the query's largest dimensions only
        top = np.lexsort((np.broadcast_to(np.arange(q.shape[1]), q.shape), -np.abs(q)), axis=1)[:, : p.top_dims]
        mask = np.zeros_like(q)
        np.put_along_axis(mask, top, 1.0, 1)
        part = q * mask
        length = np.sqrt((part**2).sum(1))[:, None] * np.sqrt(mask @ (c**2).T)
        return np.divide(part @ c.T, length, out=np.full(length.shape, -1.0), where=length > 0)
    if rail == "darker_pick":
        return np.where(c[:, p.gap_dim][None] < q[:, p.gap_dim][:, None] + p.gap, -np.inf, cosine)
    if rail == "more_accessible":
        return np.where(c[:, p.gap_dim][None] > q[:, p.gap_dim][:, None] - p.gap, -np.inf, cosine)
    return cosine


def _best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the n largest of each row and all that tie with the last, but no -inf."""
    n = min(n, scores.shape[1])
    least = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
    row, column = np.nonzero((scores >= least[:, None] - 2e-9) & np.isfinite(scores))
    # equal vectors of other scale are equal, whatever the order of their sums
    score = np.round(scores[row, column], 9)
    order = np.lexsort((column, -score, row))
    row, column, score = row[order], column[order], score[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < n
    return row[keep], column[keep], score[keep]


def _block_search(wanted: tuple[tuple[int, str, int], ...], p: RailParams, chunk: int = 8192):
    """Rows come sorted by (block, role, id): a block's candidates (role 0), then queries (role 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, role = batch.column("block").to_numpy(), batch.column("role").to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                if block[lo] != at:
                    at, held, ready = block[lo], [], None
                if role[lo] == 0:
                    held.append(part)
                    continue
                if ready is None:
                    if not held:
                        continue
                    names = pa.concat_arrays([b.column("id") for b in held])
                    c = np.concatenate([b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for b in held])
                    gem = np.concatenate([b.column("gem").to_numpy(zero_copy_only=False) for b in held])
                    ready, held = (names, c, gem), []
                names, c, gem = ready
                for b in range(0, part.num_rows, 256):
                    piece = part.slice(b, 256)
                    q = piece.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, -1)
                    own = pc.index_in(piece.column("id"), value_set=names).to_numpy(zero_copy_only=False)  # a query's own place, NaN if it is no candidate
                    for a in range(0, len(c), chunk):
                        near = c[a : a + chunk]
                        cosine = q @ near.T
                        mine = np.flatnonzero((own >= a) & (own < a + len(near)))
                        for number, rail, keep in wanted:
                            scores = _scores(rail, q, near, cosine, p)
                            if rail == "hidden_gem":
                                scores = np.where(gem[a : a + chunk][None], scores, -np.inf)
                            elif scores is cosine:
                                scores = cosine.copy()
                            scores[mine, own[mine].astype(int) - a] = -np.inf
                            row, column, score = _best(scores, keep)
                            yield pa.RecordBatch.from_arrays(
                                [piece.column("id").take(pa.array(row)), pa.array(np.full(len(row), number), pa.int32()), names.take(pa.array(column + a)), pa.array(score)], schema=_HITS
                            )

    return run


def nets(queries: DataFrame, candidates: DataFrame, p: RailParams, wanted: tuple[tuple[int, str, int], ...], block_rows: int = 100_000) -> DataFrame:
    """(source_id, rail, candidate_id, score, k): for each query (id, vector of length 1) the best candidates of each rail, exactly.

    ``candidates``: (id, vector, gem); ``wanted``: (number, rail, how many).
    """
    spark = queries.sparkSession
    n = candidates.count()
    blocks = max(1, -(-n // block_rows))
    c = candidates.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("role"), F.col("id").cast("string").alias("id"), "gem", "vector")
    q = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("role"), F.col("id").cast("string").alias("id"), F.lit(False).alias("gem"), "vector")
    # a block's queries are spread over several tasks, each of which holds the block
    spread = max(1, session.shuffle_partitions(spark) // blocks)
    c = c.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    q = q.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"))
    both = c.unionByName(q).withColumn("block", F.col("block") * spread + F.col("slice")).drop("slice")
    hits = (
        both.repartition(max(session.shuffle_partitions(spark), min(2 * blocks * spread, 4000)), "block")
        .sortWithinPartitions("block", "role", "id")
        .mapInArrow(_block_search(wanted, p), "source_id string, rail int, candidate_id string, score double")
    )
    rank = F.row_number().over(W.partitionBy("source_id", "rail").orderBy(F.desc("score"), "candidate_id"))
    most = F.create_map(*(F.lit(x) for number, _, keep in wanted for x in (number, keep)))[F.col("rail")]
    ranked = hits.withColumn("k", rank)
    return ranked.where(F.col("k") <= max(keep for _, _, keep in wanted)).where(F.col("k") <= most)


def net(queries: DataFrame, candidates: DataFrame, rail: str, p: RailParams, block_rows: int = 100_000) -> DataFrame:
    """(source_id, candidate_id, score): the best ``net_size`` candidates of one rail."""
    out = nets(queries, candidates.withColumn("gem", F.lit(True)), p, ((0, rail, p.net_size),), block_rows)
    return out.select("source_id", "candidate_id", "score")


def rails(movies: DataFrame, p: RailParams = RailParams(), sources: DataFrame | None = None, wanted: tuple[str, ...] = RAILS) -> DataFrame:
    """(source_id, rail, rank, neighbour_id, score) of the rails, in their order, each without the picks of those before it.

    ``movies``: (id, vector of length 1, vote_count), one row each; ``sources``
    limits whose rails are made (ids), as for movies that are new.
    """
    who = movies if sources is None else movies.join(sources.select("id").distinct(), "id", "left_semi")
    visible = movies.where(F.col("vote_count") >= p.visibility_floor).withColumn("gem", F.col("vote_count") < p.vote_ceiling)
    made = RAILS[: max(RAILS.index(w) for w in wanted) + 1]
    plan = tuple((i, rail, min(p.net_size, p.top_k * (i + 1))) for i, rail in enumerate(made))
    found = nets(who.select("id", "vector"), visible.select("id", "vector", "gem"), p, plan)
    # a source's nets, at most top_k * (1 + ... + 5) rows, rail by rail: those not yet taken, the first top_k of each
    entry = F.struct("rail", "k", "candidate_id", "score")
    nets_of = found.groupBy("source_id").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    kind = "array<struct<rail:int,k:int,candidate_id:string,score:double>>"

    def step(taken: Column, i: int) -> Column:
        names = F.transform(taken, lambda x: x["candidate_id"])
        free = F.filter("all", lambda x: (x["rail"] == i) & ~F.array_contains(names, x["candidate_id"]))
        return F.concat(taken, F.slice(free, 1, p.top_k))

    picks = nets_of.withColumn("taken", F.array().cast(kind))
    for i, _, _ in plan:
        picks = picks.withColumn("taken", step(F.col("taken"), i))
    picks = session.stage(picks.select("source_id", "taken"), "rails")
    rows = picks.select("source_id", F.explode("taken").alias("t")).select("source_id", F.col("t.rail").alias("i"), F.col("t.k").alias("k"), F.col("t.candidate_id").alias("neighbour_id"), F.col("t.score").alias("score"))
    names = F.array(*map(F.lit, RAILS))
    rank = F.row_number().over(W.partitionBy("source_id", "i").orderBy("k"))
    out = rows.select("source_id", names[F.col("i")].alias("rail"), rank.alias("rank"), "neighbour_id", "score")
    return out.where(F.col("rail").isin(*wanted))


def incomplete(scored: DataFrame, neighbours: DataFrame, wanted: tuple[str, ...], least: int = 10, observed: bool = False) -> DataFrame:
    """(id, fewest): the movies with fewer than ``least`` rows in one of the rails.

    A rail without any row counts 0.  ``observed`` takes the minimum over the
    rails that have rows only, so a movie that lacks a rail wholly is missed
    unless it lacks all of them.
    """
    rows = neighbours.where(F.col("recommendation_type").isin(*wanted) & F.col("source_movie_id").isNotNull())
    per_rail = rows.groupBy(F.col("source_movie_id").alias("id"), "recommendation_type").agg(F.count("*").alias("n"))
    per_movie = per_rail.groupBy("id").agg(F.min("n").alias("low"), F.count("*").alias("rails"))
    low = F.col("low") if observed else F.when(F.col("rails") == len(wanted), F.col("low")).otherwise(0)
    joined = scored.select("id").distinct().join(per_movie, "id", "left")
    return joined.select("id", F.coalesce(low, F.lit(0)).cast("bigint").alias("fewest")).where(F.col("fewest") < least)
