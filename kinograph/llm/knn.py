"""Most similar vectors for every vector, by learned partitions.

1. Fit, on a bounded sample (``sample`` rows, chosen by hash): its neighbour
   graph is cut into balanced parts, and a small softmax classifier learns to
   tell from a vector the parts of its neighbours.
2. Index: every row goes to its most probable part.  Parts hold about
   ``part_rows`` rows, so their number grows with the table: beyond
   ``fan_out`` of them each part of a first classifier has a classifier of its
   own, fitted on a sample of its rows where they lie, and parts of parts.  A
   part with more than ``cell_rows`` rows is cut into cells by hash, so no
   part, however hot, is held in one task's memory.
3. Search: every query goes to the cells of some parts and is ranked there
   exactly by cosine in blocks; the best k of all cells are the result.  With a
   least cosine these are all parts that can hold such a neighbour, so none is
   missed: a part is where its score is highest, which is a cell with plane
   walls, and a query further from it than the cosine allows cannot have a
   neighbour there.  Without one they are its most probable parts, until
   together they have the probability ``mass``.

Records with equal vectors are one class: only classes are indexed and
searched, and every class keeps the names of its first k + 1 records.  A third
of all rows with the same vector therefore costs one row.

Rows travel once, and once for each part they are searched in (plus one copy
per further cell of a hot part); a dense theme that is cut into many parts takes
many.  A task holds one cell and one batch of queries; the queries of a cell
with more than ``query_rows`` of them are spread over several tasks, each with
the cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinograph import session
from kinograph.llm.vectors import as_packed, matrix


#: Classes of more than one record that are broadcast, a vector and a name each; more are joined by shuffle.
MOST_BROADCAST = 20_000


@dataclass(frozen=True)
class Router:
    """The classifier: scores = x W + b; the higher, the more probable the part."""

    weights: np.ndarray
    bias: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.bias)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x.astype(np.float64) @ self.weights.astype(np.float64) + self.bias

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the most probable part of each row."""
        return np.arange(len(x)), self.scores(x).argmax(1)

    def probable(self, x: np.ndarray, least: int, mass: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the most probable parts of each row, ``least`` of them and on until their probabilities sum to ``mass``."""
        scores = self.scores(x)
        order = np.argsort(-scores, axis=1, kind="stable")
        p = np.exp(np.take_along_axis(scores, order, 1) - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        before = np.cumsum(p, axis=1) - p
        rows, at = np.nonzero((before < mass) | (np.arange(self.parts) < least))
        return rows, order[rows, at]

    def within(self, x: np.ndarray, distance: float, block: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): every part that may be ``home`` to a vector within ``distance`` of the row.

        Between two vectors the difference of the scores of two parts changes
        by at most their distance times the length of the difference of the
        parts' weights, and at home no part scores higher.
        """
        scores = self.scores(x)
        w = self.weights.astype(np.float64)
        product = w.T @ w
        square = np.diag(product)
        allowed = distance * np.sqrt(np.maximum(square[:, None] + square - 2 * product, 0)) + 1e-6  # and rounding
        best = scores.argmax(1)
        rows, part = np.nonzero(scores[np.arange(len(x)), best][:, None] - scores <= allowed[best])
        keep = np.ones(len(rows), bool)
        for lo in range(0, len(rows), block):
            r, p = rows[lo : lo + block], part[lo : lo + block]
            keep[lo : lo + block] = (scores[r] - scores[r, p][:, None] <= allowed[p]).all(1)
        return rows[keep], part[keep]


def neighbour_graph(x: np.ndarray, k: int, block: int = 256) -> np.ndarray:
    """The k nearest others of each row by dot product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int32)
    for lo in range(0, len(x), block):
        sims = x[lo : lo + block] @ x.T
        sims[np.arange(len(sims)), np.arange(lo, lo + len(sims))] = -np.inf
        out[lo : lo + block] = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12) -> np.ndarray:
    """A part for each vertex: halving along the main direction, then moves along the graph that never overfill a part."""
    part = np.zeros(len(x), np.int32)
    made = 1
    while made < parts:  # halve the largest part
        largest = int(np.bincount(part, minlength=made).argmax())
        rows = np.flatnonzero(part == largest)
        centred = x[rows] - x[rows].mean(0)
        axis = np.ones(x.shape[1], x.dtype)
        for _ in range(8):  # power iteration
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) + 1e-12
        order = np.argsort(centred @ axis, kind="stable")
        part[rows[order[len(rows) // 2 :]]] = made
        made += 1
    sources = np.repeat(np.arange(len(x)), graph.shape[1])
    ends = np.concatenate([sources, graph.ravel()])
    others = np.concatenate([graph.ravel(), sources])
    cap = int(np.ceil(slack * len(x) / parts))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (ends, part[others]), 1)
        here = votes[np.arange(len(x)), part]
        to = votes.argmax(1)
        gain = votes.max(1) - here
        movers = np.flatnonzero(gain > 0)
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for v in movers[np.argsort(-gain[movers], kind="stable")]:
            if sizes[to[v]] < cap:
                sizes[part[v]] -= 1
                sizes[to[v]] += 1
                part[v] = to[v]
                moved += 1
        if moved < len(x) // 200:
            break
    return part


def train_router(x: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, epochs: int = 12, batch: int = 256, rate: float = 0.05, seed: int = 7) -> Router:
    """Softmax regression on the share of each part among a vector and its neighbours, by Adam."""
    rng = np.random.default_rng(seed)
    shares = np.zeros((len(x), parts), np.float32)
    rows = np.repeat(np.arange(len(x)), graph.shape[1])
    np.add.at(shares, (rows, part[graph.ravel()]), 0.7 / graph.shape[1])
    shares[np.arange(len(x)), part] += 0.3
    params = [np.zeros((x.shape[1], parts), np.float32), np.zeros(parts, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        lr = rate * (1 - epoch / epochs) + 0.002
        for lo in range(0, len(x), batch):
            at = order[lo : lo + batch]
            scores = x[at] @ params[0] + params[1]
            scores -= scores.max(1, keepdims=True)
            p = np.exp(scores)
            p /= p.sum(1, keepdims=True)
            error = (p - shares[at]) / len(at)
            step += 1
            for i, grad in enumerate((x[at].T @ error, error.sum(0))):
                first[i] += 0.1 * (grad - first[i])
                second[i] += 0.01 * (grad * grad - second[i])
                params[i] -= lr * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return Router(*params)


def fit(x: np.ndarray, parts: int, graph_k: int = 10) -> Router:
    """A router over ``parts`` parts from sample rows of length 1; one part needs no fitting."""
    if parts <= 1 or len(x) <= parts:
        return Router(np.zeros((x.shape[1], 1), np.float32), np.zeros(1, np.float32))
    graph = neighbour_graph(x, graph_k)
    return train_router(x, graph, balanced_parts(x, graph, parts), parts)


Choice = Callable[[Router, np.ndarray], tuple[np.ndarray, np.ndarray]]
_HITS = pa.schema([("query", pa.string()), ("neighbour", pa.string()), ("cosine", pa.float64())])
_PLACED = "part bigint, record string, vector binary"


def _pieces(router: Router, choose: Choice, batch: pa.RecordBatch, dim: int, offset: int = 0) -> Iterator[pa.RecordBatch]:
    """The rows (record, vector) of a batch once for every part that ``choose`` names, ``offset`` added."""
    for lo in range(0, batch.num_rows, 2048):
        part = batch.slice(lo, 2048)
        rows, parts = choose(router, matrix(part.column("vector"), dim))
        for at in range(0, len(rows), 8192):
            take = pa.array(rows[at : at + 8192])
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[at : at + 8192] + offset, pa.int64()), part.column("record").take(take), part.column("vector").take(take)], names=["part", "record", "vector"]
            )


def _route(router: Router, choose: Choice, dim: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _pieces(router, choose, batch, dim)

    return run


def _tally(router: Router, choose: Choice, dim: int):
    """How many rows ``_route`` would send to each part, a row per part and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(router.parts, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                counts += np.bincount(choose(router, matrix(batch.column("vector").slice(lo, 2048), dim))[1], minlength=router.parts)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["part", "n"])

    return run


def _route_again(choose: Choice, dim: int, fan_out: int):
    """The second level: rows come sorted by (part, salt, role), the part's own classifier (role 0) first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router, at = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.stack([batch.column(c).to_numpy() for c in ("part", "salt", "role")], 1).astype(np.int64)
            cuts = np.flatnonzero((np.diff(code, axis=0) != 0).any(1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                part, role = int(code[lo, 0]), int(code[lo, 2])
                if role == 0:
                    flat = np.frombuffer(batch.column("vector")[lo].as_py(), np.float32).reshape(dim + 1, -1)
                    router, at = Router(flat[:-1], flat[-1]), part
                else:
                    if at != part:
                        raise RuntimeError("a part without its classifier")
                    yield from _pieces(router, choose, batch.slice(lo, hi - lo), dim, part * fan_out)

    return run


def _search(dim: int, k: int, least: float, member_block: int, query_block: int = 512):
    """Rows come sorted by (part, cell, share, role): a cell's members (role 0), then queries (role 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranked(names: pa.Array, members: np.ndarray, ids: pa.Array, queries: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(queries), query_block):
                sims = queries[lo : lo + query_block] @ members.T
                top = min(k + 1, sims.shape[1])  # one more, as a query meets itself
                if least > -1:
                    r, c = np.nonzero(sims >= least - 1e-5)
                else:
                    kth = np.partition(sims, -top, axis=1)[:, -top]
                    r, c = np.nonzero(sims >= kth[:, None] - 1e-6)  # all ties of the last place go on
                cosine = np.einsum("ij,ij->i", queries[lo + r].astype(np.float64), members[c].astype(np.float64))
                keep = cosine >= least
                r, c, cosine = r[keep], c[keep], cosine[keep]
                order = np.lexsort((c, -cosine, r))  # a cell's members come by name, so equal cosines stay in that order
                r, c, cosine = r[order], c[order], cosine[order]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k + 1
                r, c, cosine = r[keep], c[keep], cosine[keep]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(lo + r)), names.take(pa.array(c)), pa.array(cosine)], schema=_HITS)

        at: tuple[int, ...] | None = None
        names: list[pa.Array] = []
        rows: list[np.ndarray] = []
        ready: tuple[pa.Array, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.stack([batch.column(c).to_numpy() for c in ("part", "cell", "share", "role")], 1).astype(np.int64)
            cuts = np.flatnonzero((np.diff(code, axis=0) != 0).any(1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                cell, role = tuple(code[lo, :3].tolist()), int(code[lo, 3])
                if cell != at:
                    at, names, rows, ready = cell, [], [], None
                if role == 0:
                    names.append(part.column("record"))
                    rows.append(matrix(part.column("vector"), dim))
                elif names or ready:
                    if ready is None:
                        ready = pa.concat_arrays(names), np.concatenate(rows)
                        names, rows = [], []
                    for b in range(0, len(ready[1]), member_block):
                        yield from ranked(ready[0].slice(b, member_block), ready[1][b : b + member_block], part.column("record"), matrix(part.column("vector"), dim))

    return run


def _classes(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors, staged: (record, vector) with the least record of each, and (cls, copy) for every record of those with more than one."""
    counted = session.stage(named.groupBy("vector").agg(F.min("record").alias("record"), F.count("*").alias("n")), "classes")
    shared = counted.where("n > 1").select("vector", F.col("record").alias("cls"))
    few = shared.count() <= MOST_BROADCAST
    copies = session.stage(named.join(F.broadcast(shared) if few else shared, "vector").select("cls", F.col("record").alias("copy")), "copies")
    return counted.select("record", "vector"), copies


def nearest(
    vectors: DataFrame,
    dim: int,
    k: int = 10,
    least: float = -1.0,
    queries: DataFrame | None = None,
    probes: int = 4,
    mass: float = 0.98,
    part_rows: int = 2000,
    fan_out: int = 1024,
    sample: int = 20_000,
    cell_rows: int = 8192,
    query_rows: int = 65_536,
) -> DataFrame:
    """(query, neighbour, cosine, rnk): the k most similar others of every query.

    ``vectors``: (record string, vector of length 1, packed or array<float>), a
    row per record (see ``vectors.unit_vectors``); ``queries`` of the same form,
    by default all of ``vectors``.  ``least`` keeps only neighbours of at least
    that cosine, and is applied where cells are searched.

    With ``least`` above -1 no neighbour is missed.  Without, approximate: a
    neighbour is missed in parts beyond the query's ``probes`` most probable
    and those that make up the probability ``mass``.  Measured recall of the
    ten nearest is in the README (at least 0.9).

    * null or unusable vectors: not in ``vectors``, so in no result;
    * a record is no neighbour of itself; two records with equal vectors are neighbours;
    * equal cosines: by ``neighbour`` ascending;
    * fewer than k others: all there are; an empty table gives no row;
    * a classifier is fitted on ``sample`` rows at most; everything else uses all rows.
    """
    named = as_packed(vectors, dim)
    classes, copies = _classes(named)
    asked, asked_copies = (classes, copies) if queries is None else _classes(as_packed(queries, dim))
    hits = _class_hits(classes, asked, dim, k, least, probes, mass, part_rows, fan_out, sample, cell_rows, query_rows)

    first = F.row_number().over(W.partitionBy("cls").orderBy("copy"))
    names = copies.withColumn("r", first).where(F.col("r") <= k + 1).select(F.col("cls").alias("neighbour"), "copy")
    spread = hits.join(names, "neighbour", "left").select("query", F.coalesce("copy", "neighbour").alias("record"), "cosine")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("cosine"), "record"))
    best = spread.withColumn("rnk", rank).where(F.col("rnk") <= k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rnk", "record", "cosine"))).alias("list"))  # k + 1 at most
    return (
        lists.join(asked_copies.withColumnRenamed("cls", "query"), "query", "left")
        .select(F.coalesce("copy", "query").alias("q"), "list")
        .select("q", F.posexplode(F.slice(F.filter("list", lambda x: x["record"] != F.col("q")), 1, k)))
        .select(F.col("q").alias("query"), F.col("col.record").alias("neighbour"), F.col("col.cosine").alias("cosine"), (F.col("pos") + 1).alias("rnk"))
    )


def _sampled(rows: DataFrame, n: int, sample: int) -> DataFrame:
    """``sample`` of ``n`` rows by hash."""
    share = min(1.0, 1.2 * sample / max(n, 1))
    chosen = rows.where(F.pmod(F.xxhash64(F.lit(11), "record"), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else rows
    return chosen.orderBy(F.xxhash64("record"), "record").limit(sample)


def _second_level(members: DataFrame, sizes: dict[int, int], dim: int, part_rows: int, sample: int, fan_out: int) -> DataFrame:
    """(part, vector): a classifier for every part of the first level, its weights and bias packed, fitted on a sample of the part's rows."""
    by_hash = F.row_number().over(W.partitionBy("part").orderBy(F.xxhash64(F.lit(13), "record"), "record"))
    drawn = members.withColumn("_r", by_hash).where(F.col("_r") <= sample).drop("_r")
    wanted = F.create_map(*(F.lit(x) for p, n in sizes.items() for x in (p, max(1, min(fan_out, round(n / part_rows))))))

    def run(frame):
        import pandas as pd

        router = fit(np.array([np.frombuffer(v, np.float32) for v in frame["vector"]]).reshape(-1, dim), int(frame["parts"].iloc[0]))
        flat = np.concatenate([router.weights, router.bias[None]]).astype(np.float32)
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "vector": [flat.tobytes()]})

    return session.stage(drawn.withColumn("parts", wanted[F.col("part")]).groupBy("part").applyInPandas(run, "part bigint, vector binary"), "routers")  # sample rows a group


def _again(rows: DataFrame, routers: DataFrame, salts: dict[int, int], choose: Choice, dim: int, fan_out: int) -> DataFrame:
    """``rows`` (part, record, vector) placed by the classifiers of their parts; a part's rows are spread over ``salts`` tasks, each with its classifier."""
    salt = F.coalesce(F.create_map(*(F.lit(x) for kv in salts.items() for x in kv))[F.col("part")], F.lit(1))
    both = routers.select("part", F.explode(F.sequence(F.lit(0), salt.cast("int") - 1)).alias("salt"), F.lit(0).alias("role"), F.lit(None).cast("string").alias("record"), "vector").unionByName(
        rows.select("part", F.pmod(F.xxhash64("record"), salt).cast("int").alias("salt"), F.lit(1).alias("role"), "record", "vector")
    )
    width = max(session.slots(rows.sparkSession), min(2 * sum(salts.values()), 4000))
    return both.repartition(width, "part", "salt").sortWithinPartitions("part", "salt", "role").mapInArrow(_route_again(choose, dim, fan_out), _PLACED)


def _class_hits(vectors: DataFrame, asked: DataFrame, dim: int, k: int, least: float, probes: int, mass: float, part_rows: int, fan_out: int, sample: int, cell_rows: int, query_rows: int) -> DataFrame:
    """(query, neighbour, cosine) of the best classes for every class asked for, its own with cosine 1 among them."""
    spark = vectors.sparkSession
    n = vectors.count()
    parts = max(1, round(n / part_rows))
    deep = parts > fan_out
    if deep:
        parts = min(fan_out, int(np.ceil(parts**0.5)))
    rows = matrix(_sampled(vectors, n, sample).select("vector").toArrow()["vector"].combine_chunks(), dim) if parts > 1 else np.zeros((0, dim), np.float32)
    router = fit(rows, parts)

    if least > -1:
        distance = float(np.sqrt(max(2 - 2 * least, 0.0) + 1e-6))  # lengths are 1 within rounding
        choose: Choice = lambda r, x: r.within(x, distance)
    else:
        choose = lambda r, x: r.probable(x, probes, mass)
    home: Choice = lambda r, x: r.home(x)
    members = session.stage(vectors.mapInArrow(_route(router, home, dim), _PLACED), "parts")
    placed = asked.mapInArrow(_route(router, choose, dim), _PLACED)  # its copies of vectors are not written down; they are made again when they travel
    tally = asked.mapInArrow(_tally(router, choose, dim), "part bigint, n bigint").groupBy("part").agg(F.sum("n").alias("q"))
    counts = lambda df: {r.part: r["count"] for r in df.groupBy("part").count().collect()}  # noqa: E731 a row per part
    if deep:
        sizes = counts(members)
        routers = _second_level(members, sizes, dim, part_rows, sample, fan_out)
        spread = lambda c: {p: -(-m // query_rows) for p, m in c.items() if p in sizes}
        members = session.stage(_again(members, routers, spread(sizes), home, dim, fan_out), "parts")
        asked_sizes = {r.part: r.q for r in tally.collect()}  # a row per part
        placed = placed.where(F.col("part").isin(list(sizes)))  # a part without rows has no neighbour
        placed = session.stage(_again(placed, routers, spread(asked_sizes), choose, dim, fan_out), "asked")
        tally = placed.groupBy("part").agg(F.count("*").alias("q"))
    # cells of a part and shares of its queries, as a table: there may be very many parts
    plan = members.groupBy("part").agg(F.count("*").alias("m")).join(tally, "part")
    plan = session.stage(plan.select("part", "m", "q", F.ceil(F.col("m") / cell_rows).cast("int").alias("cells"), F.ceil(F.col("q") / query_rows).cast("int").alias("shares")), "plan")
    cells, copies = plan.agg(F.sum(F.col("cells") * F.col("shares")), F.sum(F.col("m") * F.col("shares") + F.col("q") * F.col("cells"))).first()
    plan = plan.select("part", "cells", "shares")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    slot = lambda c: F.pmod(F.xxhash64("record"), F.col(c)).cast("int")
    both = (
        members.join(plan, "part")
        .select("part", slot("cells").alias("cell"), each("shares").alias("share"), F.lit(0).alias("role"), "record", "vector")
        .unionByName(placed.join(plan, "part").withColumn("share", slot("shares")).select("part", each("cells").alias("cell"), "share", F.lit(1).alias("role"), "record", "vector"))
    )
    width = max(session.slots(spark), min(2 * (cells or 1), -(-(copies or 1) // 4096), 4000))
    return (
        both.repartition(width, "part", "cell", "share")
        .sortWithinPartitions("part", "cell", "share", "role", "record")
        .mapInArrow(_search(dim, k, least, 4096), "query string, neighbour string, cosine double")
    )
