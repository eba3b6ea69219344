"""Items that appear together: a blocked Gram matrix of binary baskets.

With X the binary matrix of records by items, the co-occurrence counts are
X'X.  Items get whole numbers, frequent ones first, and are cut into item
blocks; a task reads its records in record blocks.  For each record block and
each pair of item blocks (I, J) that meet in it, the sparse product X_I' X_J is
added to the accumulator of that pair, which the task keeps over all of its
record blocks; summed cells leave the task, as two numbers and a count.  Spark
adds the tasks' cells, with a map-side combine, and normalises by the marginals.

A basket of more than ``long_basket`` items is not held in one task: it is cut
into pieces, and each pair of pieces is a product of its own, spread over all
tasks.

Items in fewer than ``min_together`` records cannot be in a pair that counts;
they are cut before the product, which loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinograph import session
from kinograph.llm.records import dense_codes, term_records

_CELLS = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
_CELL_TYPE = "a int, b int, n bigint"
#: Terms that travel to the tasks with their codes, and characters of them; more are joined by shuffle.
MOST_HELD, MOST_HELD_CHARS = 200_000, 20_000_000


class Gram:
    """Accumulators of X_I' X_J, one per pair of item blocks I <= J: distinct cells with their counts, and summands not counted yet."""

    def __init__(self, item_block: int, pending: int = 1 << 20) -> None:
        self.item_block, self.pending = item_block, pending
        self.counted: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.waiting: dict[tuple[int, int], list[np.ndarray]] = {}
        self.waiting_size: dict[tuple[int, int], int] = {}

    @property
    def cells(self) -> int:
        return sum(len(c) for c, _ in self.counted.values()) + sum(self.waiting_size.values())

    def add(self, starts: np.ndarray, items: np.ndarray, limit: int = 1 << 22) -> None:
        """A record block: record r has the items from ``starts[r]`` to ``starts[r + 1]``, ascending, each once."""
        lengths = np.diff(starts)
        record = np.repeat(np.arange(len(lengths)), lengths)
        block = items // self.item_block
        used = np.unique(block)
        order = np.argsort(block, kind="stable")  # block by block; in each by record, then item
        cuts = np.searchsorted(block[order], used, side="left"), np.searchsorted(block[order], used, side="right")
        parts = {}
        for b, lo, hi in zip(used.tolist(), *map(np.ndarray.tolist, cuts)):
            at = order[lo:hi]
            ends = np.cumsum(np.bincount(record[at], minlength=len(lengths)))
            parts[b] = items[at] - b * self.item_block, np.concatenate([[0], ends])
        for i, left in parts.items():
            for j, right in parts.items():
                if i <= j:
                    self._product((i, j), *left, *right, limit)

    def _product(self, pair: tuple[int, int], a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, limit: int) -> None:
        """The summands of one product: every item of I with every item of J in the same record, those above the diagonal if I is J."""
        na, nb = np.diff(a_at), np.diff(b_at)
        rows = np.flatnonzero((na > 0) & (nb > 0))
        if pair[0] == pair[1]:
            rows = rows[na[rows] > 1]
        work = na[rows] * nb[rows]
        lo = 0
        while lo < len(rows):
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(work[lo:]), limit)) + lo)
            take = rows[lo:hi]
            size = work[lo:hi]
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            wide = np.repeat(nb[take], size)
            x = a[np.repeat(a_at[take], size) + at // wide]
            y = b[np.repeat(b_at[take], size) + at % wide]
            if pair[0] == pair[1]:
                x, y = x[x < y], y[x < y]
            if len(x):
                self.waiting.setdefault(pair, []).append(x.astype(np.int64) * self.item_block + y)
                self.waiting_size[pair] = self.waiting_size.get(pair, 0) + len(x)
                if self.waiting_size[pair] > self.pending:
                    self._count(pair)
            lo = hi

    def _count(self, pair: tuple[int, int]) -> None:
        cells, counts = np.unique(np.concatenate(self.waiting.pop(pair)), return_counts=True)
        self.waiting_size.pop(pair)
        if pair in self.counted:
            have, n = self.counted[pair]
            merged, at = np.unique(np.concatenate([have, cells]), return_inverse=True)
            total = np.zeros(len(merged), np.int64)
            np.add.at(total, at, np.concatenate([n, counts]))
            cells, counts = merged, total
        self.counted[pair] = cells, counts

    def drain(self) -> Iterator[pa.RecordBatch]:
        """All cells, block pair by block pair; the accumulators are empty then."""
        for pair in list(self.waiting):
            self._count(pair)
        for (i, j), (cells, counts) in sorted(self.counted.items()):
            for lo in range(0, len(cells), 100_000):
                x, y = np.divmod(cells[lo : lo + 100_000], self.item_block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x + i * self.item_block, pa.int32()), pa.array(y + j * self.item_block, pa.int32()), pa.array(counts[lo : lo + 100_000], pa.int64())], schema=_CELLS
                )
        self.counted = {}


def _encoded(terms: pa.Array):
    """Lists of terms as ascending lists of their places in ``terms``, without those that it does not have."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            code = pc.index_in(lists.flatten(), value_set=terms)
            row = pc.list_parent_indices(lists).to_numpy()
            known = code.is_valid().to_numpy(zero_copy_only=False)
            row, code = row[known], code.drop_null().to_numpy().astype(np.int32)
            order = np.lexsort((code, row))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(code[order]))], names=["codes"])

    return run


def _baskets_product(item_block: int, block_ones: int, most_cells: int):
    """Baskets of ascending codes, a row each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = Gram(item_block)
        for batch in batches:
            lists = batch.column(0)
            starts, items = lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy()
            starts = starts - starts[0]
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + block_ones, side="right")) - 1)
                gram.add(starts[lo : hi + 1] - starts[lo], items[starts[lo] : starts[hi]])
                lo = hi
                if gram.cells > most_cells:
                    yield from gram.drain()
        yield from gram.drain()

    return run


def _pieces_product(item_block: int, most_cells: int):
    """Pairs of pieces of one basket, a row each: all of the one with all of the other, or a piece with itself where the other is null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = Gram(item_block)
        for batch in batches:
            for r in range(batch.num_rows):
                a, b = (batch.column(c)[r].values for c in (0, 1))
                a = a.to_numpy()
                if b is None:
                    gram.add(np.array([0, len(a)]), a)
                else:
                    b = b.to_numpy()  # all of a is below all of b
                    for i in np.unique(a // item_block).tolist():
                        for j in np.unique(b // item_block).tolist():
                            x, y = a[a // item_block == i] - i * item_block, b[b // item_block == j] - j * item_block
                            step = max(1, (1 << 22) // len(y))
                            for lo in range(0, len(x), step):
                                z = x[lo : lo + step]
                                gram.waiting.setdefault((i, j), []).append((z.astype(np.int64)[:, None] * item_block + y[None]).ravel())
                                gram.waiting_size[i, j] = gram.waiting_size.get((i, j), 0) + len(z) * len(y)
                                if gram.waiting_size[i, j] > gram.pending:
                                    gram._count((i, j))
                if gram.cells > most_cells:
                    yield from gram.drain()
        yield from gram.drain()

    return run


def cooccurrence(
    df: DataFrame, record: str, array: str, min_together: int = 5, item_block: int = 4096, block_ones: int = 400_000, long_basket: int = 2048, most_cells: int = 4_000_000
) -> DataFrame:
    """Pairs of terms in at least ``min_together`` common records.

    Returns term_a < term_b (by code point), ``n_ab`` common records, ``n_a``
    and ``n_b`` records with each, ``n`` all records, and ``lift``: n_ab * n /
    (n_a * n_b), how many times more often than chance.

    * null and empty arrays, null and blank elements: no membership, but the record counts for ``n``;
    * a term that an array repeats counts once; rows that repeat a record are one record with the terms of all;
    * ties do not arise, nothing is ranked; an empty table gives no row;
    * a basket of any length: k terms make k(k-1)/2 summands, in pieces spread over the tasks beyond ``long_basket``;
    * other columns are not read.
    """
    records = session.stage(term_records(df, record, array).select(F.array_distinct("terms").alias("terms")), "records")
    n = records.count()
    marginals = records.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("m")).where(F.col("m") >= min_together)
    codes = dense_codes(marginals, F.desc("m"), F.col("term"))
    count, chars = codes.agg(F.count("*"), F.sum(F.length("term"))).first()
    if count <= MOST_HELD and (chars or 0) <= MOST_HELD_CHARS:
        coded = records.select("terms").mapInArrow(_encoded(codes.orderBy("code").select("term").toArrow()["term"].combine_chunks()), "codes array<int>")
    else:
        ones = records.withColumn("row", F.monotonically_increasing_id()).select("row", F.explode("terms").alias("term")).join(codes, "term")
        coded = ones.groupBy("row").agg(F.array_sort(F.collect_list("code")).alias("codes")).select("codes")  # a basket a group
    baskets = session.stage(coded.where(F.size("codes") > 1), "baskets")

    cells = baskets.where(F.size("codes") <= long_basket).mapInArrow(_baskets_product(item_block, block_ones, most_cells), _CELL_TYPE)
    long = baskets.where(F.size("codes") > long_basket)
    if long.limit(1).count():
        half = max(1, long_basket // 2)
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size("codes") - 1) / half).cast("int")), lambda i: F.slice("codes", i * half + 1, half))
        cut = session.stage(long.withColumn("b", F.monotonically_increasing_id()).select("b", F.posexplode(pieces).alias("at", "codes")), "pieces")
        later = cut.select("b", F.col("at").alias("to"), F.col("codes").alias("other"))
        pairs = cut.join(later, "b").where(F.col("at") < F.col("to")).select("codes", "other")
        pairs = pairs.unionByName(cut.select("codes", F.lit(None).cast("array<int>").alias("other")))
        pairs = pairs.repartition(session.shuffle_partitions(df.sparkSession))
        cells = cells.unionByName(pairs.mapInArrow(_pieces_product(item_block, most_cells), _CELL_TYPE))

    summed = cells.groupBy("a", "b").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= min_together)
    side = lambda c, t, m: codes.select(F.col("code").alias(c), F.col("term").alias(t), F.col("m").alias(m))
    named = summed.join(side("a", "x", "nx"), "a").join(side("b", "y", "ny"), "b")
    first = F.col("x") < F.col("y")
    pick = lambda p, q: F.when(first, F.col(p)).otherwise(F.col(q))
    return named.select(
        pick("x", "y").alias("term_a"), pick("y", "x").alias("term_b"), "n_ab", pick("nx", "ny").alias("n_a"), pick("ny", "nx").alias("n_b"), F.lit(n).cast("bigint").alias("n")
    ).withColumn("lift", F.col("n_ab") * F.lit(float(n)) / (F.col("n_a").cast("double") * F.col("n_b")))


def above_chance(pairs: DataFrame, times: int) -> DataFrame:
    """The pairs with n_ab * n >= times * n_a * n_b, compared exactly."""
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    return pairs.where(whole("n_ab") * whole("n") >= whole("n_a") * whole("n_b") * times)
