"""Frequency of every distinct term, counted in burst tries.

1. Every task counts its records' terms in a burst trie: inner nodes branch on
   a code point, leaves are containers (suffix -> occurrences, records) that
   burst into a node when they hold more than ``burst`` suffixes.  A full trie
   is written out as compact subtries, one row per container, and begun anew,
   so a task's memory is bounded by ``flush``.
2. The prefixes under which all tasks together hold more than ``route_terms``
   terms are *heavy*; at most (terms / route_terms) of each length can be.  A
   subtrie's route is its shortest prefix that is not heavy, so routes are as
   long as the vocabulary is dense, and a container that lies on a heavy
   prefix is burst along it.
3. Subtries of the same route meet in one task and are merged there.

A term that a third of all records have costs one entry per task's trie, so
skewed terms do not skew the shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinograph import session
from kinograph.llm.records import term_records

_SUBTRIE = "prefix string, suffixes array<string>, occurrences array<bigint>, records array<bigint>"
_LISTS = [("suffixes", pa.list_(pa.string())), ("occurrences", pa.list_(pa.int64())), ("records", pa.list_(pa.int64()))]
_SUBTRIE_ARROW = pa.schema([("prefix", pa.string()), *_LISTS])
_ROUTED_ARROW = pa.schema([("route", pa.string()), ("prefix", pa.string()), *_LISTS])
_COUNT_ARROW = pa.schema([("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])


class BurstTrie:
    """Counts of strings.  A node is ``[children by code point, counts of the string that ends here]``, a container a dict by suffix."""

    def __init__(self, burst: int = 256) -> None:
        self.burst = burst
        self.root: list | dict = {}
        self.size = 0

    def add(self, term: str, occurrences: int, records: int) -> None:
        at, parent, depth = self.root, None, 0
        while type(at) is list:
            if depth == len(term):
                if at[1] is None:
                    at[1] = [0, 0]
                    self.size += 1
                at[1][0] += occurrences
                at[1][1] += records
                return
            parent, c = at, term[depth]
            at = at[0].get(c)
            if at is None:
                at = parent[0][c] = {}
            depth += 1
        suffix = term[depth:]
        counts = at.get(suffix)
        if counts is None:
            at[suffix] = [occurrences, records]
            self.size += 1
            if len(at) > self.burst:
                node = self._burst(at)
                if parent is None:
                    self.root = node
                else:
                    parent[0][term[depth - 1]] = node
        else:
            counts[0] += occurrences
            counts[1] += records

    @staticmethod
    def _burst(container: dict) -> list:
        children: dict[str, dict] = {}
        end = container.pop("", None)
        for suffix, counts in container.items():
            children.setdefault(suffix[0], {})[suffix[1:]] = counts
        return [children, end]

    def containers(self) -> Iterator[tuple[str, dict]]:
        """(prefix, suffix -> counts) of every container; a node's own string is a container of the empty suffix."""
        stack: list[tuple[str, list | dict]] = [("", self.root)]
        while stack:
            prefix, at = stack.pop()
            if type(at) is dict:
                if at:
                    yield prefix, at
            else:
                if at[1] is not None:
                    yield prefix, {"": at[1]}
                stack.extend((prefix + c, child) for c, child in at[0].items())


def _columns(prefix: str, entries: Iterable[tuple[str, list[int]]]) -> tuple:
    suffixes, occurrences, records = [], [], []
    for suffix, (o, r) in entries:
        suffixes.append(suffix)
        occurrences.append(o)
        records.append(r)
    return prefix, suffixes, occurrences, records


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _route(term: str, heavy: frozenset[str]) -> str:
    k = 1
    while k < len(term) and term[:k] in heavy:
        k += 1
    return term[:k]


def term_frequencies(df: DataFrame, record: str, array: str, burst: int = 256, flush: int = 500_000, route_terms: int = 100_000) -> DataFrame:
    """(term, occurrences, records) of every distinct term of an array column.

    ``occurrences`` counts every element, ``records`` every record once.  See
    ``kinograph.functions.terms`` for what a term is.

    * null and empty arrays, null and blank elements: nothing to count;
    * rows that repeat a record are one record: equal lists count once, other lists are joined; rows without a record id do not count;
    * an empty table gives no row; terms of any length are counted whole;
    * other columns are not read.
    """
    return _frequencies(term_records(df, record, array).select("terms"), burst, flush, route_terms)


def _frequencies(records: DataFrame, burst: int, flush: int, route_terms: int) -> DataFrame:
    """``term_frequencies`` of lists of terms, a row per record."""
    rows = records.where(F.size("terms") > 0)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = BurstTrie(burst)
        for batch in batches:
            occurrences: Counter = Counter()
            records: Counter = Counter()
            for terms in batch.column(0).to_pylist():
                occurrences.update(terms)
                records.update(set(terms))
            for term, n in occurrences.items():
                trie.add(term, n, records[term])
            if trie.size > flush:
                yield from _batches((_columns(p, c.items()) for p, c in trie.containers()), _SUBTRIE_ARROW)
                trie = BurstTrie(burst)
        yield from _batches((_columns(p, c.items()) for p, c in trie.containers()), _SUBTRIE_ARROW)

    subtries = session.stage(rows.mapInArrow(count, _SUBTRIE), "subtries")
    prefixes = F.transform(F.sequence(F.lit(1), F.length("prefix")), lambda k: F.substring(F.col("prefix"), F.lit(1), k))
    heavy = frozenset(
        r.p
        for r in subtries.where(F.length("prefix") > 0)
        .select(F.explode(prefixes).alias("p"), F.size("suffixes").cast("bigint").alias("m"))
        .groupBy("p")
        .agg(F.sum("m").alias("m"))
        .where(F.col("m") > route_terms)
        .select("p")
        .collect()
    )

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for prefix, suffixes, occurrences, records in zip(*(c.to_pylist() for c in batch.columns)):
                    parts: dict[str, list] = {}
                    for s, o, r in zip(suffixes, occurrences, records):
                        parts.setdefault(_route(prefix + s, heavy), []).append((s, (o, r)))
                    for to, entries in parts.items():
                        yield to, *_columns(prefix, entries)

        yield from _batches(rows(), _ROUTED_ARROW)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(trie: BurstTrie) -> Iterator[tuple]:
            for prefix, container in trie.containers():
                for suffix, (o, r) in container.items():
                    yield prefix + suffix, o, r

        def rows() -> Iterator[tuple]:
            at, trie = None, BurstTrie(burst)
            for batch in batches:
                for to, prefix, suffixes, occurrences, records in zip(*(c.to_pylist() for c in batch.columns)):
                    if to != at:
                        yield from out(trie)
                        at, trie = to, BurstTrie(burst)
                    for s, o, r in zip(suffixes, occurrences, records):
                        trie.add(prefix + s, o, r)
            yield from out(trie)

        yield from _batches(rows(), _COUNT_ARROW, 10_000)

    routed = subtries.mapInArrow(route, f"route string, {_SUBTRIE}")
    return routed.repartition(session.shuffle_partitions(records.sparkSession), "route").sortWithinPartitions("route").mapInArrow(merge, "term string, occurrences bigint, records bigint")


def marked(
    df: DataFrame, record: str, array: str, common_share: tuple[int, int] = (1, 20), rare_below: int = 15, burst: int = 256, flush: int = 500_000, route_terms: int = 100_000
) -> DataFrame:
    """``term_frequencies`` with ``share`` of all records and ``mark``: common (more than the share), rare (fewer records), else null.

    All records count for the share, those without terms included.
    """
    records = session.stage(term_records(df, record, array).select("terms"), "records")
    n = records.count()
    up, down = common_share
    return _frequencies(records, burst, flush, route_terms).select(
        "term",
        "occurrences",
        "records",
        (F.col("records") / F.lit(max(n, 1))).alias("share"),
        F.when(F.col("records").cast("decimal(20,0)") * down > F.lit(n).cast("decimal(20,0)") * up, "common").when(F.col("records") < rare_below, "rare").alias("mark"),
    )
