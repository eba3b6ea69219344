"""Filling containers of fixed capacity with texts: bounded-space online best-fit.

Token counts are made where the texts lie, so texts are not shuffled.  The
(id, tokens) rows are laid into shards by hash of the id and packed shard by
shard in the order of the ids: at most ``open_bins`` containers are open at a
time, kept in a bitset by free space, an item goes to the fullest one that
holds it, and when a new one is needed and all are open, the fullest closes.
A shard's waste is at most its open containers, a small share of the thousands
it fills.  Container names hold profile, shard and number, so the result does
not depend on the number of tasks and a lost task makes the same again.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinograph import session

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the published split pattern of the byte-level vocabulary.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_COUNTS = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64())])
_PACKED = pa.schema([("profile", pa.string()), ("container", pa.string()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("token_from", pa.int64()), ("token_to", pa.int64())])


def tokenizer(folder: str, name: str):
    """The byte-level tokenizer of a rank file, special tokens being ordinary text."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(folder, name).read_bytes().splitlines())}
    return tiktoken.Encoding(name, pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, tokens) of every row with a doc_id and a text; an empty text has 0 tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(folder, name).encode_ordinary
        for batch in batches:
            counts = [len(encode(x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], schema=_COUNTS)

    return (
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
        .where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(run, "doc_id bigint, tokens bigint")
    )


class BestFit:
    """Bounded-space best-fit: ``place`` gives the number of the container that takes an item."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free_bits = 0  # bit f: a container with f free units is open
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.open = self.made = 0

    def new(self) -> int:
        self.made += 1
        return self.made - 1

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.free_bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, size: int) -> int:
        fits = self.free_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.open_bins:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)  # the fullest closes
            number, free = self.new(), self.capacity
        if free > size:
            self.by_free[free - size].append(number)
            self.free_bits |= 1 << (free - size)
            self.open += 1
        return number


def pack(documents: DataFrame, capacities: Sequence[tuple[str, int]], folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken", open_bins: int = 64, shard_docs: int = 20_000) -> DataFrame:
    """The container of each text or piece of a text, for each (profile, capacity).

    Returns profile, container, doc_id, piece (from 0), token_from, token_to
    (tokens of the text, end exclusive).  Only a text longer than the capacity
    is split: into full containers of its own and a rest, which is packed like
    an item.

    * null ids and null texts take no container and have no row; an empty text is an item of 0 tokens;
    * rows that repeat a doc_id are packed each;
    * equal fits: the container that was filled last; the order of items is that of doc_id;
    * texts of any length; an empty table gives no row; other columns are not read.
    """
    for _, capacity in capacities:
        if capacity < 1:
            raise ValueError("capacities must be positive")
    counts = token_counts(documents, folder, name)
    shards = max(1, -(-documents.count() // shard_docs))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bins = None, []
        for batch in batches:
            rows: list[tuple] = []
            for shard, doc, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    at, bins = shard, [(profile, capacity, BestFit(capacity, open_bins)) for profile, capacity in capacities]
                for profile, capacity, fit in bins:
                    whole = tokens // capacity if tokens > capacity else 0
                    for p in range(whole):
                        rows.append((profile, f"{profile}-{shard}-{fit.new()}", doc, p, p * capacity, (p + 1) * capacity))
                    rest = tokens - whole * capacity
                    if rest or not whole:
                        rows.append((profile, f"{profile}-{shard}-{fit.place(rest)}", doc, whole, whole * capacity, tokens))
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED)], schema=_PACKED)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED)], schema=_PACKED)

    return (
        counts.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
        .select("shard", "doc_id", "tokens")
        .repartition(session.shuffle_partitions(documents.sparkSession), "shard")
        .sortWithinPartitions("shard", "doc_id", "tokens")
        .mapInArrow(run, "profile string, container string, doc_id bigint, piece int, token_from bigint, token_to bigint")
    )
