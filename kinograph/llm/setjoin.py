"""All similar pairs between set-valued records: a size-aware overlap join.

For two sets of a and b values, Jaccard >= t is the same as an overlap of at
least need(a, b) = ceil(t (a + b) / (1 + t)).

* Sets that are equal are one *class*, told apart by their values, not by a
  digest; the join runs over classes, and copies are put back at the end (or
  left as classes and membership).
* Values get whole numbers, rare ones first, so a set is an ascending list of
  numbers; two values never share one.
* Small sets, those with at most ``max_keys`` threshold-sized subsets over all
  partner sizes, enumerate these subsets.  Two classes that share a subset of
  need(a, b) values of a partnership (a, b) have at least that overlap.
* Large sets scan inverted lists.  Of two similar sets, the first
  s - ceil(t s) + 1 values of both have one in common, so only the lists of
  those are kept.  An entry holds the place of the value in its set and 64 bits
  of the set, no values: a pair is scanned only if the sizes, what is left
  behind the two places, and the bits in which the sets differ allow the
  overlap.  The list of a value that very many sets have is scanned by several
  tasks, each with a share of the probes.
* The values of the pairs that are left are fetched once a pair and compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from itertools import combinations
from math import ceil, comb, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinograph import session
from kinograph.llm.records import dense_codes

_KEYS = pa.schema([("key", pa.int64()), ("cls", pa.int64())])


def need(a: int, b: int, t: Fraction) -> int:
    """The overlap that sets of a and b values must have for Jaccard >= t."""
    return max(1, ceil(t * (a + b) / (1 + t)))


def partner_sizes(s: int, t: Fraction) -> range:
    return range(ceil(t * s), floor(s / t) + 1)


def subset_keys(s: int, t: Fraction) -> int:
    """How many threshold-sized subsets a set of ``s`` values has over all its partner sizes."""
    return sum(comb(s, need(s, b, t)) for b in partner_sizes(s, t) if need(s, b, t) <= min(s, b))


def small_limit(t: Fraction, max_keys: int) -> int:
    """The largest size, 64 at most, up to which every set has at most ``max_keys`` subset keys."""
    s = 0
    while s < 64 and subset_keys(s + 1, t) <= max_keys:
        s += 1
    return s


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _subset_rows(t: Fraction, limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, list[tuple[int, np.ndarray]]] = {}
        for batch in batches:
            cls = batch.column(0).to_numpy()
            lists = batch.column(1)
            values = lists.flatten().to_numpy().view(np.uint64)
            sizes = np.diff(lists.offsets.to_numpy())
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            for s in np.unique(sizes):
                s = int(s)
                if s not in plans:
                    plans[s] = [
                        (min(s, b) << 32 | max(s, b), np.array(list(combinations(range(s), need(s, b, t)))))
                        for b in partner_sizes(s, t)
                        if b <= limit and need(s, b, t) <= min(s, b)
                    ]
                at = np.flatnonzero(sizes == s)
                for lo in range(0, len(at), 4096):
                    rows = at[lo : lo + 4096]
                    sets = _mix(values[starts[rows][:, None] + np.arange(s)])  # a set's values are sorted, so a subset is summed alike on both sides
                    for salt, choose in plans[s]:
                        sums = sets[:, choose].sum(axis=2, dtype=np.uint64)
                        keys = _mix(sums + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(cls[rows], len(choose)))], schema=_KEYS)

    return run


def _needed(a: Column, b: Column, t: Fraction) -> Column:
    """need(a, b) of two size columns, in whole numbers."""
    up, down = t.numerator, t.numerator + t.denominator
    return F.ceil(((a + b) * up).cast("decimal(20,0)") / F.lit(down).cast("decimal(20,0)"))


def _classes(sets: DataFrame, record: str, values: str, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(cls, strings) of the distinct sets and (record, cls): ``cls`` is a number given to each, whatever the digests."""
    clean = sets.select(
        F.col(f"`{record}`").alias("record"), F.array_sort(F.array_distinct(F.array_compact(F.col(f"`{values}`")))).alias("strings")
    ).where(F.size("strings") > 0)
    clean = session.stage(clean.withColumn("h", digest(F.col("strings"))), "sets")
    distinct = clean.groupBy("h", "strings").agg(F.lit(1).alias("_"))
    classes = session.stage(distinct.select(F.monotonically_increasing_id().alias("cls"), "h", "strings"), "classes")
    shared = classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")  # digests that different sets have: next to none
    names = clean.select("record", "h")
    if not shared.limit(1).count():
        return classes.select("cls", "strings"), names.join(classes.select("cls", "h"), "h").select("record", "cls")
    alone = names.join(classes.join(shared, "h", "left_anti").select("cls", "h"), "h").select("record", "cls")
    doubtful = clean.join(shared, "h", "left_semi").join(classes, ["h", "strings"]).select("record", "cls")
    return classes.select("cls", "strings"), alone.unionByName(doubtful)


def similar_sets(
    sets: DataFrame, record: str, values: str, threshold: str = "0.7", max_keys: int = 96, hot: int = 50_000, digest: Callable[[Column], Column] = F.xxhash64
) -> tuple[DataFrame, DataFrame]:
    """Similar classes and who is in them: ``(pairs, members)``.

    ``sets`` has one row per record, ``values`` an array of strings.
    ``pairs``: cls_a < cls_b (bigint), overlap and union, for every two
    different sets with overlap >= threshold * union.  ``members``: record,
    cls, for every record with a non-empty set; records with equal sets have
    the same class, whose pairs with each other are not listed.

    * null and empty sets are in no class and no pair; null values are left out, repeated ones count once;
    * repeated rows of a record are members that repeat; make ``record`` a key first;
    * ties at the threshold count (>=, compared in whole numbers);
    * sets of any size: beyond the small ones the inverted lists serve;
    * an empty table gives two empty tables; other columns are not read.

    Keys of subsets are 64-bit hashes, which may bring more pairs to the last
    comparison but take none away.  ``hot``: entries of a list that one task scans.
    """
    t = Fraction(threshold)
    if not 0 < t <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    limit = small_limit(t, max_keys)
    named, members = _classes(sets, record, values, digest)
    members = session.stage(members, "members")
    codes = dense_codes(named.select(F.explode("strings").alias("string")).groupBy("string").agg(F.count("*").alias("f")), F.col("f"), F.col("string"))
    coded = named.select("cls", F.explode("strings").alias("string")).join(codes.select("string", "code"), "string")
    classes = coded.groupBy("cls").agg(F.array_sort(F.collect_list("code")).alias("v")).withColumn("size", F.size("v"))
    classes = session.stage(classes, "coded")

    keys = classes.where(F.col("size") <= limit).select("cls", F.col("v").cast("array<bigint>").alias("v")).mapInArrow(_subset_rows(t, limit), "key bigint, cls bigint")
    by_subset = (
        keys.select("key", F.col("cls").alias("cls_a"))
        .join(keys.select("key", F.col("cls").alias("cls_b")), "key")
        .where(F.col("cls_a") < F.col("cls_b"))
        .select("cls_a", "cls_b")
    )

    least = ceil(t * (limit + 1))  # the smallest partner of a large set
    bits = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(x, F.lit(64)).cast("int"))))
    prefix = F.col("size") - F.ceil((F.col("size") * t.numerator).cast("decimal(20,0)") / F.lit(t.denominator).cast("decimal(20,0)")).cast("int") + 1
    lists = classes.where(F.col("size") >= least).select("cls", "size", bits.alias("bits"), F.posexplode(F.slice("v", F.lit(1), prefix)).alias("at", "token"))
    lists = session.stage(lists, "lists")
    shares = lists.groupBy("token").agg(F.ceil(F.count("*") / hot).cast("int").alias("shares")).where("shares > 1")
    salted = lists.join(shares, "token", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    entry = lambda df, p: df.select("token", "salt", *(F.col(c).alias(p + c) for c in ("cls", "size", "bits", "at")))
    probe = entry(salted.where(F.col("size") > limit).withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("shares")).cast("int")), "p")
    index = entry(salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))), "q")
    wanted = _needed(F.col("psize"), F.col("qsize"), t)
    by_list = (
        probe.join(index, ["token", "salt"])
        .where((F.col("pcls") != F.col("qcls")) & ((F.col("qsize") <= limit) | (F.col("pcls") < F.col("qcls"))))
        .where((F.col("qsize") * t.denominator >= F.col("psize") * t.numerator) & (F.col("psize") * t.denominator >= F.col("qsize") * t.numerator))
        # at the first value that both have; what other common values let through or not does not matter
        .where(F.least(F.col("psize") - F.col("pat"), F.col("qsize") - F.col("qat")) >= wanted)
        .where(F.bit_count(F.col("pbits").bitwiseXOR(F.col("qbits"))) <= F.col("psize") + F.col("qsize") - 2 * wanted)
        .select(F.least("pcls", "qcls").alias("cls_a"), F.greatest("pcls", "qcls").alias("cls_b"))
    )
    candidates = session.stage(by_subset.unionByName(by_list).distinct(), "candidates")
    side = lambda c, s: classes.select(F.col("cls").alias(c), F.col("v").alias(s))
    pairs = (
        candidates.join(side("cls_a", "sa"), "cls_a")
        .join(side("cls_b", "sb"), "cls_b")
        .withColumn("overlap", F.size(F.array_intersect("sa", "sb")))
        .withColumn("union", F.size("sa") + F.size("sb") - F.col("overlap"))
        .where(F.col("overlap") * t.denominator >= F.col("union") * t.numerator)
        .select("cls_a", "cls_b", "overlap", "union")
    )
    return pairs, members


def member_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(record_a, record_b), smaller first: every two different records whose sets are similar or equal.

    m copies of a set give m (m - 1) / 2 rows, as many as the result has by its
    definition; ``pairs`` and ``members`` say the same in a row a record.
    """
    side = lambda c, r: members.select(F.col("cls").alias(c), F.col("record").alias(r))
    across = pairs.join(side("cls_a", "a"), "cls_a").join(side("cls_b", "b"), "cls_b")
    shared = members.groupBy("cls").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("cls")
    copies = members.join(shared, "cls", "left_semi")
    within = copies.select("cls", F.col("record").alias("a")).join(copies.select("cls", F.col("record").alias("b")), "cls").where(F.col("a") < F.col("b"))
    return across.select(F.least("a", "b").alias("record_a"), F.greatest("a", "b").alias("record_b")).unionByName(
        within.select(F.col("a").alias("record_a"), F.col("b").alias("record_b"))
    )
