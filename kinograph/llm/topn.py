"""Top N items within every group.

Plan: one partial-then-final aggregation on (group, item) keeps an item's best
value; then ``row_number`` over the group with a rank filter.  Catalyst puts a
``WindowGroupLimit`` on both sides of the second shuffle, so a map task sends
at most N rows of a group however many it holds, and the hash of the first
shuffle has the item in it.  A group with a third of all rows is therefore
spread over all tasks until N rows a task are left of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    item: str,
    value: str,
    n: int = 10,
    descending: bool = True,
    rank: str = "rnk",
) -> DataFrame:
    """The first ``n`` distinct items of every group.

    Returns the group columns, ``item``, ``value`` (the item's best) and
    ``rank`` (1, 2, ...).

    * a null or NaN value, or a null item: the row does not count;
    * a null group column: null is a group like any other;
    * an item that is repeated in a group counts once, with its best value;
    * equal values: by ``item`` ascending (strings by code point), so the order is total;
    * an empty table, or a group with no row that counts: no row;
    * other columns are not read, whatever their names; -0.0 and 0.0 are equal.
    """
    if n < 1:
        raise ValueError("n must be positive")
    keys = [F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(group)]
    kind = dict(df.dtypes)[value]
    v = F.col(f"`{value}`")
    keep = v.isNotNull() & F.col(f"`{item}`").isNotNull()
    if kind in ("double", "float"):
        keep &= ~F.isnan(v)
        v = v + F.lit(0.0).cast(kind)
    names = [f"g{i}" for i in range(len(group))]
    best = (
        df.where(keep)
        .select(*keys, F.col(f"`{item}`").alias("i"), v.alias("v"))
        .groupBy(*names, "i")
        .agg((F.max if descending else F.min)("v").alias("v"))
    )
    order = W.partitionBy(*names).orderBy(F.col("v").desc() if descending else F.col("v").asc(), F.col("i").asc())
    ranked = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n)
    return ranked.select(*(F.col(k).alias(c) for k, c in zip(names, group)), F.col("i").alias(item), F.col("v").alias(value), F.col("r").alias(rank))
