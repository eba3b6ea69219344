"""Records with an array of values, one row per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinograph import session
from kinograph.functions.terms import term_list


def one_per_record(df: DataFrame, record: str, *arrays: str) -> DataFrame:
    """(record, then each array) with one row per non-null record; an array is empty where it is null.

    Rows that repeat a record are taken as one: arrays that are equal count
    once, those that differ are joined end to end, so nothing is lost and
    repeated rows never count twice.  Other columns are not read.
    """
    return (
        df.select(F.col(f"`{record}`").alias("record"), *(F.col(f"`{a}`").alias(a) for a in arrays))
        .where(F.col("record").isNotNull())
        .groupBy("record")
        .agg(*(F.flatten(F.array_sort(F.collect_set(a))).alias(a) for a in arrays))
    )


def term_records(df: DataFrame, record: str, array: str) -> DataFrame:
    """(record, terms): the terms of a record's array, in order, repeats kept; maybe empty."""
    return one_per_record(df, record, array).select("record", term_list(F.col(f"`{array}`")).alias("terms"))


def dense_codes(values: DataFrame, *order: Column) -> DataFrame:
    """``values`` staged with a column ``code``: 0, 1, 2, ... in the given order, without gaps.

    The order is made by range over the tasks; the driver sees a count per task.
    """
    spark = values.sparkSession
    ranged = values.repartitionByRange(session.shuffle_partitions(spark), *order).withColumn("_p", F.spark_partition_id())
    ranged = session.stage(ranged, "ranged")
    sizes = {r["_p"]: r["count"] for r in ranged.groupBy("_p").count().collect()}
    offsets, total = {}, 0
    for p in sorted(sizes):
        offsets[p], total = total, total + sizes[p]
    if not offsets:
        return session.stage(ranged.drop("_p").withColumn("code", F.lit(0)), "codes")
    offset = F.create_map(*(F.lit(x) for kv in offsets.items() for x in kv))[F.col("_p")]
    place = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return session.stage(ranged.withColumn("code", (offset + place - 1).cast("int")).drop("_p"), "codes")
