"""Sinks: versioned tables, partition overwrite, audit of runs.

Parquet has no transactions, so a table is a folder of versions and of
pointers ``_at-<number>``, each the name of a version; the pointer with the
highest number is the table.  A writer fills a new version, writes the next
pointer beside the table and renames it into place.  No step takes a pointer
away before the next one stands, so a reader sees the old or the new table at
every moment, and a writer that dies changes nothing.  Two writers at once: the
second rename finds the number taken and fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinograph import schemas, session
from kinograph.operators.credits import upsert


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, table: str) -> dict[int, str]:
    _, where, fs = _fs(spark, table)
    if not fs.exists(where):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(where)]
    found = {int(n[4:]): n for n in names if n.startswith("_at-") and n[4:].isdigit()}
    if not found and any(n.startswith("v-") and fs.exists(_fs(spark, f"{table}/{n}/_SUCCESS")[1]) for n in names):
        raise OSError(f"{table} has versions but no pointer")
    return found


def current(spark: SparkSession, table: str) -> str | None:
    """The folder of a table's current version, None before the first; versions without any pointer are an error."""
    found = _pointers(spark, table)
    if not found:
        return None
    jvm, where, fs = _fs(spark, f"{table}/{found[max(found)]}")
    stream = fs.open(where)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{table}/{name}"


def replace(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), expected: int | None = None) -> str:
    """The whole table anew; gives the version's folder.  ``expected``: the pointer that must still be the last, as ``merge`` needs it."""
    spark = df.sparkSession
    last = max(_pointers(spark, table), default=0) if expected is None else expected
    name = f"v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{table}/{name}")
    jvm, draft, fs = _fs(spark, f"{table}/_draft-{name}")
    out = fs.create(draft, True)
    out.write(name.encode())
    out.close()
    pointer = jvm.org.apache.hadoop.fs.Path(f"{table}/_at-{last + 1:012d}")
    if fs.exists(pointer) or not fs.rename(draft, pointer):
        raise OSError(f"another writer has changed {table}")
    for number, old in _pointers(spark, table).items():
        if number < last:  # the one before stays for readers that are just reading it
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table}/{old}"), False)
    return f"{table}/{name}"


def read(spark: SparkSession, table: str) -> DataFrame:
    at = current(spark, table)
    if at is None:
        raise FileNotFoundError(table)
    return spark.read.parquet(at)


def append(df: DataFrame, path: str) -> None:
    """Rows added to a plain Parquet folder; Spark splits them, so there are no chunks."""
    df.write.mode("append").parquet(path)


def merge(df: DataFrame, table: str, key: str) -> str:
    """``df`` upserted into a versioned table; fails if another writer changes it meanwhile."""
    last = max(_pointers(df.sparkSession, table), default=0)
    at = current(df.sparkSession, table)
    return replace(df if at is None else upsert(df.sparkSession.read.parquet(at), df, key), table, expected=last)


def write_rails(df: DataFrame, path: str) -> None:
    """Neighbour rows by rail; only the rails in ``df`` are overwritten."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("recommendation_type").parquet(path)


def with_new_ids(df: DataFrame, table: DataFrame | None, key: str, column: str) -> DataFrame:
    """``df`` (one row per key) with a number per row in ``column``: that of its key in ``table``, or the next free ones, without gaps, for new keys by their order.

    The reply of an insert that returns ids.  Ranges of keys are numbered by
    the tasks; the driver sees the largest number and a count per task.
    """
    spark = df.sparkSession
    known = df.withColumn(column, F.lit(None).cast("bigint")) if table is None else df.join(table.select(key, F.col(column).cast("bigint").alias(column)), key, "left")
    known = session.stage(known, "ids")
    top = 0 if table is None else table.agg(F.max(column)).first()[0] or 0
    ranged = session.stage(known.where(F.col(column).isNull()).repartitionByRange(session.shuffle_partitions(spark), key).withColumn("_p", F.spark_partition_id()), "new-ids")
    before, total = {}, top
    for p, n in sorted((r["_p"], r["count"]) for r in ranged.groupBy("_p").count().collect()):
        before[p], total = total, total + n
    old = known.where(F.col(column).isNotNull())
    if not before:
        return old
    offset = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("_p")]
    new = ranged.withColumn(column, (offset + F.row_number().over(W.partitionBy("_p").orderBy(key))).cast("bigint")).drop("_p")
    return old.unionByName(new)


def counted(df: DataFrame, failed: Column | None = None) -> tuple[DataFrame, Callable[[], tuple[int, int]]]:
    """``df`` with counters that Spark fills while it is written, and a call that gives (rows processed, rows failed) once it was.

    Rows for which ``failed`` holds are counted as failed.  An observation is
    filled by the first action on the frame.
    """
    from pyspark.sql import Observation

    seen = Observation()
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    watched = df.observe(seen, F.count_if(~bad).alias("done"), F.count_if(bad).alias("failed"))
    return watched, lambda: (seen.get["done"], seen.get["failed"])


def audited(spark: SparkSession, run_type: str, path: str, job: Callable[[], tuple[int, int]], dry_run: bool = False) -> DataFrame:
    """Runs ``job`` (-> rows processed, rows failed) and appends how it went; a failure is written down and passed on.

    A dry run runs the job and writes nothing.  Gives the run's row.
    """
    run, began = uuid.uuid4().hex, datetime.now(timezone.utc)

    def row(status: str, done: int, failed: int, message: str | None) -> DataFrame:
        return spark.createDataFrame([(run, run_type, status, began, datetime.now(timezone.utc), done, failed, message)], schemas.RUNS)

    try:
        done, failed = job()
    except Exception as e:
        if not dry_run:
            append(row("failed", 0, 0, str(e)[:2000]), path)
        raise
    out = row("success", done, failed, None)
    if not dry_run:
        append(out, path)
    return out
