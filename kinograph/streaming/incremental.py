"""The incremental jobs as streams: new files in, the same batch transform, idempotent writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kinograph.operators.catalog import not_in


def process_new(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    key: str,
    target_key: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """All files of a Parquet folder that no run has seen yet, through ``transform``, appended to ``target``; then it stops.

    A batch that is done again after a failure adds nothing twice: rows whose
    key ``target`` has already are dropped by an anti-join before the transform,
    and a batch is written under its number.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def batch(df: DataFrame, number: int) -> None:
        session = df.sparkSession
        path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
        fresh = df.dropDuplicates([key])
        others = [f"{target}/{s.getPath().getName()}" for s in fs.listStatus(path) if s.getPath().getName() != f"batch={number}"] if fs.exists(path) else []
        if others:
            fresh = not_in(fresh, session.read.parquet(*others), key, target_key)
        transform(fresh).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
