"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every plan of this library is written for.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(app: str = "kinograph", **conf: str) -> SparkSession:
    """A session with DEFAULTS, then ``conf`` (keys with ``__`` for dots)."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that checkpoints go to.

    ``spark.checkpoint.dir`` names the shared folder of a cluster and always
    wins.  Only where it is unset, and only for a local master, a temporary
    folder is made; a cluster without the setting is an error, as a folder of
    one machine would be lost with it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kinograph-checkpoint-"))
    return sc.getCheckpointDir()


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read back, its lineage cut there.

    Losing an executor afterwards costs nothing, as the files lie on the
    shared folder; unlike ``checkpoint()`` the plan runs once and the columns
    that a reader does not want are not read.  The folder is removed when the
    driver's Python ends.
    """
    spark = df.sparkSession
    path = temporary(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/kinograph-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def temporary(spark: SparkSession, path: str) -> str:
    """``path``, which is removed with all in it when the driver's Python ends."""
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is over; the folder's owner clears what is left
        pass


def slots(spark: SparkSession) -> int:
    """Cores that run tasks at the same time, as far as the session knows."""
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
