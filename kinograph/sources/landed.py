"""Sources: landed JSON replies, tables, and batched calls of outside services."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from queue import Empty, Queue
from threading import Thread
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinograph import schemas


def json_replies(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Landed JSON replies, one per line, under an explicit schema.

    ``strict`` fails on a broken line; a silent skip would look like the end of
    the data.  Otherwise broken lines are null rows.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def discovered(
    spark: SparkSession,
    path: str,
    least_votes: int | None = None,
    released_from: Column | None = None,
    least_popularity: float | None = None,
    where: Column | None = None,
    partition: str = "",
) -> DataFrame:
    """The movies of landed discovery pages, filtered as the service would; a movie on several pages counts once.

    Pages may lie in folders of a column ``partition`` (name and type); of
    these only those for which ``where`` holds are read.
    """
    pages = json_replies(spark, path, ", ".join(filter(None, (schemas.DISCOVER_PAGE, partition))))
    if where is not None:
        pages = pages.where(where)
    rows = pages.select(F.explode("results").alias("r")).select("r.*")
    if least_votes is not None:
        rows = rows.where(F.col("vote_count") >= least_votes)
    if released_from is not None:
        rows = rows.where(F.col("release_date").try_cast("date") >= released_from)
    if least_popularity is not None:
        rows = rows.where(F.col("popularity") >= least_popularity)
    return rows.groupBy("id").agg(F.max("vote_count").alias("vote_count"), F.max("popularity").alias("popularity"), F.max("release_date").alias("release_date"))


def parsed(df: DataFrame, payload: str, schema: str, into: str = "reply") -> DataFrame:
    """``df`` with its JSON text parsed under a schema; text that does not fit is null."""
    return df.withColumn(into, F.from_json(F.col(payload), schema, {"mode": "PERMISSIVE"}))


def embeddings_of(replies: DataFrame) -> DataFrame:
    """(batch, index, embedding) of embedding replies (``schemas.EMBEDDINGS``), keyed by place, whatever their order."""
    return replies.select("batch", F.explode("reply.data").alias("d")).select("batch", F.col("d.index").alias("index"), F.col("d.embedding").alias("embedding"))


class Busy(Exception):
    """The service asks to wait."""


def within(call: Callable[[Any], Any], seconds: float) -> Callable[[Any], Any]:
    """``call``, given up with TimeoutError after so many seconds; its thread is left behind and ends with the worker."""

    def run(batch: Any) -> Any:
        answer: Queue = Queue()

        def ask() -> None:
            try:
                answer.put((call(batch), None))
            except BaseException as e:  # passed on to the caller
                answer.put((None, e))

        Thread(target=ask, daemon=True).start()
        try:
            value, error = answer.get(timeout=seconds)
        except Empty:
            raise TimeoutError(f"no answer within {seconds} s") from None
        if error is not None:
            raise error
        return value

    return run


def with_retry(call: Callable[[Any], Any], tries: int = 8, wait: float = 21.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[Any], Any]:
    """``call``, again after ``wait`` seconds times the number of tries so far where it is Busy; other errors pass."""

    def run(batch: Any) -> Any:
        for n in range(1, tries + 1):
            try:
                return call(batch)
            except Busy:
                if n == tries:
                    raise
                sleep(wait * n)

    return run


def pulled(df: DataFrame, column: str, call: Callable[[Sequence[Any]], Sequence[Any]], kind: str, batch: int = 128, concurrency: int | None = None, tries: int = 8, wait: float = 21.0, timeout: float = 15.0) -> DataFrame:
    """``df`` with a column ``reply``: ``call`` over batches of ``column``, at most ``concurrency`` at a time, none longer than ``timeout`` seconds.

    Concurrency is the number of partitions, batching Arrow's; ``call`` gets a
    list and gives a list of the same length.  An embedder, a labeler or a
    fetcher is such a call.
    """
    if concurrency:
        df = df.repartition(concurrency)
    schema = ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), f"reply {kind}"])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = with_retry(within(call, timeout), tries, wait)
        for frame in frames:
            for lo in range(0, len(frame), batch):
                part = frame.iloc[lo : lo + batch]
                replies = ask(part[column].tolist())
                if len(replies) != len(part):
                    raise ValueError(f"{len(replies)} replies for {len(part)} inputs")
                yield part.assign(reply=list(replies))

    return df.mapInPandas(run, schema)
