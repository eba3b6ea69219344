"""The catalogue: one row per movie, what is new, the tiered rank and the flat projection of nested replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinograph import session
from kinograph.functions.text import empty_to_null, prefixed, year_of


def latest_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first by ``order``.

    The rank filter becomes a group limit on both sides of the shuffle, so a
    key with very many rows sends one row a task.
    """
    return df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def movies_once(movies: DataFrame) -> DataFrame:
    """One row per movie id: the latest, then the most voted and most popular, then by its other columns, so that the choice is always the same."""
    named = movies.where(F.col("id").isNotNull())
    first = [c for c in ("updated_at", "vote_count", "popularity") if c in movies.columns]
    rest = [c for c, kind in movies.dtypes if c not in first and c != "id" and "map<" not in kind]
    return latest_per_key(named, "id", *(F.col(c).desc_nulls_last() for c in (*first, *rest)))


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """The rows of ``df`` whose key ``other`` does not have; null keys of ``df`` stay, duplicates too."""
    return df.join(other.select(F.col(other_key or key).alias(key)).where(F.col(key).isNotNull()), key, "left_anti")


def tiered_rank(tiers: Sequence[tuple[DataFrame, str]], cap: int, key: str = "id") -> DataFrame:
    """(key, tier, rank) of the first ``cap`` rows: tier by tier, in each by its score descending, ties by key.

    A key counts in its first tier only, once, with its best score.  ``tiers``
    are pairs of a frame and its score column.  The cap is taken by a
    distributed top-k before the global rank, so the single task of the rank
    sees ``cap`` rows at most.
    """
    union = None
    for i, (df, score) in enumerate(tiers):
        part = df.select(F.col(key).alias("key"), F.lit(i).alias("tier"), F.col(score).cast("double").alias("score"))
        union = part if union is None else union.unionByName(part)
    best = latest_per_key(union.where(F.col("key").isNotNull()), "key", F.col("tier"), F.col("score").desc_nulls_last())
    order = [F.col("tier"), F.col("score").desc_nulls_last(), F.col("key")]
    first = best.orderBy(*order).limit(cap)
    return first.select(F.col("key").alias(key), "tier", F.row_number().over(W.orderBy(*order)).alias("rank"))


def recent_and_established(movies: DataFrame, cutoff: Column, recent_popularity: float = 20.0, least_votes: int = 20, cap: int = 250_000) -> DataFrame:
    """The catalogue's selection: recent releases by popularity, then all with enough votes by their number."""
    released = F.col("release_date").try_cast("date")
    recent = movies.where((released >= cutoff) & (F.col("popularity") >= recent_popularity))
    established = movies.where(F.col("vote_count") >= least_votes)
    return tiered_rank([(recent, "popularity"), (established, "vote_count")], cap)


def flat_movie(detail: DataFrame, image_base: str = "") -> DataFrame:
    """A nested movie detail (``schemas.MOVIE_DETAIL``) as one flat row.

    Missing numbers stay null while 0 is kept; empty strings of the release
    date and tagline become null; arrays keep their order, the cast its first ten.
    """
    names = lambda c: F.transform(F.coalesce(c, F.array().cast("array<struct<name:string>>")), lambda x: x["name"])
    crew = F.coalesce(F.col("credits.crew"), F.array().cast("array<struct<name:string,job:string>>"))
    return detail.select(
        F.col("id").alias("tmdb_id"),
        "title",
        "original_title",
        "overview",
        empty_to_null(F.col("tagline")).alias("tagline"),
        "original_language",
        "imdb_id",
        empty_to_null(F.col("release_date")).alias("release_date"),
        year_of(F.col("release_date")).alias("release_year"),
        "runtime",
        "budget",
        "revenue",
        "vote_average",
        "vote_count",
        "popularity",
        "adult",
        "poster_path",
        prefixed(F.col("poster_path"), image_base + "w500").alias("poster_url"),
        "backdrop_path",
        prefixed(F.col("backdrop_path"), image_base + "w1280").alias("backdrop_url"),
        names(F.col("genres")).alias("genres"),
        names(F.col("keywords.keywords")).alias("keywords"),
        F.slice(names(F.col("credits.cast")), 1, 10).alias("top_cast"),
        F.transform(F.filter(crew, lambda x: x["job"] == "Director"), lambda x: x["name"]).alias("directors"),
        names(F.col("production_companies")).alias("production_companies"),
    )


def by_votes(movies: DataFrame, nulls_first: bool = True) -> DataFrame:
    """(id, vote_count, rank): all movies by votes, most first, ties by id; ``nulls_first`` puts unknown votes before all, as a descending sort of the catalogue's store does.

    The global rank is made by range: each task numbers its range and adds the rows of the ranges before it.
    """
    votes = F.col("vote_count").desc_nulls_first() if nulls_first else F.col("vote_count").desc_nulls_last()
    ranged = session.stage(movies.select("id", "vote_count").repartitionByRange(session.shuffle_partitions(movies.sparkSession), votes, "id").withColumn("_p", F.spark_partition_id()), "by-votes")
    before, total = {}, 0
    for p, n in sorted((r["_p"], r["count"]) for r in ranged.groupBy("_p").count().collect()):  # a row per task
        before[p], total = total, total + n
    if not before:
        return ranged.select("id", "vote_count", F.lit(0).cast("bigint").alias("rank"))
    offset = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("_p")]
    place = F.row_number().over(W.partitionBy("_p").orderBy(votes, "id"))
    return ranged.select("id", "vote_count", (offset + place).cast("bigint").alias("rank"))


def page(df: DataFrame, key: str, after: str | int | None, n: int) -> DataFrame:
    """The ``n`` rows after a key, by key: one page of a keyset walk."""
    rest = df if after is None else df.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(n)


def missing_values(df: DataFrame, array: str) -> DataFrame:
    """The rows whose array is null or empty (null is tested first, as the size of null is null)."""
    return df.where(F.col(array).isNull() | (F.size(array) == 0))
