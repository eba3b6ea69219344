"""Credits: who played or directed what, each person once, and the links between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinograph.functions.text import empty_to_null, prefixed
from kinograph.operators.catalog import latest_per_key


def billed(replies: DataFrame, cast_limit: int = 20) -> DataFrame:
    """A row for each of the first ``cast_limit`` cast entries and each director of a parsed reply.

    ``replies``: movie_id and ``schemas.CREDITS``.  Columns: movie_id,
    source_order (cast before crew), ordinal, the person's fields,
    credit_type, character, billing_order, job, department.  Cast rows have no
    job, crew rows no character.
    """
    person = ["id", "name", "profile_path", "known_for_department", "popularity"]
    cast = replies.select("movie_id", F.posexplode(F.slice("cast", 1, cast_limit)).alias("ordinal", "p")).select(
        "movie_id", F.lit(0).alias("source_order"), "ordinal", *(F.col(f"p.{c}") for c in person),
        F.lit("cast").alias("credit_type"), empty_to_null(F.col("p.character")).alias("character"), F.col("p.order").alias("billing_order"),
    )
    directors = replies.select("movie_id", F.posexplode(F.filter("crew", lambda x: x["job"] == "Director")).alias("ordinal", "p")).select(
        "movie_id", F.lit(1).alias("source_order"), "ordinal", *(F.col(f"p.{c}") for c in person),
        F.lit("crew").alias("credit_type"), F.col("p.job").alias("job"), F.col("p.department").alias("department"),
    )
    both = cast.unionByName(directors, allowMissingColumns=True).withColumn("id", F.col("id").try_cast("bigint"))
    return both.where(F.col("id").isNotNull()).withColumnRenamed("id", "tmdb_person_id")


def people_last_wins(rows: DataFrame, image_base: str = "") -> DataFrame:
    """One row per person: the last of their rows (by movie, cast before crew, place)."""
    last = latest_per_key(rows, "tmdb_person_id", F.col("movie_id").desc(), F.col("source_order").desc(), F.col("ordinal").desc())
    return last.select("tmdb_person_id", "name", "profile_path", prefixed(F.col("profile_path"), image_base + "w185").alias("profile_url"), "known_for_department", "popularity")


def by_person(rows: DataFrame, people: DataFrame, key: str = "tmdb_person_id", column: str = "person_id") -> DataFrame:
    """``rows`` with the people table's own ``column``; a credit of a person that it does not have is left out, and repeated people do not repeat credits."""
    return rows.join(people.where(F.col(column).isNotNull()).groupBy(key).agg(F.min(column).alias(column)), key)


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``source``: equal keys are replaced, new ones added; columns only ``target`` has are kept.

    Both have one row per key.  One full outer join; write the result to a new
    place and then point readers at it (``sources.sinks``), as Parquet has no merge.
    """
    names = [c for c in target.columns if c != key]
    s = source.select(F.col(key), *(F.col(c).alias(f"_s_{c}") for c in names if c in source.columns), F.lit(True).alias("_hit"))
    joined = target.join(s, key, "full_outer")
    return joined.select(key, *(F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in source.columns else F.col(c) for c in names))


def patch(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``target`` with the columns of ``changes`` set where its key is hit, to null too; other keys of ``changes`` are ignored."""
    changed = [c for c in changes.columns if c != key]
    p = changes.select(F.col(key), *(F.col(c).alias(f"_p_{c}") for c in changed), F.lit(True).alias("_hit"))
    joined = target.join(p, key, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in target.columns))


def director_lists(rows: DataFrame) -> DataFrame:
    """(movie_id, director_credits): the directors of a movie in order, as an array of (id, name); movies without one have no row."""
    crew = rows.where(F.col("credit_type") == "crew")
    return (
        crew.groupBy("movie_id")
        .agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("tmdb_person_id").alias("id"), "name"))).alias("x"))
        .select("movie_id", F.transform("x", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"))).alias("director_credits"))
    )
