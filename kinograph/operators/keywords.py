"""The keyword vocabulary and its groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinograph.functions.text import matches_patterns, slugify

#: Terms of production and format that are no theme.
FORMAT_PATTERNS = (
    "based on", "sequel", "prequel", "remake", "reboot", "spin off", "spin-off", "duringcreditsstinger", "aftercreditsstinger", "3d animation",
    "stop motion", "live action remake", "silent film", "black and white", "archive footage", "making of", "behind the scenes", "interview",
    "film in film", "cinema on cinema", "movie business", "compilation", "edited from tv series", "narration", "pov (point of view)", "anthology",
    "low budget", "b movie", "video nasty", "exploitation", "pseudo-documentary", "mockumentary style", "short film", "film production",
    "cinema history", "partially lost film", "experimental film", "experimental cinema", "filmed theater", "filmmaking", "movie set", "tv show in film",
)
#: Terms of real trauma and crime.
SENSITIVE_PATTERNS = (
    "holocaust", "concentration camp", "genocide", "slavery", "human trafficking", "sex trafficking", "organ trafficking", "child trafficking",
    "war crimes", "mass murder", "hate crime", "terrorism", "child abuse", "child murder", "pedophil", "underage sex", "sexual abuse",
    "sexual assault", "sexual violence", "rape", "domestic violence", "suicide", "incest",
)


def occurrences(df: DataFrame, array: str) -> DataFrame:
    """(keyword, n): how often each element occurs, repeats within an array included; null elements do not count."""
    return df.select(F.explode(array).alias("keyword")).where(F.col("keyword").isNotNull()).groupBy("keyword").agg(F.count("*").alias("n"))


def vocabulary(df: DataFrame, array: str, least: int = 15, patterns: Sequence[str] = FORMAT_PATTERNS + SENSITIVE_PATTERNS) -> DataFrame:
    """(keyword, n) with at least ``least`` occurrences and none of the patterns; counts come first, so few rows are matched."""
    return occurrences(df, array).where(F.col("n") >= least).where(~matches_patterns(F.col("keyword"), patterns))


def unique_slugs(groups: DataFrame, key: str, label: str, most: int = 100_000) -> DataFrame:
    """(key, slug): the slug of each group's label, made unique: in the order of the keys, one that is taken gets -2, -3, ... until it is free.

    Which suffix is free depends on all slugs before, so this is a walk over
    the groups on the driver; there are ``most`` groups at most, more are an error.
    """
    rows = groups.select(F.col(key).alias("k"), slugify(F.col(label)).alias("s")).where("k is not null").orderBy("k").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} groups")
    used: set[str] = set()
    out = []
    for row in rows:
        base = row.s or ""
        slug, n = base, 1
        while slug in used:
            n += 1
            slug = f"{base}-{n}"
        used.add(slug)
        out.append((row.k, slug))
    return groups.sparkSession.createDataFrame(out, f"{key} {dict(groups.dtypes)[key]}, slug string")


def sample_per_group(members: DataFrame, group: str, item: str, n: int, seed: str = "") -> DataFrame:
    """``n`` members of each group in an order that looks random and is always the same: by a digest of seed and item."""
    keyed = members.select(group, item).distinct().withColumn("_d", F.md5(F.concat(F.lit(seed), F.col(item).cast("string"))))
    rank = F.row_number().over(W.partitionBy(group).orderBy("_d", item))
    return keyed.withColumn("pick", rank).where(F.col("pick") <= n).drop("_d")


def label_of(members: DataFrame, group: str, item: str, fallback: str = "Untitled Group", n: int = 3) -> DataFrame:
    """(group, label): the offline labeler, the first ``n`` sampled members joined, or the fallback.

    The place of a naming service: any frame of (group, label) can stand in for it.
    """
    picked = sample_per_group(members.where(F.trim(F.col(item)) != ""), group, item, n)
    text = picked.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("pick", item))).alias("x"))
    named = text.select(group, F.array_join(F.transform("x", lambda x: x[item]), ", ").alias("label"))
    return members.select(group).distinct().join(named, group, "left").select(group, F.coalesce("label", F.lit(fallback)).alias("label"))
