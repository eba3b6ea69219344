"""The registered core queries, each a function of (spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinograph import schemas, session
from kinograph.functions import text as text_functions
from kinograph.functions.vectors import dist, dot, norm, normalize, parse_literal, to_literal, usable
from kinograph.operators import catalog, clustering, credits, keywords, nested
from kinograph.operators import rails as rail_operators
from kinograph.sources import landed, sinks
from kinograph.streaming import incremental
from kinograph.tables import table

DIM = 64
#: The day that "now" stands for, so that a query gives the same rows on every day.
AS_OF = "2024-08-31"
AUDITED = ("darker_pick", "more_accessible", "hidden_gem")


# ---- vectors and texts


def movie_vectors(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """(id, v, ...) of the movies with a usable vector, one row each."""
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "essence_vector", "updated_at", "vote_count", "popularity", *more))
    return movies.withColumn("v", parse_literal(F.col("essence_vector"), DIM)).where(usable(F.col("v"))).select("id", "v", "vote_count", *more)


def cluster_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(id, v) of the clusters with a usable centroid."""
    clusters = table(spark, folder, "movie_theme_clusters", "id", "centroid")
    return clusters.withColumn("v", parse_literal(F.col("centroid"), DIM)).where(usable(F.col("v"))).select("id", "v")


def vec_normalize(spark: SparkSession, folder: str) -> DataFrame:
    scaled = table(spark, folder, "embeddings", "vec_id", "embedding").withColumn(
        "v", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * (1 + F.col("vec_id") % 7))
    )
    unit = scaled.withColumn("u", normalize(F.col("v")))
    return unit.select("vec_id", F.round(norm(F.col("v")), 4).alias("before"), F.round(norm(F.col("u")), 6).alias("after"), F.round(F.col("u")[0], 6).alias("first"))


def vec_pair_distance(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "movie_cluster_assignments", "movie_id", "cluster_id").distinct()
    movies = movie_vectors(spark, folder).select(F.col("id").alias("movie_id"), F.col("v").alias("a"))
    clusters = cluster_vectors(spark, folder).select(F.col("id").alias("cluster_id"), F.col("v").alias("b"))
    joined = pairs.join(movies, "movie_id").join(clusters, "cluster_id")
    cosine = dot(F.col("a"), F.col("b")) / (norm(F.col("a")) * norm(F.col("b")))
    return joined.select("movie_id", "cluster_id", F.round(dist(F.col("a"), F.col("b")), 4).alias("distance"), F.round(cosine, 6).alias("cosine"))


def vec_literal_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    again = parse_literal(to_literal(F.col("v")), DIM)
    total = F.aggregate(again, F.lit(0.0), lambda s, x: s + x)
    return movie_vectors(spark, folder).select("id", F.size(again).alias("dims"), F.round(total, 4).alias("total"), (again == F.col("v")).alias("same"))


def slugify(spark: SparkSession, folder: str) -> DataFrame:
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "title", "updated_at", "vote_count", "popularity"))
    return movies.select("id", text_functions.slugify(F.col("title")).alias("slug"))


def text_length_trim(spark: SparkSession, folder: str) -> DataFrame:
    trimmed = text_functions.trim_all(F.col("text"))
    return table(spark, folder, "documents", "doc_id", "text").select("doc_id", text_functions.utf16_length(trimmed).alias("units"), F.length(trimmed).alias("points"))


def keyword_quality(spark: SparkSession, folder: str) -> DataFrame:
    words = keywords.occurrences(table(spark, folder, "movies", "keywords"), "keywords")
    bad = text_functions.matches_patterns(F.col("keyword"), keywords.FORMAT_PATTERNS + keywords.SENSITIVE_PATTERNS)
    return words.select("keyword", (~bad).alias("good"))


# ---- catalogue


def movies_latest(spark: SparkSession, folder: str) -> DataFrame:
    movies = catalog.movies_once(table(spark, folder, "movies"))
    return movies.select("id", "tmdb_id", "vote_count", "popularity")


def recent_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select("day", text_functions.months_back(F.col("day"), 6).alias("cutoff"))


def catalog_rank(spark: SparkSession, folder: str) -> DataFrame:
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "release_date", "popularity", "vote_count", "updated_at"))
    cutoff = text_functions.months_back(F.lit(AS_OF).cast("date"), 6)
    return catalog.recent_and_established(movies, cutoff)


def release_years(spark: SparkSession, folder: str) -> DataFrame:
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "release_date", "tagline", "budget", "updated_at", "vote_count", "popularity"))
    return movies.select(
        "id",
        text_functions.empty_to_null(F.col("release_date")).alias("release_date"),
        text_functions.year_of(F.col("release_date")).alias("release_year"),
        text_functions.empty_to_null(F.col("tagline")).alias("tagline"),
        "budget",
    )


def replies(spark: SparkSession, folder: str, newest: bool = True) -> DataFrame:
    """(movie_id, cast, crew) of the latest (or the first) reply of each movie; null where its shape is another."""
    when = F.col("fetched_at").desc_nulls_last() if newest else F.col("fetched_at").asc_nulls_last()
    known = table(spark, folder, "credits_raw", "fetch_id", "tmdb_id", "fetched_at", "payload").where(F.col("tmdb_id").isNotNull())
    raw = catalog.latest_per_key(known, "tmdb_id", when, F.col("fetch_id").desc() if newest else F.col("fetch_id").asc())
    return landed.parsed(raw, "payload", schemas.CREDITS).select(F.col("tmdb_id").alias("movie_id"), "reply.*")


def flat_credits(spark: SparkSession, folder: str) -> DataFrame:
    """The projection of nested replies: names of the first ten cast entries and of the directors, and their numbers."""
    names = F.transform(F.filter("cast", lambda x: x.isNotNull()), lambda x: x["name"])
    directors = F.transform(F.filter("crew", lambda x: x["job"] == "Director"), lambda x: x["name"])
    return replies(spark, folder).select(
        "movie_id",
        F.coalesce(F.array_join(F.slice(names, 1, 10), "|"), F.lit("")).alias("top_cast"),
        F.coalesce(F.array_join(directors, "|"), F.lit("")).alias("directors"),
        F.coalesce(F.size(names), F.lit(0)).alias("n_cast"),
    )


def new_catalog_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The movies of which no credits had been fetched by October 2024."""
    movies = table(spark, folder, "movies", "tmdb_id")
    fetched = table(spark, folder, "credits_raw", "tmdb_id", "fetched_at").where(F.col("fetched_at") < F.lit("2024-10-01").cast("timestamp_ntz"))
    return catalog.not_in(movies.where("tmdb_id is not null").distinct(), fetched, "tmdb_id")


def movies_by_votes(spark: SparkSession, folder: str) -> DataFrame:
    """The order in which a full refresh walks the movies: unknown votes first."""
    return catalog.by_votes(catalog.movies_once(table(spark, folder, "movies", "id", "vote_count", "updated_at", "popularity")))


def _details(spark: SparkSession, folder: str) -> DataFrame:
    """Detail replies as a service would send them, made of the movies and landed as JSON."""
    movies = catalog.movies_once(table(spark, folder, "movies")).where("tmdb_id is not null")
    named = lambda c: F.transform(c, lambda x: F.struct(x.alias("name")))
    cast = replies(spark, folder).select(F.col("movie_id").alias("tmdb_id"), "cast", "crew")
    person = lambda c, *f: F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: F.struct(*(x[n].alias(n) for n in f)))
    detail = movies.join(cast, "tmdb_id", "left").select(
        F.col("tmdb_id").alias("id"), "title", "original_title", "overview", "tagline", "release_date", "adult", "runtime", "budget", "revenue", "vote_average", "vote_count",
        "popularity", "original_language", F.when(F.col("runtime") > 90, F.concat(F.lit("/p"), "id")).alias("poster_path"), named("genres").alias("genres"),
        F.struct(named("keywords").alias("keywords")).alias("keywords"), F.struct(person("cast", "name").alias("cast"), person("crew", "name", "job").alias("crew")).alias("credits"),
    )
    path = f"{_scratch(spark)}/details"
    detail.write.json(path)
    return landed.json_replies(spark, path, schemas.MOVIE_DETAIL)


def flat_movie(spark: SparkSession, folder: str) -> DataFrame:
    """Nested detail replies, landed as JSON and read strictly, as flat rows."""
    flat = catalog.flat_movie(_details(spark, folder), "http://i/")
    lists = ("genres", "keywords", "top_cast", "directors", "production_companies")
    return flat.select(*(F.array_join(c, "|", "?").alias(c) if c in lists else F.col(c) for c in flat.columns if c not in ("imdb_id", "backdrop_path", "backdrop_url")))


def _discovery(spark: SparkSession, folder: str) -> str:
    """Discovery pages of twenty movies or fewer, landed by release year."""
    movies = table(spark, folder, "movies", "tmdb_id", "vote_count", "popularity", "release_date", "release_year").where("tmdb_id is not null")
    row = F.struct(F.col("tmdb_id").alias("id"), "vote_count", "popularity", "release_date")
    pages = movies.groupBy("release_year", F.pmod(F.xxhash64("tmdb_id"), F.lit(50)).alias("page")).agg(F.collect_list(row).alias("results"), F.lit(50).alias("total_pages"))
    path = f"{_scratch(spark)}/discover"
    pages.drop("page").write.partitionBy("release_year").json(path)
    return path


def discovered(spark: SparkSession, folder: str) -> DataFrame:
    """Landed pages of a range of years, of which no others are read, with enough votes."""
    rows = landed.discovered(spark, _discovery(spark, folder), least_votes=20, where=F.col("release_year").between(1990, 2010), partition="release_year int")
    return rows.select("id", "vote_count", F.round("popularity", 6).alias("popularity"), "release_date")


def discovered_recent(spark: SparkSession, folder: str) -> DataFrame:
    cutoff = text_functions.months_back(F.lit(AS_OF).cast("date"), 6)
    rows = landed.discovered(spark, _discovery(spark, folder), released_from=cutoff, least_popularity=20, partition="release_year int")
    return rows.select("id", "vote_count", F.round("popularity", 6).alias("popularity"), "release_date")


def companies_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Movies whose list is null or empty, patched with the names of landed replies; where a reply failed they stay as they are."""
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "tmdb_id", "keywords", "original_language", "runtime", "updated_at", "vote_count", "popularity"))
    todo = catalog.missing_values(movies.where("tmdb_id is not null"), "keywords").where("runtime is not null")
    reply = todo.select(F.col("tmdb_id").alias("id"), F.array(F.struct(F.concat(F.lit("studio "), F.coalesce("original_language", F.lit("?"))).alias("name"))).alias("production_companies"))
    path = f"{_scratch(spark)}/companies"
    reply.write.json(path)
    names = landed.json_replies(spark, path, schemas.COMPANIES).select(F.col("id").alias("tmdb_id"), F.transform("production_companies", lambda x: x["name"]).alias("keywords"))
    return credits.patch(movies.select("id", "tmdb_id", "keywords"), names, "tmdb_id").select("id", F.array_join("keywords", "|", "?").alias("names"))


def pulled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """An outside service asked in batches of 128, its replies landed as JSON out of order and keyed by place again."""
    words = keywords.occurrences(table(spark, folder, "movies", "keywords"), "keywords").select("keyword")
    asked = landed.pulled(words, "keyword", lambda xs: [[float(len(x)), float(x.count("a"))] for x in xs], "array<double>", concurrency=4)
    return asked.select("keyword", F.col("reply")[0].cast("int").alias("n_chars"), F.col("reply")[1].cast("int").alias("n_a"))


def embedding_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies of an embedding service, ten vectors each in descending order, landed as JSON and keyed by their place."""
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    entry = F.struct((-F.col("vec_id")).alias("k"), F.col("embedding").cast("array<double>").alias("embedding"), (F.col("vec_id") % 10).cast("int").alias("index"))
    reply = rows.groupBy(F.floor(F.col("vec_id") / 10).cast("bigint").alias("batch")).agg(F.array_sort(F.collect_list(entry)).alias("data"))  # ten a group
    path = f"{_scratch(spark)}/embeddings"
    reply.select("batch", F.transform("data", lambda x: F.struct(x["embedding"].alias("embedding"), x["index"].alias("index"))).alias("data")).write.json(path)
    read = landed.json_replies(spark, path, f"batch bigint, {schemas.EMBEDDINGS}")
    out = landed.embeddings_of(read.select("batch", F.struct("data").alias("reply")))
    return out.select((F.col("batch") * 10 + F.col("index")).alias("vec_id"), F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x), 6).alias("total"))


def unassigned_movies(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.not_in(movie_vectors(spark, folder).select("id"), table(spark, folder, "movie_cluster_assignments", "movie_id"), "id", "movie_id")


def movies_without_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.not_in(movie_vectors(spark, folder).select("id"), table(spark, folder, "movie_neighbors", "source_movie_id"), "id", "source_movie_id")


def movies_without_documents(spark: SparkSession, folder: str) -> DataFrame:
    movies = table(spark, folder, "movies", "tmdb_id").where("tmdb_id is not null").distinct()
    return catalog.not_in(movies, table(spark, folder, "documents", "tmdb_id"), "tmdb_id")


def keywords_todo(spark: SparkSession, folder: str) -> DataFrame:
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "keywords", "updated_at", "vote_count", "popularity"))
    return catalog.missing_values(movies, "keywords").select("id", F.col("keywords").isNull().alias("unknown"))


def catalog_page(spark: SparkSession, folder: str) -> DataFrame:
    """One page of a keyset walk: its limit is the feature."""
    return catalog.page(table(spark, folder, "movies", "id").distinct(), "id", "8", 500)


# ---- clusters


def _assigned(spark: SparkSession, folder: str, multiplier: float, normalized: bool = True) -> DataFrame:
    names, centroids = clustering.centroid_table(cluster_vectors(spark, folder), "id", F.col("v"), normalized)
    movies = movie_vectors(spark, folder).select("id", normalize(F.col("v")).alias("v"))
    out = clustering.assign_nearest(movies, "id", "v", names, centroids, 4, multiplier)
    return out.select(F.col("item_id").alias("movie_id"), "cluster_id", "rank", F.round("distance", 6).alias("distance"))


def assign_top4_m14(spark: SparkSession, folder: str) -> DataFrame:
    return _assigned(spark, folder, 1.4)


def assign_top4_m1005(spark: SparkSession, folder: str) -> DataFrame:
    return _assigned(spark, folder, 1.005)


def assign_top4_plain_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Against the movies' own mean vectors per cluster, which are not made length 1."""
    means = _member_means(spark, folder)
    names, centroids = clustering.centroid_table(means, "cluster_id", F.col("centroid"), False)
    movies = movie_vectors(spark, folder).select("id", normalize(F.col("v")).alias("v"))
    out = clustering.assign_nearest(movies, "id", "v", names, centroids, 4, 1.4)
    return out.select(F.col("item_id").alias("movie_id"), "cluster_id", "rank", F.round("distance", 6).alias("distance"))


def assign_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.clusters_per_item(_assigned(spark, folder, 1.6), "movie_id")


def nearest_cluster(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest label-mean centroid of every embedding."""
    items = _embedding_items(spark, folder)
    names, centroids = _label_means(spark, folder)
    out = clustering.assign_nearest(items, "id", "v", names, centroids, 1, None)
    return out.select(F.col("item_id").cast("bigint").alias("vec_id"), F.col("cluster_id").cast("int").alias("label"), F.round("distance", 6).alias("distance"))


def _embedding_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings", "vec_id", "embedding", "label").select(
        F.col("vec_id").alias("id"), normalize(F.col("embedding").cast("array<double>")).alias("v"), "label"
    )


def _label_means(spark: SparkSession, folder: str) -> tuple[list[str], np.ndarray]:
    means = clustering.mean_vectors(_embedding_items(spark, folder), "label", "v")
    return clustering.centroid_table(means, "label", F.col("centroid"), False)


def _members(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "movie_cluster_assignments", "movie_id", "cluster_id").distinct()
    movies = movie_vectors(spark, folder).select(F.col("id").alias("movie_id"), normalize(F.col("v")).alias("v"))
    return pairs.join(movies, "movie_id")


def _member_means(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.mean_vectors(_members(spark, folder).where("cluster_id is not null"), "cluster_id", "v")


def centroid_means(spark: SparkSession, folder: str) -> DataFrame:
    means = clustering.component_means(_members(spark, folder), "cluster_id", "v")
    return means.select("cluster_id", F.col("pos").cast("int").alias("pos"), F.round("mean", 6).alias("mean"), "n")


def cluster_popularity(spark: SparkSession, folder: str) -> DataFrame:
    votes = catalog.movies_once(table(spark, folder, "movies", "id", "vote_count", "updated_at", "popularity")).select(F.col("id").alias("movie_id"), "vote_count")
    out = clustering.popularity(table(spark, folder, "movie_cluster_assignments", "movie_id", "cluster_id").where("cluster_id is not null"), votes)
    return out.select("cluster_id", "film_count", F.round("avg_vote_count", 4).alias("avg_vote_count"))


def affected_group_recount(spark: SparkSession, folder: str) -> DataFrame:
    """The clusters that a late assignment touched, with the number of their members."""
    members = table(spark, folder, "movie_cluster_assignments", "movie_id", "cluster_id", "assigned_at")
    late = members.where(F.col("assigned_at") >= F.lit("2025-05-20").cast("timestamp_ntz"))
    return clustering.recount(members.select("movie_id", "cluster_id").distinct(), late, "cluster_id", "n_members")


def lloyd_step(spark: SparkSession, folder: str) -> DataFrame:
    return _lloyd(spark, folder, 1)


def lloyd_3_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return _lloyd(spark, folder, 3)


def _lloyd(spark: SparkSession, folder: str, rounds: int) -> DataFrame:
    """k-means over the embeddings from the vectors of the ten smallest ids."""
    items = _embedding_items(spark, folder)
    start = np.array([r.v for r in items.orderBy("id").limit(10).collect()])
    centroids, _ = clustering.lloyd(items, "v", start, rounds, -1.0)
    rows = [(k, i, round(float(x), 6)) for k, c in enumerate(centroids) for i, x in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, pos int, mean double")


def start_distances(spark: SparkSession, folder: str) -> DataFrame:
    """What a round of the weighted start draws by: each embedding's squared distance to the nearest of five centroids, and its share of the total."""
    items = _embedding_items(spark, folder)
    chosen = np.array([r.v for r in items.orderBy("id").limit(5).collect()])
    far = clustering.nearest_squares(items, "id", "v", chosen)
    total = far.agg(F.sum("d2")).first()[0]
    return far.select(F.col("id").cast("bigint").alias("vec_id"), F.round("d2", 6).alias("d2"), F.round(F.col("d2") / total * 1000, 6).alias("per_mille"))


def kmeans_mllib(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.kmeans_mllib(_embedding_items(spark, folder), "id", "v", 10)


def kmeans_own(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted start, rounds to convergence, and every movie's native cluster."""
    movies = session.stage(movie_vectors(spark, folder).select("id", normalize(F.col("v")).alias("v")), "units")
    start = clustering.weighted_start(movies, "id", "v", 200)
    centroids, _ = clustering.lloyd(movies, "v", start, 100, 1e-6)
    names = [f"{i:03d}" for i in range(len(centroids))]
    return clustering.assign_nearest(movies, "id", "v", names, centroids, 1, None)


def _cluster_run(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A full run from a fixed start: (clusters, assignments).  Centroids stay plain means; a cluster without native members has no row and takes no assignment."""
    movies = session.stage(movie_vectors(spark, folder, "title").select("id", "title", normalize(F.col("v")).alias("v")), "units")
    start = np.array([r.v for r in movies.orderBy("id").limit(20).collect()])  # the first by id, so that the result is always the same
    centroids, _ = clustering.lloyd(movies, "v", start, 3, -1.0)
    names = [f"{i:03d}" for i in range(len(centroids))]
    native = session.stage(clustering.assign_nearest(movies, "id", "v", names, centroids, 1, None).select(F.col("item_id").alias("id"), "cluster_id"), "native")
    sizes = native.groupBy("cluster_id").agg(F.count("*").alias("film_count"))
    used = {r.cluster_id for r in sizes.collect()}  # a row per cluster
    kept = [i for i, n in enumerate(names) if n in used]
    labels = keywords.label_of(native.join(movies.select("id", "title"), "id"), "cluster_id", "title", "Untitled Cluster")
    assigned = clustering.assign_nearest(movies, "id", "v", [names[i] for i in kept], centroids[kept], 4, 1.4)
    return sizes.join(labels, "cluster_id"), assigned.select(F.col("item_id").alias("movie_id"), "cluster_id", "rank", "distance")


def cluster_build(spark: SparkSession, folder: str) -> DataFrame:
    """The cluster table of a full run: label, native films, and films assigned as native or secondary."""
    clusters, assigned = _cluster_run(spark, folder)
    counts = assigned.groupBy("cluster_id").agg(F.count("*").alias("assigned"), F.round(F.avg("distance"), 6).alias("mean_distance"))
    return clusters.join(counts, "cluster_id", "left").select("cluster_id", "label", "film_count", "assigned", "mean_distance")


def cluster_build_assignments(spark: SparkSession, folder: str) -> DataFrame:
    _, assigned = _cluster_run(spark, folder)
    return assigned.select("movie_id", "cluster_id", "rank", F.round("distance", 6).alias("distance"))


def cluster_label_samples(spark: SparkSession, folder: str) -> DataFrame:
    members = table(spark, folder, "movie_cluster_assignments", "movie_id", "cluster_id").where("cluster_id is not null and movie_id is not null")
    return keywords.sample_per_group(members, "cluster_id", "movie_id", 25)


def cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    """A label for every cluster, from the titles of a few of its movies."""
    titles = catalog.movies_once(table(spark, folder, "movies", "id", "title", "updated_at", "vote_count", "popularity")).select(F.col("id").alias("movie_id"), "title")
    members = table(spark, folder, "movie_cluster_assignments", "movie_id", "cluster_id").where("cluster_id is not null").join(titles, "movie_id")
    return keywords.label_of(members, "cluster_id", "title", "Untitled Cluster")


# ---- keywords


def keyword_vocab(spark: SparkSession, folder: str) -> DataFrame:
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "keywords", "updated_at", "vote_count", "popularity"))
    return keywords.vocabulary(movies, "keywords")


def ungrouped_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabulary that is in no cluster's label."""
    grouped = table(spark, folder, "movie_theme_clusters", "label").select(F.explode(F.split(F.lower("label"), " ")).alias("keyword"))
    split = keywords.occurrences(table(spark, folder, "movies", "keywords"), "keywords").select(F.lower("keyword").alias("keyword")).distinct()
    return catalog.not_in(split, grouped, "keyword")


def group_slugs(spark: SparkSession, folder: str) -> DataFrame:
    groups = table(spark, folder, "movie_theme_clusters", "id", "label").where(F.trim(F.col("label")) != "")
    return keywords.unique_slugs(groups, "id", "label")


#: Groups that the vocabulary is cut into, and occurrences from which a keyword is in it.
GROUPS, VOCABULARY = 12, 15


def _keyword_vectors(spark: SparkSession, folder: str, least: int, below: int | None = None) -> DataFrame:
    """(keyword, v): a vector of length 1 for each keyword of so many occurrences, the mean of its movies' vectors.

    The place of an embedding service: any frame of (keyword, v) can stand in for it.
    """
    movies = movie_vectors(spark, folder, "keywords").select("id", normalize(F.col("v")).alias("v"), "keywords")
    words = keywords.vocabulary(movies, "keywords", least)
    if below is not None:
        words = words.where(F.col("n") < below)
    rows = movies.select(F.explode("keywords").alias("keyword"), "v").where("keyword is not null").join(words.select("keyword"), "keyword", "left_semi")
    means = clustering.mean_vectors(rows, "keyword", "v")
    return session.stage(means.select("keyword", normalize(F.col("centroid")).alias("v")), "keyword-vectors")


def _keyword_grouping(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str], np.ndarray]:
    """(groups: group_id, slug, label, keyword_count; members: keyword, group_id, distance; names and centroids of the groups)."""
    words = _keyword_vectors(spark, folder, VOCABULARY)
    start = np.array([r.v for r in words.orderBy("keyword").limit(GROUPS).collect()]).reshape(-1, DIM)  # the first by name, so that the result is always the same
    centroids = clustering.lloyd(words, "v", start, 3, -1.0)[0] if len(start) else start
    names = [f"{i:03d}" for i in range(len(centroids))]
    native = clustering.assign_nearest(words, "keyword", "v", names, centroids, 1, None)
    members = session.stage(native.select(F.col("item_id").alias("keyword"), F.col("cluster_id").alias("group_id"), "distance"), "keyword-members")
    labels = keywords.label_of(members, "group_id", "keyword")
    sizes = members.groupBy("group_id").agg(F.count("*").alias("keyword_count"))  # a group without members has no row
    return keywords.unique_slugs(labels, "group_id", "label").join(labels, "group_id").join(sizes, "group_id"), members, names, centroids


def keyword_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The keyword taxonomy of a full run: vocabulary, vectors, k-means, labelled groups with unique slugs."""
    groups, _, _, _ = _keyword_grouping(spark, folder)
    return groups.select("group_id", "slug", "label", "keyword_count")


def keyword_members(spark: SparkSession, folder: str) -> DataFrame:
    _, members, _, _ = _keyword_grouping(spark, folder)
    return members.select("keyword", "group_id", F.round("distance", 6).alias("distance"))


def keyword_nearest_group(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords too rare for the full run, each in the group whose normalised centroid is nearest, and that group's new number of keywords."""
    _, members, names, centroids = _keyword_grouping(spark, folder)
    found = members.select("group_id").distinct().collect()  # GROUPS at most
    kept = [i for i, n in enumerate(names) if n in {r.group_id for r in found}]
    unit = centroids[kept] / np.linalg.norm(centroids[kept], axis=1, keepdims=True)
    late = catalog.not_in(_keyword_vectors(spark, folder, 5, VOCABULARY), members, "keyword")
    near = clustering.assign_nearest(late, "keyword", "v", [names[i] for i in kept], unit, 1, None)
    new = session.stage(near.select(F.col("item_id").alias("keyword"), F.col("cluster_id").alias("group_id"), "distance"), "keyword-late")
    counts = clustering.recount(members.select("keyword", "group_id").unionByName(new.select("keyword", "group_id")), new, "group_id", "keyword_count")
    return new.join(counts, "group_id").select("keyword", "group_id", F.round("distance", 6).alias("distance"), "keyword_count")


# ---- credits


def person_credits(spark: SparkSession, folder: str) -> DataFrame:
    """Credits by the people table's own ids: the people of the first replies have theirs, those of the latest ones get new ones, and every credit is joined to them."""
    old = credits.people_last_wins(credits.billed(replies(spark, folder, newest=False))).select("tmdb_person_id", "name")
    stored = session.stage(sinks.with_new_ids(old, None, "tmdb_person_id", "person_id"), "people")
    rows = credits.billed(replies(spark, folder))
    people = sinks.with_new_ids(credits.people_last_wins(rows).select("tmdb_person_id", "name"), stored, "tmdb_person_id", "person_id")
    return credits.by_person(rows, people).select("movie_id", "person_id", "credit_type", "ordinal", "character", "billing_order", "job")


def credit_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = credits.billed(replies(spark, folder))
    return rows.select("movie_id", "tmdb_person_id", "credit_type", "ordinal", "character", "billing_order", "job", "department")


def people(spark: SparkSession, folder: str) -> DataFrame:
    return credits.people_last_wins(credits.billed(replies(spark, folder)))


def people_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The people of the movies' first replies, upserted with those of the latest ones."""
    old = credits.people_last_wins(credits.billed(replies(spark, folder, newest=False)))
    new = credits.people_last_wins(credits.billed(replies(spark, folder))).select("tmdb_person_id", "name", "popularity")
    return credits.upsert(old, new, "tmdb_person_id").select("tmdb_person_id", "name", "profile_path", "popularity")


def director_credits(spark: SparkSession, folder: str) -> DataFrame:
    lists = credits.director_lists(credits.billed(replies(spark, folder)))
    return lists.select("movie_id", F.array_join(F.transform("director_credits", lambda x: F.concat_ws(":", x["id"].cast("string"), x["name"])), "|").alias("director_credits"))


def director_patch(spark: SparkSession, folder: str) -> DataFrame:
    """The movies with their tagline replaced by the number of their directors, where a reply tells it."""
    movies = catalog.movies_once(table(spark, folder, "movies", "id", "tmdb_id", "tagline", "updated_at", "vote_count", "popularity")).select("tmdb_id", "id", "tagline")
    counts = credits.director_lists(credits.billed(replies(spark, folder))).select(F.col("movie_id").alias("tmdb_id"), F.size("director_credits").cast("string").alias("tagline"))
    return credits.patch(movies, counts, "tmdb_id")


# ---- nested records


def nested_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """How often each label stands at scalars, objects and arrays over all replies."""
    nodes = nested.shred(table(spark, folder, "credits_raw", "fetch_id", "payload"), "fetch_id", "payload")
    return nodes.groupBy("label", "kind").agg(F.count("*").alias("n"))


def nested_links(spark: SparkSession, folder: str) -> DataFrame:
    """How often each label stands below each parent's, from the links of the node table."""
    nodes = session.stage(nested.shred(table(spark, folder, "credits_raw", "fetch_id", "payload"), "fetch_id", "payload"), "nodes")
    return nested.links(nodes).groupBy("parent_label", "parent_kind", "label", "kind").agg(F.count("*").alias("n"), F.max("ordinal").alias("last_ordinal"))


def p2_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The credits with the links that p2_found leaves out: the entry's own values, read again through its node, for each row."""
    replies = table(spark, folder, "credits_raw", "fetch_id", "payload")
    nodes = session.stage(nested.shred(replies, "fetch_id", "payload", scalars=["id", "character", "job", "name"]), "nodes")
    rows = nested.credit_entities(nodes)
    names = nested.scalars_of(nodes, ["name"]).select("record", F.col("parent").alias("entry_node"), F.col("name.scalar").alias("entry_name"))
    above = nodes.select("record", F.col("node").alias("container_node"), F.col("label").alias("container"), F.col("kind").alias("container_kind"))
    linked = rows.join(names, ["record", "entry_node"], "left").join(above, ["record", "container_node"])
    return linked.select(F.col("record").alias("fetch_id"), "container", "container_kind", "pos", "role_pos", "tmdb_person_id", "entry_name")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    replies = table(spark, folder, "credits_raw", "fetch_id", "payload")
    nodes = session.stage(nested.shred(replies, "fetch_id", "payload", scalars=["id", "character", "job"]), "nodes")
    return nested.credit_entities(nodes).select(F.col("record").alias("fetch_id"), "credit_kind", "pos", "role_pos", "tmdb_person_id", "role_name")


# ---- rails


def _rail_movies(spark: SparkSession, folder: str) -> DataFrame:
    return session.stage(movie_vectors(spark, folder).select("id", normalize(F.col("v")).alias("vector"), "vote_count"), "rail-movies")


def rails(spark: SparkSession, folder: str) -> DataFrame:
    made = rail_operators.rails(_rail_movies(spark, folder))
    return made.select("source_id", "rail", "rank", "neighbour_id", F.round("score", 6).alias("score"))


def _rail(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        made = rail_operators.rails(_rail_movies(spark, folder), wanted=(name,))
        return made.select("source_id", "rank", "neighbour_id", F.round("score", 6).alias("score"))

    return run


def rails_for_new(spark: SparkSession, folder: str) -> DataFrame:
    """All rails of the movies that no neighbour row has yet."""
    made = rail_operators.rails(_rail_movies(spark, folder), sources=movies_without_neighbors(spark, folder))
    return made.select("source_id", "rail", "rank", "neighbour_id", F.round("score", 6).alias("score"))


def rails_for_affected(spark: SparkSession, folder: str) -> DataFrame:
    """The audited rails of the movies that lack rows in one of them, from a smaller net; written by rail over those of another run (which have no rank), and read again."""
    movies, path = _rail_movies(spark, folder), f"{_scratch(spark)}/neighbours"
    stale = table(spark, folder, "movie_neighbors", "source_movie_id", "recommendation_type", "neighbor_movie_id", "score").where(F.col("recommendation_type").isin(*AUDITED))
    sinks.write_rails(stale.withColumn("rank", F.lit(None).cast("int")), path)
    affected = rail_operators.incomplete(movies, table(spark, folder, "movie_neighbors", "source_movie_id", "recommendation_type"), AUDITED)
    made = rail_operators.rails(movies, rail_operators.RailParams(net_size=150), sources=affected, wanted=AUDITED)
    named = made.select(F.col("source_id").alias("source_movie_id"), F.col("rail").alias("recommendation_type"), F.col("neighbour_id").alias("neighbor_movie_id"), "score", "rank")
    sinks.write_rails(named, path)
    return spark.read.parquet(path).where("rank is not null").select("source_movie_id", "recommendation_type", "rank", "neighbor_movie_id", F.round("score", 6).alias("score"))


def rails_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    return rail_operators.incomplete(movie_vectors(spark, folder), table(spark, folder, "movie_neighbors", "source_movie_id", "recommendation_type"), AUDITED)


def rails_incomplete_observed(spark: SparkSession, folder: str) -> DataFrame:
    return rail_operators.incomplete(movie_vectors(spark, folder), table(spark, folder, "movie_neighbors", "source_movie_id", "recommendation_type"), AUDITED, observed=True)


# ---- sinks and streams


def _scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, on a cluster shared by all executors; removed when the driver's Python ends."""
    base = session.ensure_checkpoint_dir(spark).rstrip("/")
    return session.temporary(spark, f"{base}/kinograph-sink-{uuid.uuid4().hex}")


def run_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs: one that counts what it writes while it writes it, one that fails, and a dry one, which leaves no trace."""
    path = _scratch(spark)

    def job() -> tuple[int, int]:
        rows, count = sinks.counted(table(spark, folder, "movies", "id", "release_date"), F.col("release_date").try_cast("date").isNull())
        rows.write.parquet(f"{path}/out")
        return count()

    def broken() -> tuple[int, int]:
        raise RuntimeError("the source is gone")

    sinks.audited(spark, "count", f"{path}/runs", job)
    try:
        sinks.audited(spark, "broken", f"{path}/runs", broken)
    except RuntimeError:
        pass
    sinks.audited(spark, "dry", f"{path}/runs", lambda: (1, 0), dry_run=True)
    return spark.read.parquet(f"{path}/runs").select("run_type", "status", "rows_processed", "rows_failed", "error_message")


def sink_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters written, then merged with the counts of today: a versioned table read again."""
    path = f"{_scratch(spark)}/clusters"
    sinks.replace(table(spark, folder, "movie_theme_clusters", "id", "film_count"), path)
    counts = cluster_popularity(spark, folder).select(F.col("cluster_id").alias("id"), "film_count")
    sinks.merge(counts, path, "id")
    return sinks.read(spark, path)


def stream_assign(spark: SparkSession, folder: str) -> DataFrame:
    """The assignment of new movies as a stream over files, run twice: the second run finds nothing new."""
    path = _scratch(spark)
    source = f"{path}/in"
    movie_vectors(spark, folder).select("id", normalize(F.col("v")).alias("v")).write.parquet(source)
    names, centroids = clustering.centroid_table(cluster_vectors(spark, folder), "id", F.col("v"), True)
    work = lambda df: clustering.assign_nearest(df, "id", "v", names, centroids, 4, 1.4)
    for _ in range(2):
        incremental.process_new(spark, source, "id string, v array<double>", f"{path}/out", f"{path}/state", work, "id", "item_id").awaitTermination()
    out = spark.read.schema(f"{'item_id string, cluster_id string, rank int, distance double'}, batch int").parquet(f"{path}/out")
    return out.select(F.col("item_id").alias("movie_id"), "cluster_id", "rank", F.round("distance", 6).alias("distance"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = (
        vec_normalize, vec_pair_distance, vec_literal_roundtrip, slugify, text_length_trim, keyword_quality, movies_latest, recent_cutoff, catalog_rank,
        release_years, flat_credits, flat_movie, discovered, discovered_recent, companies_backfill, pulled_vectors, embedding_replies, movies_by_votes, new_catalog_ids, unassigned_movies, movies_without_neighbors, movies_without_documents, keywords_todo, catalog_page,
        assign_top4_m14, assign_top4_m1005, assign_top4_plain_centroids, assign_histogram, nearest_cluster, centroid_means, cluster_popularity,
        affected_group_recount, lloyd_step, lloyd_3_rounds, start_distances, kmeans_mllib, kmeans_own, cluster_build, cluster_build_assignments, cluster_label_samples, cluster_labels, keyword_vocab, ungrouped_keywords,
        group_slugs, keyword_groups, keyword_members, keyword_nearest_group, person_credits, credit_rows, people, people_upsert, director_credits, director_patch, nested_nodes, nested_links, p2_entries, p2_found, rails, rails_for_new, rails_for_affected,
        rails_incomplete, rails_incomplete_observed, run_audit, sink_merge, stream_assign,
    )
    return {f.__name__: f for f in plain} | {f"rail_{name}": _rail(name) for name in rail_operators.RAILS}
