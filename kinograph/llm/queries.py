"""The pN_ queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinograph import session
from kinograph.functions.terms import term_set
from kinograph.llm import birch, contamination, cooccur, knn, packing, quality, setjoin, termfreq, topn
from kinograph.llm.records import one_per_record
from kinograph.llm.vectors import double_units, unit_vectors
from kinograph.tables import table


# White space and number lists in DuckDB's patterns, written out apart from the library's own.
SPACE = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NUMBER = r"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?"
LITERAL = rf"{SPACE}*\[\s*{NUMBER}(\s*,\s*{NUMBER}){{63}}\s*\]{SPACE}*"


def _term(element: str) -> str:
    """A term in SQL: lower case, runs of white space one space, trimmed."""
    return f"lower(trim(regexp_replace({element}, '{SPACE}+', ' ', 'g')))"


#: Rows of capacities that the driver holds; more are an error.
MOST_PROFILES = 1000


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    rails = topn.top_n_per_group(
        table(spark, folder, "movie_neighbors", "source_movie_id", "recommendation_type", "neighbor_movie_id", "score"),
        ["source_movie_id", "recommendation_type"], "neighbor_movie_id", "score",
    )
    clusters = topn.top_n_per_group(
        table(spark, folder, "movie_cluster_assignments", "cluster_id", "movie_id", "distance"),
        ["cluster_id"], "movie_id", "distance", descending=False,
    )
    return rails.select(
        F.col("source_movie_id").alias("group_id"), F.col("recommendation_type").alias("group_kind"), F.col("neighbor_movie_id").alias("item_id"), "rnk"
    ).unionByName(clusters.select(F.col("cluster_id").alias("group_id"), F.lit("cluster").alias("group_kind"), F.col("movie_id").alias("item_id"), "rnk"))


P1_SQL = """
with rail as (
  select source_movie_id g, recommendation_type k, neighbor_movie_id i, max(score) v
  from movie_neighbors
  where score is not null and not isnan(score) and neighbor_movie_id is not null
  group by all),
cluster as (
  select cluster_id g, movie_id i, min(distance) v
  from movie_cluster_assignments
  where distance is not null and not isnan(distance) and movie_id is not null
  group by all),
ranked as (
  select g group_id, k group_kind, i item_id, row_number() over (partition by g, k order by v desc, i) rnk from rail
  union all
  select g, 'cluster', i, row_number() over (partition by g order by v, i) from cluster)
select group_id, group_kind, item_id, cast(rnk as int) rnk from ranked where rnk <= 10
"""


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _movie_units(spark, folder)
    found = birch.fit(vectors, 64)
    return birch.references_in_blocks(
        vectors, 64, found, double_units(table(spark, folder, "movie_theme_clusters", "id", "centroid"), "id", "centroid", 64), 0.9
    ).select(F.col("record").alias("movie_id"), F.col("reference").alias("cluster_id"))


def p3_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """The movies' own clusters: size, mean cosine and five most typical movies of each."""
    vectors = _movie_units(spark, folder)
    assigned, _ = birch.similarity_clusters(vectors, 64)
    return birch.describe(session.stage(assigned.select("record", "cluster", "cosine"), "assigned"))


def p3_whole(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of any division of the movies: each usable one in one cluster, sizes that add up, and the members nearest the centroid as the typical ones."""
    vectors = _movie_units(spark, folder)
    assigned, _ = birch.similarity_clusters(vectors, 64)
    assigned = session.stage(assigned.select("record", "cluster", "cosine"), "assigned")
    described = birch.describe(assigned)
    sizes = described.select("cluster", "size").distinct().agg(F.sum("size").alias("total_size"))
    # the least cosine of the typical members against all others of their cluster
    typical = described.select("cluster", "record", F.lit(True).alias("typical"))
    edge = described.groupBy("cluster").agg(F.min("cosine").alias("edge"), F.max("rnk").alias("n_typical"), F.max("size").alias("n"))
    nearer = assigned.join(typical, ["cluster", "record"], "left_anti").join(edge, "cluster").where(F.col("cosine") > F.col("edge")).agg(F.count("*").alias("nearer_left_out"))
    short = edge.where(F.col("n_typical") != F.least(F.lit(5), F.col("n"))).agg(F.count("*").alias("clusters_with_too_few"))
    rows = assigned.agg(F.count("*").alias("n_rows"), F.countDistinct("record").alias("n_movies"))
    return rows.join(sizes).join(nearer).join(short)  # one row each


P3_WHOLE_SQL = "n as (select count(*) n from m) select n n_rows, n n_movies, n total_size, 0 nearer_left_out, 0 clusters_with_too_few from n"


def p3_themes_met(spark: SparkSession, folder: str) -> DataFrame:
    """The themes with five movies or more within cosine 0.9, and how many of them have an own cluster's centroid as near: what the clusters themselves find, without the themes."""
    vectors = _movie_units(spark, folder)
    found = birch.fit(vectors, 64)
    themes = double_units(table(spark, folder, "movie_theme_clusters", "id", "centroid"), "id", "centroid", 64)
    members = birch.references_in_blocks(vectors, 64, found, themes, 0.9)
    large = members.groupBy("reference").agg(F.count("*").alias("n")).where("n >= 5").select("reference")
    centroids = found.table.select(F.col("cluster").cast("string").alias("record"), birch.as_float32(found.table))
    met = birch.references_in_blocks(centroids, 64, found, themes, 0.9).select("reference").distinct().withColumn("met", F.lit(1))
    return large.join(met, "reference", "left").agg(F.count("*").alias("n_themes"), F.count("met").alias("n_met"))


P3_MET_SQL = "g as (select c.id from m, c where list_inner_product(m.v, c.v) >= 0.9 group by 1 having count(*) >= 5) select count(*) n_themes, count(*) n_met from g"


def _movie_units(spark: SparkSession, folder: str) -> DataFrame:
    return session.stage(unit_vectors(table(spark, folder, "movies", "id", "essence_vector"), "id", "essence_vector", 64), "vectors")


def _units_sql(name: str, source: str, column: str) -> str:
    """A CTE (id, v) of usable vectors of length 1, one per id."""
    return f"""{name} as (
  select id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) v from (
    select id, max(v) v from (
      select id, case when regexp_full_match({column}, '{LITERAL}') then cast(regexp_replace({column}, '{SPACE}+', '', 'g') as double[]) end v from {source} where id is not null)
    where v is not null and len(list_filter(v, lambda x: x <> 0)) > 0 group by id))"""


P3_SQL = f"""
with {_units_sql("m", "movies", "essence_vector")}, {_units_sql("c", "movie_theme_clusters", "centroid")}
select m.id movie_id, c.id cluster_id from m, c where list_inner_product(m.v, c.v) >= 0.9
"""


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = cooccur.cooccurrence(table(spark, folder, "movies", "id", "keywords"), "id", "keywords", min_together=5)
    return cooccur.above_chance(pairs, 4).select("term_a", "term_b")


P4_SQL = f"""
with mt as (
  select distinct id, {_term("k")} t from (select id, unnest(keywords) k from movies where id is not null) where k is not null),
m as (select t, count(*) c from mt where t <> '' group by t),
ab as (
  select a.t term_a, b.t term_b, count(*) n_ab from mt a join mt b on a.id = b.id and a.t < b.t
  where a.t <> '' and b.t <> '' group by all having count(*) >= 5)
select term_a, term_b from ab join m x on x.t = term_a join m y on y.t = term_b
where n_ab * (select count(distinct id) from movies) >= 4 * x.c * y.c
"""


def _keyword_sets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    movies = one_per_record(table(spark, folder, "movies", "id", "keywords", "genres"), "id", "keywords", "genres")
    tagged = lambda array, mark: F.transform(term_set(F.col(array)), lambda x: F.concat(F.lit(mark), x))
    sets = (
        movies.select("record", tagged("keywords", "k ").alias("k"), tagged("genres", "g ").alias("g"))
        .where(F.size("k") >= 5)
        .select("record", F.concat("k", "g").alias("values"))
    )
    return setjoin.similar_sets(sets, "record", "values", "0.7")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs, members = _keyword_sets(spark, folder)
    return setjoin.member_pairs(pairs, members).select(F.col("record_a").alias("movie_id_a"), F.col("record_b").alias("movie_id_b"))


P5_SQL = f"""
with mt as (
  select distinct id, kind, {_term("x")} t from (
    select id, 'k' kind, unnest(keywords) x from movies where id is not null
    union all select id, 'g', unnest(genres) from movies where id is not null) where x is not null),
t as (select * from mt where t <> ''),
s as (select id, count(*) n from t group by id having count(*) filter (kind = 'k') >= 5),
u as (select t.* from t join s using (id))
select a.id movie_id_a, b.id movie_id_b
from u a join u b on a.kind = b.kind and a.t = b.t and a.id < b.id
join s x on x.id = a.id join s y on y.id = b.id
group by a.id, b.id, x.n, y.n
having 10 * count(*) >= 7 * (x.n + y.n - count(*))
"""


def p5_classes(spark: SparkSession, folder: str) -> DataFrame:
    """A row per movie with enough keywords: how many other movies have the same set, and how many other sets are similar; copies are not expanded into pairs."""
    pairs, members = _keyword_sets(spark, folder)
    both = pairs.select(F.col("cls_a").alias("cls")).unionByName(pairs.select(F.col("cls_b").alias("cls")))
    links = both.groupBy("cls").agg(F.count("*").alias("links"))
    sizes = members.groupBy("cls").agg((F.count("*") - 1).alias("copies")).join(links, "cls", "left")
    return members.join(sizes, "cls").select(F.col("record").alias("movie_id"), "copies", F.coalesce("links", F.lit(0)).cast("bigint").alias("similar_sets"))


P5_CLASSES_SQL = f"""
with mt as (
  select distinct id, kind, {_term("x")} t from (
    select id, 'k' kind, unnest(keywords) x from movies where id is not null
    union all select id, 'g', unnest(genres) from movies where id is not null) where x is not null),
t as (select * from mt where t <> ''),
s as (select id, list(kind || t order by kind, t) v, count(*) n from t group by id having count(*) filter (kind = 'k') >= 5),
c as (select v, min(id) c, count(*) - 1 copies, any_value(n) n from s group by v),
u as (select t.*, c.n from c join t on t.id = c.c),
p as (select a.id a, b.id b from u a join u b on a.kind = b.kind and a.t = b.t and a.id < b.id group by a.id, b.id, a.n, b.n having 10 * count(*) >= 7 * (a.n + b.n - count(*))),
l as (select id, count(*) k from (select a id from p union all select b from p) group by 1)
select s.id movie_id, copies, coalesce(k, 0) similar_sets from s join c using (v) left join l on l.id = c.c
"""


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return termfreq.marked(table(spark, folder, "movies", "id", "keywords"), "id", "keywords").where("mark is not null").select("term", "mark")


P6_SQL = f"""
with mt as (
  select distinct id, {_term("k")} t from (select id, unnest(keywords) k from movies where id is not null) where k is not null),
m as (select t term, count(*) c from mt where t <> '' group by t),
n as (select count(distinct id) n from movies)
select term, case when 20 * c > n then 'common' else 'rare' end mark from m, n where 20 * c > n or c < 15
"""


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _movie_units(spark, folder)
    near = knn.nearest(vectors, 64, k=10, least=0.985)
    return near.select(F.least("query", "neighbour").alias("movie_id_a"), F.greatest("query", "neighbour").alias("movie_id_b")).distinct()


P7_SQL = f"""
with {_units_sql("m", "movies", "essence_vector")},
p as (select a.id q, b.id n, list_inner_product(a.v, b.v) s from m a, m b where a.id <> b.id),
k as (select *, row_number() over (partition by q order by s desc, n) r from p)
select distinct least(q, n) movie_id_a, greatest(q, n) movie_id_b from k where r <= 10 and s >= 0.985
"""


def p7_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate search against an exact one: the movies whose tmdb_id is divisible by 100, against all movies.

    Parts of 25 movies, so that there are very many even in a small table, and a
    small fan-out, so that there are parts of parts; the exact search has one part.
    """
    vectors = _movie_units(spark, folder)
    asked = table(spark, folder, "movies", "id", "tmdb_id").where("tmdb_id % 100 = 0").select(F.col("id").alias("record")).distinct()
    asked = session.stage(vectors.join(asked, "record", "left_semi"), "queries")
    pairs = lambda df: df.select("query", "neighbour")
    near = session.stage(pairs(knn.nearest(vectors, 64, k=10, queries=asked, part_rows=25, fan_out=64)), "near")
    exact = session.stage(pairs(knn.nearest(vectors, 64, k=10, queries=asked, part_rows=1 << 40)), "exact")
    counts = exact.agg(F.countDistinct("query").alias("n_queries"), F.count("*").alias("n_exact")).join(exact.join(near, ["query", "neighbour"]).agg(F.count("*").alias("met")))
    return counts.join(near.agg(F.count("*").alias("n_near"))).select("n_queries", "n_exact", "n_near", (F.col("met") >= 0.9 * F.col("n_exact")).alias("recall_is_09"))


P7_RECALL_SQL = "n as (select count(*) n from m where id in (select id from movies where tmdb_id % 100 = 0)) select n n_queries, 10 * n n_exact, 10 * n n_near, true recall_is_09 from n"


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    profiles = table(spark, folder, "pack_capacities", "profile", "max_tokens").where("profile is not null and max_tokens > 0").orderBy("profile").limit(MOST_PROFILES + 1).collect()
    if len(profiles) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} capacity profiles")
    return packing.pack(table(spark, folder, "documents", "doc_id", "text"), [(r.profile, r.max_tokens) for r in profiles])


def p8_sound(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of any packing, for each capacity: no container overfull, every text in it once and whole, none split without need, little space left."""
    packed = session.stage(p8_containers(spark, folder), "packed")
    caps = table(spark, folder, "pack_capacities", "profile", "max_tokens")
    length = F.col("token_to") - F.col("token_from")
    loads = packed.groupBy("profile", "container").agg(F.sum(length).alias("load")).join(caps, "profile")
    by_profile = loads.groupBy("profile", "max_tokens").agg(F.count("*").alias("containers"), F.count_if(F.col("load") > F.col("max_tokens")).alias("overfull"), F.sum("load").alias("tokens"))
    texts = packed.groupBy("profile", "doc_id").agg(
        F.count("*").alias("pieces"), F.countDistinct("piece").alias("places"), F.max("piece").alias("last"), F.min("token_from").alias("first"), F.max("token_to").alias("size"), F.sum(length).alias("sum")
    )
    whole = (F.col("first") == 0) & (F.col("size") == F.col("sum")) & (F.col("places") == F.col("pieces")) & (F.col("last") == F.col("pieces") - 1)
    least = F.greatest(F.lit(1), F.ceil(F.col("size") / F.col("max_tokens")))
    of_texts = texts.join(caps, "profile").groupBy("profile").agg(F.count("*").alias("n_texts"), F.count_if(~whole).alias("broken"), F.count_if(F.col("pieces") > least).alias("split_too_often"))
    shards = F.ceil(F.lit(table(spark, folder, "documents").count()) / 20_000)
    tight = (F.col("containers") <= F.ceil(F.col("tokens") / F.col("max_tokens")) * 1.05 + 3 * shards).alias("tight")
    return by_profile.join(of_texts, "profile").select("profile", "n_texts", "overfull", "broken", "split_too_often", tight)


P8_SQL = """
select profile, n n_texts, 0 overfull, 0 broken, 0 split_too_often, true tight
from pack_capacities, (select count(distinct doc_id) n from documents where doc_id is not null and text is not null)
where profile is not null and max_tokens > 0
"""


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_spans(spark, folder).select("doc_id", "item_id").distinct()


def p9_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Where the leaked passages lie."""
    return contamination.leaked_spans(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "eval_items", "item_id", "text"))


P9_SQL = r"""
with w as (
  select 'd' kind, doc_id id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from documents where text is not null
  union all select 'i', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from eval_items where text is not null),
g as (select kind, id, array_to_string(w[i:i + 11], ' ') g from (select kind, id, w, unnest(range(1, len(w) - 10)) i from w))
select distinct d.id doc_id, i.id item_id from g d join g i using (g) where d.kind = 'd' and i.kind = 'i'
"""


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_statistics(spark, folder).where(F.col("form").isin("list", "table", "junk")).select("doc_id", "form")


def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text statistics and shares of prose, list, table and junk."""
    documents = table(spark, folder, "documents", "doc_id", "text", "lang")
    model = quality.fit_model(documents, table(spark, folder, "doc_labels", "doc_id", "form"))
    return quality.document_quality(documents, model)


def p10_plain(spark: SparkSession, folder: str) -> DataFrame:
    """The plain statistics of every document."""
    shown = [F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "punctuated_lines")]
    return p10_statistics(spark, folder).select("doc_id", "n_words", *shown)


P10_PLAIN_SQL = r"""
with l as (
  select doc_id, unnest(list_filter(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'), lambda x: regexp_matches(x, SOLID))) x
  from documents where text is not null),
b as (select doc_id, x, regexp_replace(x, '<[^<>]*>', ' ', 'g') y from l),
w as (
  select doc_id, len(regexp_extract_all(y, WORD)) n, len(list_aggregate(regexp_extract_all(y, WORD), 'string_agg', '')) letters,
    length(regexp_replace(x, SPACE, '', 'g')) solid, cast(regexp_matches(y, '[.!?\x{2026}]["\x{27}\x{201d}\x{2019}\x{bb})\]]*' || SPACE || '*$|["\x{201d}\x{bb}]' || SPACE || '*$') as int) ends
  from b),
s as (select doc_id, sum(n) n, coalesce(sum(letters), 0) letters, sum(solid) solid, avg(ends) ends from w group by doc_id)
select d.doc_id, cast(coalesce(n, 0) as bigint) n_words, round(case when n > 0 then letters / n end, 6) mean_word_length, round((solid - letters) / solid, 6) symbol_ratio, round(ends, 6) punctuated_lines
from documents d left join s using (doc_id)
""".replace("WORD", r"'[\p{L}\p{N}]+(?:[\x{27}\x{2019}][\p{L}\p{N}]+)*'").replace("SPACE", r"'[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]'").replace(
    "SOLID", r"'[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]'"
)


def p10_held_out(spark: SparkSession, folder: str) -> DataFrame:
    """The model fitted on the labelled documents of even doc_id, against the labels of the others: how many there are, and whether at least two thirds are met (with the dozen labels of a small table; README has the figures of larger ones)."""
    documents = table(spark, folder, "documents", "doc_id", "text", "lang")
    labels = table(spark, folder, "doc_labels", "doc_id", "form")
    model = quality.fit_model(documents, labels.where("doc_id % 2 = 0"))
    held = quality.labelled(documents, labels.where("doc_id % 2 = 1"), 1 << 30).select(F.col("doc").alias("doc_id"), F.col("form").alias("label"), "text")
    scored = quality.document_quality(held, model).join(held.select("doc_id", "label"), "doc_id")
    return scored.agg(F.count("*").alias("n_documents"), (F.count_if(F.col("form") == F.col("label")) >= 2 / 3 * F.count("*")).alias("met"))


P10_HELD_SQL = """
select count(distinct doc_id) n_documents, true met from doc_labels join documents using (doc_id)
where form in ('prose', 'list', 'table', 'junk') and doc_id % 2 = 1 and text is not null
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = (
        p1_found, p3_found, p3_clusters, p3_whole, p3_themes_met, p4_found, p5_found, p5_classes, p6_found, p7_found, p7_recall, p8_containers, p8_sound, p9_found, p9_spans,
        p10_found, p10_statistics, p10_plain, p10_held_out,
    )
    return {f.__name__: f for f in plain}


def oracle_sql() -> dict[str, str]:
    units = f"with {_units_sql('m', 'movies', 'essence_vector')}"
    return {
        "p1_found": P1_SQL,
        "p3_found": P3_SQL,
        "p3_whole": f"{units}, {P3_WHOLE_SQL}",
        "p3_themes_met": f"{units}, {_units_sql('c', 'movie_theme_clusters', 'centroid')}, {P3_MET_SQL}",
        "p4_found": P4_SQL,
        "p5_found": P5_SQL,
        "p5_classes": P5_CLASSES_SQL,
        "p6_found": P6_SQL,
        "p7_found": P7_SQL,
        "p7_recall": f"{units}, {P7_RECALL_SQL}",
        "p8_sound": P8_SQL,
        "p9_found": P9_SQL,
        "p10_plain": P10_PLAIN_SQL,
        "p10_held_out": P10_HELD_SQL,
    }
