"""DuckDB SQL of the core queries: the same results, said independently."""

from __future__ import annotations

from kinograph.operators.keywords import FORMAT_PATTERNS, SENSITIVE_PATTERNS
from kinograph.operators.rails import RAILS, RailParams
from kinograph.plans.queries import AS_OF, AUDITED, DIM, GROUPS, VOCABULARY

# Written out here once more, so that a slip in the library's own patterns shows.
SPACE = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BLANK = r"[\t\n\x0b\x0c\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
NUMBER = r"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?"
LITERAL = rf"{SPACE}*\[\s*{NUMBER}(\s*,\s*{NUMBER}){{{DIM - 1}}}\s*\]{SPACE}*"

_MOV = """mov as (
  select * from (select *, row_number() over (partition by id order by updated_at desc nulls last, vote_count desc nulls last, popularity desc nulls last) r
                 from movies where id is not null) where r = 1)"""


def _vectors(name: str, source: str, column: str, more: str = "") -> str:
    return f"""{name} as (
  select * from (select id, case when regexp_full_match({column}, '{LITERAL}') then cast(regexp_replace({column}, '{SPACE}+', '', 'g') as double[]) end v{more} from {source})
  where v is not null and len(list_filter(v, lambda x: x <> 0)) > 0)"""


_MV = _MOV + ", " + _vectors("mv", "mov", "essence_vector", ", vote_count")
_CV = _vectors("cv", "movie_theme_clusters", "centroid")
_NORM = "sqrt(list_sum(list_transform({0}, lambda x: x * x)))"


def _unit(v: str) -> str:
    n = _NORM.format(v)
    return f"case when {n} = 0 then {v} else list_transform({v}, lambda x: x / {n}) end"


_UNITS = f"{_MV}, mu as (select id, vote_count, {_unit('v')} v from mv)"
_CUNITS = f"{_CV}, cu as (select id, {_unit('v')} v from cv)"


def _top4(centroids: str, multiplier: float | None, most: int = 4) -> str:
    bound = "" if multiplier is None else f" where k = 1 or d <= d1 * {multiplier}"
    return f"""near as (
  select m.id movie_id, c.id cluster_id, list_distance(m.v, c.v) d from mu m, {centroids} c),
top as (select * from (select *, row_number() over (partition by movie_id order by d, cluster_id) k from near) where k <= {most}),
picked as (select * from (select *, min(d) over (partition by movie_id) d1 from top){bound})"""


_ASSIGNED = "select movie_id, cluster_id, cast(k as int) \"rank\", round(d, 6) distance from picked"
_MEMBERS = "members as (select distinct a.movie_id, a.cluster_id, m.v from movie_cluster_assignments a join mu m on m.id = a.movie_id)"
_MEANS = f"""{_MEMBERS},
means as (select cluster_id, pos, avg(x) mean, count(*) n from (select cluster_id, unnest(v) x, generate_subscripts(v, 1) - 1 pos from members) group by all),
packed as (select cluster_id id, list(mean order by pos) v from means where cluster_id is not null group by all)"""

_EMB = f"emb as (select vec_id id, label, {_unit('v')} v from (select vec_id, label, cast(embedding as double[]) v from embeddings))"


def _rounds(source: str, start: str, rounds: int) -> str:
    """CTEs c0 ... of k-means over ``source`` (id, v) from the vectors that ``start`` selects in the order of their ids."""
    parts = [f"c0 as (select row_number() over (order by id) - 1 cluster, v from ({start}))"]
    for r in range(1, rounds + 1):
        parts.append(
            f"""a{r} as (select id, v, cluster from (
  select e.id, e.v, c.cluster, row_number() over (partition by e.id order by list_distance(e.v, c.v), c.cluster) k from {source} e, c{r - 1} c) where k = 1),
m{r} as (select cluster, pos, avg(x) x from (select cluster, unnest(v) x, generate_subscripts(v, 1) pos from a{r}) group by all),
n{r} as (select cluster, list(x order by pos) v from m{r} group by cluster),
c{r} as (select c.cluster, coalesce(n.v, c.v) v from c{r - 1} c left join n{r} n using (cluster))"""
        )
    return ",\n".join(parts)


def _lloyd(rounds: int) -> str:
    return (
        f"with {_EMB}, {_rounds('emb', 'select * from emb order by id limit 10', rounds)}"
        f" select cast(cluster as int) cluster, cast(pos - 1 as int) pos, round(x, 6) mean from (select cluster, unnest(v) x, generate_subscripts(v, 1) pos from c{rounds})"
    )


def _labels(members: str, item: str, fallback: str) -> str:
    """CTEs lm, labels (cluster, label) over ``members`` (cluster, item)."""
    return f"""lm as (select * from (select *, row_number() over (partition by cluster order by md5({item}), {item}) k from (select distinct cluster, {item} from {members} where trim({item}) <> '')) where k <= 3),
labels as (select cluster, coalesce(string_agg({item}, ', ' order by k), '{fallback}') "label" from (select distinct cluster from {members}) left join lm using (cluster) group by 1)"""


# the cluster table of a full run
_RUN = f"""{_MOV}, {_vectors("mv", "mov", "essence_vector", ", title")}, mu as (select id, title, {_unit("v")} v from mv),
{_rounds("mu", "select * from mu order by id limit 20", 3)},
nat as (select id, cluster from (select e.id, c.cluster, row_number() over (partition by e.id order by list_distance(e.v, c.v), c.cluster) k from mu e, c3 c) where k = 1),
sizes as (select cluster, count(*) film_count from nat group by 1),
titles as (select n.cluster, mu.title from nat n join mu using (id)),
{_labels("titles", "title", "Untitled Cluster")},
near as (select m.id movie_id, c.cluster, list_distance(m.v, c.v) d from mu m, c3 c where c.cluster in (select cluster from sizes)),
top as (select * from (select *, row_number() over (partition by movie_id order by d, cluster) k from near) where k <= 4),
picked as (select * from (select *, min(d) over (partition by movie_id) d1 from top) where k = 1 or d <= d1 * 1.4)"""

_NAME3 = "lpad(cast({0} as varchar), 3, '0')"


# the keyword taxonomy
def _keyword_run() -> str:
    mean = "select keyword id, list(x order by pos) v from (select keyword, pos, avg(x) x from (select k.keyword, unnest(k.v) x, generate_subscripts(k.v, 1) pos from kv k join {0} using (keyword)) group by all) group by 1"
    unit = lambda t: f"select id, {_unit('v')} v from ({mean.format(t)})"
    return f"""{_MOV}, {_vectors("mv", "mov", "essence_vector", ", keywords")}, kv as (select unnest(keywords) keyword, {_unit("v")} v from mv),
counts as (select keyword, count(*) n from kv where keyword is not null group by 1), voc as (select keyword from counts where n >= {VOCABULARY} and not {_BAD}),
words as ({unit("voc")}),
{_rounds("words", f"select * from words order by id limit {GROUPS}", 3)},
nat as (select id keyword, cluster, d from (select e.id, c.cluster, list_distance(e.v, c.v) d, row_number() over (partition by e.id order by list_distance(e.v, c.v), c.cluster) k from words e, c3 c) where k = 1),
{_labels("nat", "keyword", "Untitled Group")},
rare as (select keyword from counts where n >= 5 and n < {VOCABULARY} and not {_BAD}),
late as ({unit("rare")}),
cu as (select cluster, {_unit("v")} v from c3 where cluster in (select cluster from nat)),
new as (select id keyword, cluster, d from (select e.id, c.cluster, list_distance(e.v, c.v) d, row_number() over (partition by e.id order by list_distance(e.v, c.v), c.cluster) k from late e, cu c
  where e.id not in (select keyword from nat)) where k = 1)"""


_PATTERNS = "[" + ", ".join(f"'{p}'" for p in FORMAT_PATTERNS + SENSITIVE_PATTERNS) + "]"
# A phrase anywhere; one word where no letter, digit or underscore is before it, which a padded text and its places tell without a pattern.
_BAD = f"""(len(list_filter({_PATTERNS}, lambda p: contains(p, ' ') and contains(lower(keyword), p))) > 0
 or len(list_filter({_PATTERNS}, lambda p: not contains(p, ' ') and len(list_filter(range(1, cast(length(keyword) - length(p) + 2 as bigint)),
   lambda i: substr(lower(keyword), i, length(p)) = p and (i = 1 or not regexp_full_match(substr(lower(keyword), i - 1, 1), '[A-Za-z0-9_]')))) > 0)) > 0)"""

_CREDITS = (
    '{"cast":[{"id":"VARCHAR","name":"VARCHAR","profile_path":"VARCHAR","known_for_department":"VARCHAR","popularity":"DOUBLE","character":"VARCHAR","order":"INTEGER"}],'
    '"crew":[{"id":"VARCHAR","name":"VARCHAR","profile_path":"VARCHAR","known_for_department":"VARCHAR","popularity":"DOUBLE","job":"VARCHAR","department":"VARCHAR"}]}'
)


def _replies(name: str = "replies", newest: bool = True) -> str:
    order = "fetched_at desc nulls last, fetch_id desc" if newest else "fetched_at asc nulls last, fetch_id asc"
    return f"""{name} as (
  select tmdb_id movie_id, r.cast_ cast_, r.crew crew from (
    select tmdb_id, {{'cast_': j."cast", 'crew': j.crew}} r from (
      select tmdb_id, case when json_valid(payload) and json_type(payload) = 'OBJECT' then json_transform(payload, '{_CREDITS}') end j from (
        select *, row_number() over (partition by tmdb_id order by {order}) k from credits_raw where tmdb_id is not null) where k = 1)))"""


def _billed(name: str = "billed", replies: str = "replies") -> str:
    return f"""{name} as (
  select movie_id, 0 so, o - 1 ordinal, try_cast(p.id as bigint) pid, p.name, p.profile_path, p.known_for_department dep, p.popularity, 'cast' credit_type,
    nullif(p.character, '') "character", p."order" billing_order, null job, null department
  from (select movie_id, unnest(cast_[1:20]) p, generate_subscripts(cast_[1:20], 1) o from {replies})
  where try_cast(p.id as bigint) is not null
  union all
  select movie_id, 1, o - 1, try_cast(p.id as bigint), p.name, p.profile_path, p.known_for_department, p.popularity, 'crew', null, null, p.job, p.department
  from (select movie_id, unnest(d) p, generate_subscripts(d, 1) o from (select movie_id, list_filter(crew, lambda x: x.job = 'Director') d from {replies}))
  where try_cast(p.id as bigint) is not null)"""


def _people(name: str = "persons", billed: str = "billed") -> str:
    return f"{name} as (select * from (select *, row_number() over (partition by pid order by movie_id desc, so desc, ordinal desc) k from {billed}) where k = 1)"


def _rails_with(p: RailParams = RailParams()) -> str:
    """CTEs up to ``picks``: source_id, rail, k, neighbour_id, score of all rails."""
    dims = f"list_transform(list_sort(list_transform(range(1, {DIM + 1}), lambda i: {{'a': -abs(v[i]), 'i': i}}))[1:{p.top_dims}], lambda s: s.i)"
    parts = [_UNITS, f"q as (select id, v, {dims} dims from mu)"]
    g = p.gap_dim + 1
    for i, rail in enumerate(RAILS):
        floor = f"c.vote_count >= {p.visibility_floor}" + (f" and c.vote_count < {p.vote_ceiling}" if rail == "hidden_gem" else "")
        score = "list_inner_product(q.v, c.v)"
        if rail == "same_mood":
            sub = lambda t: f"list_transform(q.dims, lambda d: {t}.v[d])"
            a, b = sub("q"), sub("c")
            length = f"(sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})))"
            score = f"case when {length} > 0 then list_inner_product({a}, {b}) / {length} else -1.0 end"
        gate = {"darker_pick": f" and c.v[{g}] >= q.v[{g}] + {p.gap}", "more_accessible": f" and c.v[{g}] <= q.v[{g}] - {p.gap}"}.get(rail, "")
        before = f" anti join (select source_id, neighbour_id from {' union all select source_id, neighbour_id from '.join(f'p{j}' for j in range(i))}) using (source_id, neighbour_id)" if i else ""
        parts.append(
            f"""s{i} as (select q.id source_id, c.id neighbour_id, round({score}, 9) score from q, mu c where q.id <> c.id and {floor}{gate}),
n{i} as (select * from (select *, row_number() over (partition by source_id order by score desc, neighbour_id) k from s{i}) where k <= {p.net_size}),
p{i} as (select * from (select source_id, neighbour_id, score, row_number() over (partition by source_id order by score desc, neighbour_id) k from n{i}{before}) where k <= {p.top_k})"""
        )
    parts.append("picks as (" + " union all ".join(f"select source_id, '{rail}' rail, k, neighbour_id, score from p{i}" for i, rail in enumerate(RAILS)) + ")")
    return "with " + ",\n".join(parts)


_RAIL_COLUMNS = 'source_id, cast(k as int) "rank", neighbour_id, round(score, 6) score'


def _incomplete(observed: bool, vectors: str | None = None) -> str:
    rails = ", ".join(f"'{r}'" for r in AUDITED)
    low = "low" if observed else f"case when rails = {len(AUDITED)} then low else 0 end"
    return f"""with {_MV + "," if vectors is None else vectors}
r as (select source_movie_id id, recommendation_type t, count(*) n from movie_neighbors where recommendation_type in ({rails}) and source_movie_id is not null group by all),
m as (select id, min(n) low, count(*) rails from r group by id)
select id, fewest from (select mv.id, cast(coalesce({low}, 0) as bigint) fewest from mv left join m using (id)) where fewest < 10"""


_P2 = f"""with docs as (
  select fetch_id, case when json_type(payload) = 'VARCHAR' then payload::json ->> '$' else payload end p from credits_raw where payload is not null and json_valid(payload)),
t as (select d.fetch_id, j.key, j.type, j.value, j.atom, j.id, j.parent from (select * from docs where json_valid(p)) d, json_tree(d.p) j),
c as (select fetch_id, id, key kind, type from t where key in ('cast', 'crew') and type in ('ARRAY', 'OBJECT')),
e as (
  select t.fetch_id, t.id, c.kind, cast(t.key as int) pos from t join c on c.fetch_id = t.fetch_id and c.id = t.parent and c.type = 'ARRAY' where t.type = 'OBJECT'
  union all select fetch_id, id, kind, 0 from c where type = 'OBJECT'),
ids as (select fetch_id, parent, try_cast(atom ->> '$' as bigint) pid from t
  where key = 'id' and (type in ('BIGINT', 'UBIGINT') or type = 'VARCHAR' and regexp_full_match(atom ->> '$', '[0-9]+'))),
p as (select e.*, coalesce(i.pid, j.pid) pid from e
  left join ids i on i.fetch_id = e.fetch_id and i.parent = e.id
  left join (select t.fetch_id, t.parent, ids.pid from t join ids on ids.fetch_id = t.fetch_id and ids.parent = t.id where t.key = 'person' and t.type = 'OBJECT') j
    on j.fetch_id = e.fetch_id and j.parent = e.id),
names as (select fetch_id, parent, max(atom ->> '$') filter (key = 'character') c, max(atom ->> '$') filter (key = 'job') j
  from t where key in ('character', 'job') and type not in ('ARRAY', 'OBJECT', 'NULL') group by all),
roles as (select l.fetch_id, l.parent, cast(x.key as int) role_pos, x.id from t l join t x on x.fetch_id = l.fetch_id and x.parent = l.id where l.key in ('roles', 'jobs') and l.type = 'ARRAY'),
out as (
  select p.fetch_id, p.kind, p.pos, coalesce(r.role_pos, 0) role_pos, p.pid,
    case when r.id is null then case when p.kind = 'cast' then coalesce(o.c, o.j) else coalesce(o.j, o.c) end
         else case when p.kind = 'cast' then coalesce(n.c, n.j) else coalesce(n.j, n.c) end end name
  from p left join roles r on r.fetch_id = p.fetch_id and r.parent = p.id
  left join names n on n.fetch_id = r.fetch_id and n.parent = r.id
  left join names o on o.fetch_id = p.fetch_id and o.parent = p.id where p.pid is not null)
select fetch_id, kind credit_kind, pos, role_pos, pid tmdb_person_id, coalesce(regexp_replace(name, '^{SPACE}+|{SPACE}+$', '', 'g'), '') role_name from out"""

_P2_ENTRIES = _P2[: _P2.index("names as (")] + """names as (select fetch_id, parent, max(atom ->> '$') n from t where key = 'name' and type not in ('ARRAY', 'OBJECT', 'NULL') group by all),
roles as (select l.fetch_id, l.parent, cast(x.key as int) role_pos, x.id from t l join t x on x.fetch_id = l.fetch_id and x.parent = l.id where l.key in ('roles', 'jobs') and l.type = 'ARRAY')
select p.fetch_id, c.kind container, lower(c.type) container_kind, p.pos, coalesce(r.role_pos, 0) role_pos, p.pid tmdb_person_id, n.n entry_name
from p join (select t.fetch_id, t.id, t.parent, t.type own from t) x on x.fetch_id = p.fetch_id and x.id = p.id
join c on c.fetch_id = p.fetch_id and (c.type = 'ARRAY' and c.id = x.parent or c.type = 'OBJECT' and c.id = p.id)
left join roles r on r.fetch_id = p.fetch_id and r.parent = p.id left join names n on n.fetch_id = p.fetch_id and n.parent = p.id where p.pid is not null"""

_NODES = """with docs as (
  select fetch_id, case when json_type(payload) = 'VARCHAR' then payload::json ->> '$' else payload end p from credits_raw where payload is not null and json_valid(payload)),
t as (select d.fetch_id, j.key, j.type, j.id, j.parent from (select * from docs where json_valid(p)) d, json_tree(d.p) j)
select case when u.type = 'ARRAY' then null else t.key end label,
  case t.type when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'str' when 'BOOLEAN' then 'bool' when 'NULL' then 'null' when 'DOUBLE' then 'float' else 'int' end kind,
  count(*) n
from t left join t u on u.fetch_id = t.fetch_id and u.id = t.parent group by all"""


_LINKS = """with docs as (
  select fetch_id, case when json_type(payload) = 'VARCHAR' then payload::json ->> '$' else payload end p from credits_raw where payload is not null and json_valid(payload)),
t as (select d.fetch_id, j.key, j.type, j.id, j.parent from (select * from docs where json_valid(p)) d, json_tree(d.p) j),
k as (select *, case type when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'str' when 'BOOLEAN' then 'bool' when 'NULL' then 'null' when 'DOUBLE' then 'float' else 'int' end kind from t),
up as (select k.*, p.kind pk, g.type gt, p.key pkey from k left join k p on p.fetch_id = k.fetch_id and p.id = k.parent left join k g on g.fetch_id = p.fetch_id and g.id = p.parent)
select case when gt = 'ARRAY' then null else pkey end parent_label, pk parent_kind, case when pk = 'array' then null else key end label, kind, count(*) n,
  max(case when pk = 'array' then cast(key as int) end) last_ordinal
from up group by all"""


def oracle_sql() -> dict[str, str]:
    cutoff = lambda d: f"cast(date_trunc('month', {d}) - interval 6 month as date) + cast(day({d}) - 1 as int)"
    found = {
        "vec_normalize": f"""select vec_id, round({_NORM.format("v")}, 4) before, round({_NORM.format("u")}, 6) "after", round(u[1], 6) "first" from (
  select vec_id, v, {_unit("v")} u from (select vec_id, list_transform(cast(embedding as double[]), lambda x: x * (1 + vec_id % 7)) v from embeddings))""",
        "vec_pair_distance": f"""with {_MV}, {_CV}
select a.movie_id, a.cluster_id, round(list_distance(m.v, c.v), 4) distance, round(list_cosine_similarity(m.v, c.v), 6) cosine
from (select distinct movie_id, cluster_id from movie_cluster_assignments) a join mv m on m.id = a.movie_id join cv c on c.id = a.cluster_id""",
        "vec_literal_roundtrip": f"with {_MV} select id, cast(len(v) as int) dims, round(list_sum(v), 4) total, true same from mv",
        "slugify": f"with {_MOV} select id, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug from mov",
        "text_length_trim": f"""select doc_id, cast(length(t) + len(list_filter(string_split(t, ''), lambda c: ord(c) > 65535)) as int) units, cast(length(t) as int) points
from (select doc_id, regexp_replace(text, '^{BLANK}+|{BLANK}+$', '', 'g') t from documents)""",
        "keyword_quality": f"select distinct keyword, not {_BAD} good from (select unnest(keywords) keyword from movies) where keyword is not null",
        "movies_latest": f"with {_MOV} select id, tmdb_id, vote_count, popularity from mov",
        "recent_cutoff": f"select distinct d \"day\", {cutoff('d')} cutoff from (select cast(o_orderdate as date) d from orders)",
        "catalog_rank": f"""with {_MOV},
u as (select id key, 0 tier, popularity score from mov where try_cast(release_date as date) >= {cutoff(f"date '{AS_OF}'")} and popularity >= 20
  union all select id, 1, cast(vote_count as double) from mov where vote_count >= 20),
b as (select * from (select *, row_number() over (partition by key order by tier, score desc nulls last) k from u) where k = 1)
select key id, tier, cast(row_number() over (order by tier, score desc nulls last, key) as int) "rank" from b qualify "rank" <= 250000""",
        "release_years": f"with {_MOV} select id, nullif(release_date, '') release_date, try_cast(substr(release_date, 1, 4) as int) release_year, nullif(tagline, '') tagline, budget from mov",
        "flat_credits": f"""with {_replies()} select movie_id, coalesce(array_to_string(n[1:10], '|'), '') top_cast,
  coalesce(array_to_string(list_transform(list_filter(crew, lambda x: x.job = 'Director'), lambda x: x.name), '|'), '') directors, cast(coalesce(len(n), 0) as int) n_cast
from (select *, list_transform(list_filter(cast_, lambda x: x is not null), lambda x: x.name) n from replies)""",
        "new_catalog_ids": """select distinct tmdb_id from movies where tmdb_id is not null
and tmdb_id not in (select tmdb_id from credits_raw where tmdb_id is not null and fetched_at < timestamp '2024-10-01')""",
        "movies_by_votes": f"with {_MOV} select id, vote_count, row_number() over (order by vote_count desc nulls first, id) \"rank\" from mov",
        "flat_movie": f"""with {_MOV}, {_replies()}, d as (select mov.*, r.cast_, r.crew from mov left join replies r on r.movie_id = mov.tmdb_id where tmdb_id is not null)
select tmdb_id, title, original_title, overview, nullif(tagline, '') tagline, original_language, nullif(release_date, '') release_date, try_cast(substr(release_date, 1, 4) as int) release_year, runtime, budget, revenue,
  vote_average, vote_count, popularity, adult, case when runtime > 90 then '/p' || id end poster_path, case when runtime > 90 then 'http://i/w500/p' || id end poster_url,
  array_to_string(list_transform(coalesce(genres, []), lambda x: coalesce(x, '?')), '|') genres, array_to_string(list_transform(coalesce(keywords, []), lambda x: coalesce(x, '?')), '|') keywords,
  array_to_string(list_transform(list_filter(coalesce(cast_, []), lambda x: x is not null)[1:10], lambda x: coalesce(x.name, '?')), '|') top_cast,
  array_to_string(list_transform(list_filter(coalesce(crew, []), lambda x: x.job = 'Director'), lambda x: coalesce(x.name, '?')), '|') directors, '' production_companies
from d""",
        "discovered": """select tmdb_id id, max(vote_count) vote_count, round(max(popularity), 6) popularity, max(release_date) release_date
from movies where tmdb_id is not null and vote_count >= 20 and release_year between 1990 and 2010 group by 1""",
        "discovered_recent": f"""select tmdb_id id, max(vote_count) vote_count, round(max(popularity), 6) popularity, max(release_date) release_date
from movies where tmdb_id is not null and try_cast(release_date as date) >= {cutoff(f"date '{AS_OF}'")} and popularity >= 20 group by 1""",
        "companies_backfill": f"""with {_MOV} select id, array_to_string(list_transform(case when tmdb_id is not null and runtime is not null and (keywords is null or len(keywords) = 0)
  then ['studio ' || coalesce(original_language, '?')] else keywords end, lambda x: coalesce(x, '?')), '|') "names" from mov""",
        "pulled_vectors": """select keyword, cast(length(keyword) as int) n_chars, cast(length(keyword) - length(replace(keyword, 'a', '')) as int) n_a
from (select distinct unnest(keywords) keyword from movies) where keyword is not null""",
        "embedding_replies": "select vec_id, round(list_sum(cast(embedding as double[])), 6) total from embeddings",
        "unassigned_movies": f"with {_MV} select id from mv where id not in (select movie_id from movie_cluster_assignments where movie_id is not null)",
        "movies_without_neighbors": f"with {_MV} select id from mv where id not in (select source_movie_id from movie_neighbors where source_movie_id is not null)",
        "movies_without_documents": "select distinct tmdb_id from movies where tmdb_id is not null and tmdb_id not in (select tmdb_id from documents where tmdb_id is not null)",
        "keywords_todo": f"with {_MOV} select id, keywords is null as unknown from mov where keywords is null or len(keywords) = 0",
        "catalog_page": "select distinct id from movies where id > '8' order by id limit 500",
        "assign_top4_m14": f"with {_UNITS}, {_CUNITS}, {_top4('cu', 1.4)} {_ASSIGNED}",
        "assign_top4_m1005": f"with {_UNITS}, {_CUNITS}, {_top4('cu', 1.005)} {_ASSIGNED}",
        "assign_top4_plain_centroids": f"with {_UNITS}, {_MEANS}, {_top4('packed', 1.4)} {_ASSIGNED}",
        "assign_histogram": f"""with {_UNITS}, {_CUNITS}, {_top4('cu', 1.6)}, c as (select movie_id, count(*) n from picked group by 1)
select b n_clusters, cast(coalesce(x.k, 0) as bigint) n_items from range(1, 5) t(b) left join (select n, count(*) k from c group by 1) x on x.n = b""",
        "nearest_cluster": f"""with {_EMB}, m as (select label, pos, avg(x) x from (select label, unnest(v) x, generate_subscripts(v, 1) pos from emb) group by all),
c as (select label, list(x order by pos) v from m group by label)
select vec_id, label, round(d, 6) distance from (select e.id vec_id, c.label, list_distance(e.v, c.v) d, row_number() over (partition by e.id order by list_distance(e.v, c.v), cast(c.label as varchar)) k from emb e, c) where k = 1""",
        "centroid_means": f"with {_UNITS}, {_MEANS} select cluster_id, cast(pos as int) pos, round(mean, 6) mean, n from means",
        "cluster_popularity": f"""with {_MOV} select cluster_id, count(*) film_count, round(avg(m.vote_count), 4) avg_vote_count
from (select distinct movie_id, cluster_id from movie_cluster_assignments where cluster_id is not null) a join mov m on m.id = a.movie_id group by 1""",
        "affected_group_recount": """select a.cluster_id, count(*) n_members from (select distinct movie_id, cluster_id from movie_cluster_assignments) a
where a.cluster_id in (select cluster_id from movie_cluster_assignments where assigned_at >= timestamp '2025-05-20') group by 1""",
        "start_distances": f"""with {_EMB}, c as (select v from emb order by id limit 5),
d as (select e.id, min(pow(list_distance(e.v, c.v), 2)) d2 from emb e, c group by 1)
select id vec_id, round(d2, 6) d2, round(d2 / (select sum(d2) from d) * 1000, 6) per_mille from d""",
        "lloyd_step": _lloyd(1),
        "lloyd_3_rounds": _lloyd(3),
        "cluster_build": f"""with {_RUN}, p as (select cluster, count(*) assigned, round(avg(d), 6) mean_distance from picked group by 1)
select {_NAME3.format("s.cluster")} cluster_id, l."label", film_count, assigned, mean_distance from sizes s join labels l using (cluster) left join p using (cluster)""",
        "cluster_build_assignments": f"with {_RUN} select movie_id, {_NAME3.format('cluster')} cluster_id, cast(k as int) \"rank\", round(d, 6) distance from picked",
        "keyword_groups": f"""with {_keyword_run()}, g as (select cluster, "label", regexp_replace(regexp_replace(lower("label"), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') b from labels)
select {_NAME3.format("cluster")} group_id, case when k = 1 then b else b || '-' || k end slug, "label", (select count(*) from nat n where n.cluster = g.cluster) keyword_count
from (select *, row_number() over (partition by b order by cluster) k from g) g""",
        "keyword_members": f"with {_keyword_run()} select keyword, {_NAME3.format('cluster')} group_id, round(d, 6) distance from nat",
        "keyword_nearest_group": f"""with {_keyword_run()}, n as (select cluster, count(*) c from (select keyword, cluster from nat union all select keyword, cluster from new) group by 1)
select keyword, {_NAME3.format("cluster")} group_id, round(d, 6) distance, c keyword_count from new join n using (cluster)""",
        "person_credits": f"""with {_replies()}, {_billed()}, {_people()}, {_replies('first_', False)}, {_billed('b0', 'first_')}, {_people('p0', 'b0')},
o as (select pid, row_number() over (order by pid) person_id from p0),
ids as (select * from o union all select pid, (select count(*) from o) + row_number() over (order by pid) from persons where pid not in (select pid from o))
select movie_id, person_id, credit_type, cast(ordinal as int) ordinal, "character", billing_order, job from billed join ids using (pid)""",
        "cluster_label_samples": """select cluster_id, movie_id, cast(k as int) pick from (
  select *, row_number() over (partition by cluster_id order by md5(movie_id), movie_id) k from (select distinct cluster_id, movie_id from movie_cluster_assignments where cluster_id is not null and movie_id is not null)) where k <= 25""",
        "cluster_labels": f"""with {_MOV}, m as (select distinct cluster_id, title from movie_cluster_assignments a join mov on mov.id = a.movie_id where cluster_id is not null),
p as (select * from (select *, row_number() over (partition by cluster_id order by md5(title), title) k from m where trim(title) <> '') where k <= 3)
select cluster_id, coalesce(string_agg(title, ', ' order by k), 'Untitled Cluster') "label" from (select distinct cluster_id from m) left join p using (cluster_id) group by 1""",
        "keyword_vocab": f"with {_MOV}, k as (select keyword, count(*) n from (select unnest(keywords) keyword from mov) where keyword is not null group by 1 having count(*) >= 15) select keyword, n from k where not {_BAD}",
        "ungrouped_keywords": """select distinct lower(k) keyword from (select unnest(keywords) k from movies) where k is not null
and lower(k) not in (select unnest(string_split(lower(label), ' ')) from movie_theme_clusters where label is not null)""",
        "group_slugs": """with s as (select id, regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') b from movie_theme_clusters where trim(label) <> '')
select id, case when k = 1 then b else b || '-' || k end slug from (select *, row_number() over (partition by b order by id) k from s)""",
        "credit_rows": f"with {_replies()}, {_billed()} select movie_id, pid tmdb_person_id, credit_type, cast(ordinal as int) ordinal, \"character\", billing_order, job, department from billed",
        "people": f"""with {_replies()}, {_billed()}, {_people()} select pid tmdb_person_id, name, profile_path, case when profile_path <> '' then 'w185' || profile_path end profile_url,
  dep known_for_department, popularity from persons""",
        "people_upsert": f"""with {_replies()}, {_billed()}, {_people()}, {_replies('first_', False)}, {_billed('b0', 'first_')}, {_people('p0', 'b0')}
select coalesce(o.pid, n.pid) tmdb_person_id, case when n.pid is not null then n.name else o.name end name, o.profile_path, case when n.pid is not null then n.popularity else o.popularity end popularity
from p0 o full join persons n on n.pid = o.pid""",
        "director_credits": f"""with {_replies()}, {_billed()} select movie_id, string_agg(concat_ws(':', cast(pid as varchar), name), '|' order by ordinal) director_credits
from billed where credit_type = 'crew' group by 1""",
        "director_patch": f"""with {_MOV}, {_replies()}, {_billed()}, d as (select movie_id, cast(count(*) as varchar) n from billed where credit_type = 'crew' group by 1)
select tmdb_id, id, case when d.n is not null then d.n else tagline end tagline from mov left join d on d.movie_id = tmdb_id""",
        "nested_nodes": _NODES,
        "nested_links": _LINKS,
        "p2_entries": _P2_ENTRIES,
        "p2_found": _P2,
        "rails": f"{_rails_with()} select source_id, rail, cast(k as int) \"rank\", neighbour_id, round(score, 6) score from picks",
        "rails_for_new": f"{_rails_with()} select rail, {_RAIL_COLUMNS} from picks where source_id not in (select source_movie_id from movie_neighbors where source_movie_id is not null)",
        "rails_for_affected": f"""{_rails_with(RailParams(net_size=150))}, aff as ({_incomplete(False, "")})
select source_id source_movie_id, rail recommendation_type, cast(k as int) "rank", neighbour_id neighbor_movie_id, round(score, 6) score from picks
where rail in ({", ".join(f"'{r}'" for r in AUDITED)}) and source_id in (select id from aff)""",
        "rails_incomplete": _incomplete(False),
        "rails_incomplete_observed": _incomplete(True),
        "run_audit": """select 'count' run_type, 'success' status, count(try_cast(release_date as date)) rows_processed, count(*) - count(try_cast(release_date as date)) rows_failed, cast(null as varchar) error_message from movies
union all select 'broken', 'failed', 0, 0, 'the source is gone'""",
        "sink_merge": f"""with {_MOV}, n as (select cluster_id, count(*) c from (select distinct movie_id, cluster_id from movie_cluster_assignments where cluster_id is not null) a join mov m on m.id = a.movie_id group by 1)
select coalesce(t.id, n.cluster_id) id, coalesce(n.c, t.film_count) film_count from movie_theme_clusters t full join n on n.cluster_id = t.id""",
        "stream_assign": f"with {_UNITS}, {_CUNITS}, {_top4('cu', 1.4)} {_ASSIGNED}",
    }
    for rail in RAILS:
        found[f"rail_{rail}"] = f"{_rails_with()} select {_RAIL_COLUMNS} from picks where rail = '{rail}'"
    return found
