"""Queries on timed events: counts, correlation, sessions, similarity, clusters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.operators import clusters, correlation, sessions
from emberlane.operators.running import Running
from emberlane.plans.catalog import query, table
from emberlane.session import shared_dir
from emberlane.sources import files

EVENTS = ["cart", "click", "purchase", "search", "view"]
THRESHOLD = 0.2


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 5).alias("country"), "ts", F.col("event_type").alias("event"))


def vocabulary(spark: SparkSession, sf_dir: str) -> list[str]:
    """The distinct event types, a vocabulary of fixed size."""
    return [r[0] for r in table(spark, sf_dir, "events").select("event_type").distinct().orderBy("event_type").collect()]


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "events").select(F.col("event_type").alias("event")).distinct()
    return correlation.daily_counts(countries(spark, sf_dir), words)


_DAILY = """e as (select user_id % 5 country, ts::date as day, event_type as event from events), v as (select distinct event from e), d as (select distinct country, day from e),
n as (select d.country, d.day, v.event, count(e.event)::bigint n from d cross join v left join e on e.country = d.country and e.day = d.day and e.event = v.event group by all)"""
_CORR = """cq as (select a.country, a.event event_a, b.event event_b, count(*)::hugeint k, sum(a.n)::hugeint x, sum(b.n)::hugeint y, sum(a.n * a.n)::hugeint xx, sum(b.n * b.n)::hugeint yy, sum(a.n * b.n)::hugeint xy
  from n a join n b on a.country = b.country and a.day = b.day group by a.country, a.event, b.event),
cz as (select country, event_a, event_b, k * xy - x * y cov, k * xx - x * x vx, k * yy - y * y vy from cq),
c as (select country, event_a, event_b, case when cov > 0 and vx > 0 and vy > 0 then cov::double / (sqrt(vx::double) * sqrt(vy::double)) else 0 end::double corr from cz)"""
_MEAN = "p as (select event_a, event_b, coalesce(avg(corr) filter (corr > 0), 0) corr from c group by event_a, event_b)"


@query(f"with {_DAILY} select country, strftime(day, '%Y-%m-%d') as day, event, n from n")
def daily_counts(spark, sf_dir):
    return daily(spark, sf_dir).select("country", F.col("day").cast("string").alias("day"), "event", "n")


@query("""select user_id, string_agg(event_type || ':' || n::varchar, ',' order by event_type) vector, string_agg(case when n > 0 then 1 else 0 end::varchar, '' order by event_type) indicator
from (select u.user_id, v.event_type, count(e.event_id) n from (select distinct user_id from events) u cross join (select distinct event_type from events) v
left join events e on e.user_id = u.user_id and e.event_type = v.event_type group by u.user_id, v.event_type) t group by user_id""")
def event_vector(spark, sf_dir):
    words = vocabulary(spark, sf_dir)
    per = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list("event_type").alias("tags"))
    n = lambda w: F.size(F.filter("tags", lambda x: x == w))
    return per.select("user_id", F.concat_ws(",", *[F.concat(F.lit(f"{w}:"), n(w).cast("string")) for w in words]).alias("vector"), F.concat(*[F.array_contains("tags", w).cast("int").cast("string") for w in words]).alias("indicator"))


def corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.correlations(daily(spark, sf_dir))


@query(f"with {_DAILY}, {_CORR} select country, event_a, event_b, round(corr, 6) corr from c")
def event_corr(spark, sf_dir):
    return corr(spark, sf_dir).withColumn("corr", F.round("corr", 6))


@query(f"with {_DAILY}, {_CORR} select country, event_a, event_b, round(corr, 6) corr from c")
def corr_running(spark, sf_dir):
    """In three increments, the last two of which share a day; one comes twice."""
    e = countries(spark, sf_dir)
    running = Running(spark, f"{shared_dir(spark)}/running-{uuid.uuid4().hex}", tuple(vocabulary(spark, sf_dir)), "bigint")
    cut = [F.col("ts") < F.lit(t).cast("timestamp_ntz") for t in ("2024-01-06", "2024-01-15 09:30:00")]
    for number, part in ((0, e.where(cut[0])), (1, e.where(~cut[0] & cut[1])), (1, e.where(~cut[0] & cut[1])), (2, e.where(~cut[1]))):
        running.add(part, "days", number)
    return running.correlations().withColumn("corr", F.round("corr", 6))


@query(f"with {_DAILY}, {_CORR}, {_MEAN} select event_a, event_b, round(corr, 6) corr from p")
def corr_positive_mean(spark, sf_dir):
    return correlation.positive_mean(corr(spark, sf_dir)).withColumn("corr", F.round("corr", 6))


@query(f"with {_DAILY}, {_CORR}, {_MEAN} select event_a, event_b, round(corr, 6) corr from p")
def corr_unpivot(spark, sf_dir):
    path = f"{shared_dir(spark)}/matrix-{uuid.uuid4().hex}"
    wide = correlation.pivoted(correlation.positive_mean(corr(spark, sf_dir)), vocabulary(spark, sf_dir))
    files.write_csv(wide.withColumnRenamed("event_a", "label"), path)
    return files.read_matrix(spark, path).withColumn("corr", F.round("corr", 6))


_SESSIONS = """s0 as (select *, case when ts - lag(ts) over w < interval 24 hours then 0 else 1 end new from events window w as (partition by user_id order by ts, event_id)),
s as (select event_id, user_id, ts, event_type, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding)::bigint as session from s0)"""


def in_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.time_sessions(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "24 hours")


@query(f"with {_SESSIONS} select event_id, user_id, session from s")
def time_sessions(spark, sf_dir):
    return in_sessions(spark, sf_dir).select("event_id", "user_id", F.col("session").cast("long").alias("session"))


@query("select a.user_id, a.event_id a, b.event_id b from events a join events b on a.user_id = b.user_id and a.event_id < b.event_id and abs(epoch_us(a.ts) - epoch_us(b.ts)) < 7200000000")
def time_adjacency(spark, sf_dir):
    return sessions.near_in_time(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id", "2 hours")


_REFS = "case when event_id % 3 = 0 then [event_id % 4, 4 + event_id % 5] else [event_id % 4] end"


def with_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.when(F.col("event_id") % 3 == 0, F.array(F.col("event_id") % 4, 4 + F.col("event_id") % 5)).otherwise(F.array(F.col("event_id") % 4))
    return in_sessions(spark, sf_dir).withColumn("ids", ids).withColumn("session", F.col("session").cast("long"))


@query(f"with {_SESSIONS} select user_id, session, count(*)::bigint n, count(distinct {_REFS}) = 1 homogeneous, count(*) filter (event_id % 3 <> 0)::bigint unambiguous from s group by user_id, session")
def session_homogeneous(spark, sf_dir):
    return clusters.session_kinds(with_refs(spark, sf_dir), ["user_id", "session"], "ids").withColumn("unambiguous", F.col("unambiguous").cast("long"))


_CONSENSUS = f"""{_SESSIONS}, r as (select user_id, session, event_id, event_type, ts, unnest({_REFS}) as ref from s),
u as (select user_id, session, event_id % 4 as ref, count(*) n from s where event_id % 3 <> 0 group by all), k as (select *, row_number() over (partition by user_id, session order by n desc, ref) match_rank from u),
b as (select r.user_id, r.session, r.event_id, min(k.match_rank)::int match_rank from r join k on k.user_id = r.user_id and k.session = r.session and k.ref = r.ref group by all)"""


@query(f"with {_CONSENSUS} select b.user_id, b.session, b.event_id, k.ref, b.match_rank from b join k on k.user_id = b.user_id and k.session = b.session and k.match_rank = b.match_rank")
def mixed_session(spark, sf_dir):
    return clusters.consensus(with_refs(spark, sf_dir), ["user_id", "session"], "event_id", "ids").select("user_id", "session", "event_id", "ref", "match_rank")


@query(f"""with {_CONSENSUS}, g as (select distinct user_id, session, match_rank from b), n as (select *, row_number() over (partition by user_id order by session, match_rank) - 1 number from g)
select event_id, user_id::varchar || '-' || number::varchar cluster_id from b join n using (user_id, session, match_rank)""")
def cluster_naming(spark, sf_dir):
    from pyspark.sql.window import Window

    best = clusters.consensus(with_refs(spark, sf_dir), ["user_id", "session"], "event_id", "ids")
    number = F.dense_rank().over(Window.partitionBy("user_id").orderBy("session", "match_rank")) - 1
    return best.select("event_id", F.concat_ws("-", F.col("user_id").cast("string"), number.cast("string")).alias("cluster_id"))


def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's distinct event types of a day."""
    return table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_set("event_type")).alias("e"))


@query(f"""with {_DAILY}, {_CORR}, {_MEAN}, t as (select user_id, ts::date as day, list_sort(list(distinct event_type)) e from events group by 1, 2),
q as (select a.user_id, a.day day_a, b.day day_b, a.e ea, b.e eb from t a join t b on a.user_id = b.user_id and b.day = a.day + 1), x as (select user_id, day_a, len(ea) * len(eb) n, unnest(ea) event_a, eb from q),
y as (select user_id, day_a, n, event_a, unnest(eb) event_b from x)
select user_id, strftime(day_a, '%Y-%m-%d') as day, round(sum(corr) / first(n), 6) sim, round(sum(corr) / first(n), 6) > {THRESHOLD} is_edge from y join p using (event_a, event_b) group by user_id, day_a""")
def event_similarity(spark, sf_dir):
    t = tag_sets(spark, sf_dir)
    later = t.select("user_id", F.date_sub("day", 1).alias("day"), F.col("e").alias("eb"))
    pairs = t.withColumnRenamed("e", "ea").join(later, ["user_id", "day"]).select(F.struct("user_id", "day").alias("a"), F.lit(1).alias("b"), "ea", "eb")
    sim = clusters.similarity(pairs, correlation.positive_mean(corr(spark, sf_dir)))
    return sim.select("a.user_id", F.col("a.day").cast("string").alias("day"), F.round("sim", 6).alias("sim"), (F.round("sim", 6) > THRESHOLD).alias("is_edge"))


def corr_map(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], float]:
    return {(r["event_a"], r["event_b"]): r["corr"] for r in correlation.positive_mean(corr(spark, sf_dir)).collect()}  # a vocabulary's matrix


def _greedy(keys: str, source: str, close_us: int) -> str:
    """An item in no group takes its neighbours to the first group of any of them, item
    by item: arrays of the first and the last group of every item of a session."""
    return f"""l as (select event_a, list(event_b) ok from p where corr > {THRESHOLD} group by event_a),
a as (select {keys}, list(epoch_us(ts) order by ts, event_id) t, list(event_type order by ts, event_id) k, list(event_id order by ts, event_id) ids, list(coalesce(ok, []) order by ts, event_id) o from {source} left join l on event_a = event_type group by all),
g as (select {keys}, t, k, o, ids, 1 i, 0 n, list_transform(t, lambda x: null::int) f, list_transform(t, lambda x: null::int) z from a
  union all select {keys}, t, k, o, ids, i + 1, case when z[i] is null and m is null then n + 1 else n end,
    case when z[i] is null then list_transform(range(1, len(t) + 1), lambda j: case when b[j] then least(coalesce(f[j], coalesce(m, n)), coalesce(m, n)) else f[j] end) else f end,
    case when z[i] is null then list_transform(range(1, len(t) + 1), lambda j: case when b[j] then greatest(coalesce(z[j], -1), coalesce(m, n)) else z[j] end) else z end
  from (select *, list_min(list_filter(list_transform(range(1, len(t) + 1), lambda j: case when b[j] then f[j] end), lambda x: x is not null)) m
    from (select *, list_transform(range(1, len(t) + 1), lambda j: j = i or abs(t[j] - t[i]) < {close_us} or list_contains(o[i], k[j])) b from g where i <= len(t)))),
h as (select {keys}, unnest(ids) event_id, unnest(z) sub, n subs from g where i = len(t) + 1)"""


@query(f"with recursive {_DAILY}, {_CORR}, {_MEAN}, {_SESSIONS}, {_greedy('user_id, session', 's', 1_800_000_000)} select user_id, session, event_id, sub, subs from h")
def event_subsplit(spark, sf_dir):
    s = with_refs(spark, sf_dir).withColumn("tags", F.array("event_type"))
    return clusters.subsplit(s, ["user_id", "session"], "ts", "event_id", "tags", corr_map(spark, sf_dir), THRESHOLD, 1800.0)


_BY = "user_id, session, match_rank"


@query(f"""with recursive {_DAILY}, {_CORR}, {_MEAN}, {_CONSENSUS}, sr as (select *, {_REFS} refs from s),
kd as (select user_id, session, count(*) size, count(distinct refs) = 1 same, count(*) filter (len(refs) = 1) lone from sr group by all),
sk as (select * from sr join kd using (user_id, session)),
ag as (select sk.*, b.match_rank, [k.ref] found, count(*) over (partition by {', '.join('b.' + c for c in _BY.split(', '))}) members from sk join b using (user_id, session, event_id) join k on k.user_id = b.user_id and k.session = b.session and k.match_rank = b.match_rank where size > 1 and not same and lone > 0),
ts as (select event_id, {_BY}, ts, event_type, found from ag where members >= 10 union all select event_id, user_id, session, 0, ts, event_type, refs from sk where size > 1 and not same and lone = 0),
{_greedy(_BY, 'ts', 1_800_000_000)},
gr as (select event_id, {_BY}, sub, subs, found from h join ts using (event_id, {_BY}) union all select event_id, {_BY}, 0, 1, found from ag where members < 10
  union all select event_id, user_id, session, 0, 0, 1, refs from sk where size = 1 or same),
st as (select {_BY}, max(subs) subs from gr group by all), os as (select {_BY}, coalesce(sum(subs) over (partition by user_id order by session, match_rank rows between unbounded preceding and 1 preceding), 0)::bigint first_number from st)
select event_id, user_id::varchar || '-' || (first_number + sub)::varchar cluster_id, array_to_string(found, ',') ref_match_cl from events left join (select event_id, sub, first_number, found from gr join os using ({_BY})) x using (event_id)""")
def incident_clusters(spark, sf_dir):
    """Sessions, consensus, greedy sub-splits and names, over all events."""
    e = with_refs(spark, sf_dir).select(F.col("event_id").alias("item"), F.col("user_id").cast("string").alias("country"), "ts", "ids", F.array("event_type").alias("events"))
    out = clusters.clustered(e, corr_map(spark, sf_dir), "24 hours", 1800.0, THRESHOLD, 10)
    return out.select(F.col("item").alias("event_id"), "cluster_id", F.array_join("ref_match_cl", ",").alias("ref_match_cl"))
