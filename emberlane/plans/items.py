"""Queries on texts: scans, predicates, tags, names, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.functions import text as X
from emberlane.operators import entities, gazetteer, merge, tagging
from emberlane.plans.catalog import query, table
from emberlane.session import shared_dir
from emberlane.sources import files, search

KEYWORDS = ["the", "que", "that", "est", "de la", "für"]
_VALUES = lambda xs: ", ".join("('" + x.replace("'", "''") + "')" for x in xs)
_K = f"(values {_VALUES(KEYWORDS)}) k(match)"
_RE = "'(?i)\\b' || match || '\\b'"


def strings(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item"), "text")


def keywords(spark: SparkSession) -> DataFrame:
    return strings(spark, KEYWORDS, "match")


@query("select doc_id, source, n_chars from documents where lang = 'en' and n_chars > 500")
def scan_project(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("lang = 'en' and n_chars > 500").select("doc_id", "source", "n_chars")


@query("select event_id, user_id, event_type from events where ts >= timestamp '2024-01-10'")
def date_filter(spark, sf_dir):
    return table(spark, sf_dir, "events").where("ts >= timestamp_ntz '2024-01-10'").select("event_id", "user_id", "event_type")


@query("select distinct role from conversations")
def distinct_unwind(spark, sf_dir):
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return per.select(F.explode("roles").alias("role")).distinct()


@query(f"select match, count(*)::bigint n_items from documents, {_K} where regexp_matches(text, {_RE}) group by match")
def kw_whole_word(spark, sf_dir):
    return tagging.whole_words(docs(spark, sf_dir), keywords(spark), ["text"]).groupBy("match").agg(F.count("*").alias("n_items"))


@query(f"select match, count(*)::bigint n_items from documents, {_K} where regexp_matches(text, '(?i)' || match) group by match")
def kw_substring(spark, sf_dir):
    return tagging.contained(docs(spark, sf_dir), keywords(spark), ["text"]).groupBy("match").agg(F.count("*").alias("n_items"))


@query("select match, count(*)::bigint n_items from documents, (values ('The'), ('THE'), ('Der'), ('la')) k(match) where regexp_matches(text, '\\b' || match || '\\b') group by match")
def kw_case_sensitive(spark, sf_dir):
    return tagging.whole_words(docs(spark, sf_dir), strings(spark, ["The", "THE", "Der", "la"], "match"), ["text"], True).groupBy("match").agg(F.count("*").alias("n_items"))


@query("select match, count(*)::bigint n_items from documents, (values ('etre'), ('FÜR D'), ('ecole'), ('nan o')) k(match) where contains(lower(strip_accents(text)), lower(strip_accents(match))) group by match")
def phrase_accent(spark, sf_dir):
    return tagging.contained(docs(spark, sf_dir), strings(spark, ["etre", "FÜR D", "ecole", "nan o"], "match"), ["text"], "phrase").groupBy("match").agg(F.count("*").alias("n_items"))


@query(f"select doc_id, count(*)::bigint n_tags, string_agg(match, ',' order by match) tags from documents, {_K} where regexp_matches(text, {_RE}) group by doc_id")
def event_tags(spark, sf_dir):
    found = tagging.event_tags(docs(spark, sf_dir), keywords(spark), ["text"])
    tags = F.sort_array(F.collect_set("match"))
    return found.groupBy(F.col("item").alias("doc_id")).agg(F.count("*").alias("n_tags"), F.array_join(tags, ",").alias("tags"))


_NAMES = [(1, "The One", "the"), (1, "The One", "of the"), (2, "Que", "que"), (3, "Für", "für"), (4, "Est Nord", "est")]
_NAMES_SQL = "(values " + ", ".join(f"({i}::bigint, '{a}', '{m}')" for i, a, m in _NAMES) + ") g(id, initial, match)"
_REF = f"({_RE.join(['regexp_matches(text, ', ')'])} or contains(lower(strip_accents(text)), lower(strip_accents(match))))"


def names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_NAMES, "id long, initial string, match string")


@query(f"select doc_id, string_agg(id || ':' || match, ',' order by id, match) tags from documents, {_NAMES_SQL} where {_REF} group by doc_id")
def tag_collect(spark, sf_dir):
    items = docs(spark, sf_dir)
    found = tagging.refname_tags(items, names(spark), ["text"])
    out = tagging.collected(items.select("item"), found, "tags", F.struct("id", "match"))
    return out.where(F.size("tags") > 0).select(F.col("item").alias("doc_id"), F.array_join(F.transform("tags", lambda t: F.concat_ws(":", t["id"].cast("string"), t["match"])), ",").alias("tags"))


@query(f"""with t as (select doc_id, count(match) n from documents left join {_K} on regexp_matches(text, {_RE}) group by doc_id)
select count(*) filter (n = 0)::bigint n_empty, count(*) filter (n = 1)::bigint n_one, count(*) filter (n > 0)::bigint n_some from t""")
def array_size_filter(spark, sf_dir):
    items = docs(spark, sf_dir)
    t = tagging.collected(items.select("item"), tagging.event_tags(items, keywords(spark), ["text"]), "events_tags", F.col("match"))
    n = F.size(F.coalesce("events_tags", F.array().cast("array<string>")))
    return t.agg(F.count_if(n == 0).alias("n_empty"), F.count_if(n == 1).alias("n_one"), F.count_if(n > 0).alias("n_some"))


@query(f"select doc_id, count(match)::bigint n_before, 0 n_geo, 0 n_owner, 0 n_ref, 0 n_country, 0 n_events from documents left join {_K} on regexp_matches(text, {_RE}) group by doc_id")
def reset_tags(spark, sf_dir):
    from emberlane.plans.pipeline import reset

    items = docs(spark, sf_dir)
    tagged = tagging.collected(items.select("item"), tagging.event_tags(items, keywords(spark), ["text"]), "events_tags", F.col("match"))
    r = reset(tagged.withColumn("n_before", F.size("events_tags").cast("long")))
    return r.select(F.col("item").alias("doc_id"), "n_before", *[F.size(c).alias(a) for c, a in (("geo_tags", "n_geo"), ("owner_tags", "n_owner"), ("ref_match", "n_ref"), ("country_match", "n_country"), ("events_tags", "n_events"))])


@query(f"select doc_id, id, match from documents, {_NAMES_SQL} where {_REF}")
def refname_tag(spark, sf_dir):
    return tagging.refname_tags(docs(spark, sf_dir), names(spark), ["text"]).select(F.col("item").alias("doc_id"), "id", "match")


_CITY = [(1, "The Edth", "The Edth"), (2, "La-Ment", "La Ment"), (3, "Onde", "on the"), (4, "De Le", "de le")]


@query("select doc_id, id, match from documents, (values " + ", ".join(f"({i}::bigint, '{a}', '{m}')" for i, a, m in _CITY) + f") g(id, initial, match) where {_REF}")
def city_tag(spark, sf_dir):
    return tagging.city_tags(docs(spark, sf_dir), spark.createDataFrame(_CITY, "id long, initial string, match string"), ["text"]).select(F.col("item").alias("doc_id"), "id", "match")


_OWNERS = [(1, "the"), (2, "tionande"), (3, "heronthe the"), (4, "total"), (5, "verein"), (6, "pour les eau")]
_OWNERS_SQL = "(values " + ", ".join(f"({i}::bigint, '{m}')" for i, m in _OWNERS) + ") g(id, match)"


@query(f"""select doc_id, id, match from documents, {_OWNERS_SQL} where case when lower(match) = 'total' then regexp_matches(text, '\\b(Total|TOTAL)\\b')
  when length(match) < 8 then regexp_matches(text, {_RE}) else regexp_matches(text, '(?i)' || match) or (length(match) > 10 and contains(lower(strip_accents(text)), lower(strip_accents(match)))) end""")
def owner_match(spark, sf_dir):
    return tagging.owner_tags(docs(spark, sf_dir), spark.createDataFrame(_OWNERS, "id long, match string"), ["text"]).select(F.col("item").alias("doc_id"), "id", "match")


@query("""with t as (select p_partkey, unnest([p_type, p_brand, p_name, split_part(p_name, ' ', 1)]) m from part),
d as (select distinct p_partkey, m from t where m is not null)
select a.p_partkey, count(*)::bigint n_kept, string_agg(a.m, ',' order by a.m) kept from d a
where not exists (select 1 from d b where b.p_partkey = a.p_partkey and length(b.m) > length(a.m) and contains(lower(b.m), lower(a.m))) group by a.p_partkey""")
def owner_overlap(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    each = F.array_distinct(F.array_compact(F.array("p_type", "p_brand", "p_name", F.split_part("p_name", F.lit(" "), F.lit(1)))))
    tags = F.transform(each, lambda m: F.struct(m.alias("initial"), m.alias("match")))
    kept = F.sort_array(F.transform(tagging.without_overlaps(F.col("tags")), lambda t: t["match"]))
    return p.withColumn("tags", tags).select("p_partkey", F.size(kept).cast("long").alias("n_kept"), F.array_join(kept, ",").alias("kept"))


_WORDS = """list_transform(list_filter(string_split(trim(regexp_replace(lower({0}), '[(].*?[)]', '', 'g')), ' '), lambda x: not starts_with(x, '{1}')), lambda x: translate(x, '|()', ''))"""
_SPELL = "case when len(w) <= 3 then [trim(array_to_string(w, ' ')), array_to_string(w[1:3], ''), array_to_string(w[1:2], '')] else [trim(array_to_string(w, ' '))] end"


@query(f"""with a as (select p_partkey id, p_name || ' (' || p_brand || ') Refinery' initial from part),
f as (select min(id) id, initial from a group by initial), w as (select id, initial, {_WORDS.format('initial', 'refin')} w from f),
m as (select distinct id, initial, unnest({_SPELL}) match from w)
select min(id) id, initial, match from m where match not in ('', 'nan') group by initial, match""")
def name_variants(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("GeoAssetID"), F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") Refinery")).alias("GeoAssetName"))
    return gazetteer.asset_names(a).select("id", "initial", "match")


_TOWN = "case {k} % 4 when 0 then {n} when 1 then {r} || ' Town' when 2 then {n} || ', ' || {b} else {n} || ' (old) Hall' end"


@query(f"""with c as (select p_partkey id, {_TOWN.format(k='p_partkey', n='p_name', r="replace(p_name, ' ', '-')", b='p_brand')} city from part),
s as (select id, city, unnest(list_concat(list_concat([city], case when contains(city, '-') then [trim(regexp_replace(replace(city, '-', ' '), ' +', ' ', 'g'))] else [] end),
  case when contains(city, ',') then list_transform(string_split(city, ','), lambda x: trim(x)) else [] end)) s from c),
w as (select id, city, s, list_transform(string_split(s, ' '), lambda x: translate(trim(x), '|(),', '')) w from s),
m as (select distinct id, city, unnest(case when len(w) <= 3 then [s, array_to_string(w[1:3], ''), array_to_string(w[1:2], '')] else [s] end) match from w)
select id, city as initial, match from m where match not in ('', 'nan')""")
def city_variants(spark, sf_dir):
    n, k = F.col("p_name"), F.col("p_partkey") % 4
    city = F.when(k == 0, n).when(k == 1, F.concat(F.replace(n, F.lit(" "), F.lit("-")), F.lit(" Town"))).when(k == 2, F.concat(n, F.lit(", "), "p_brand")).otherwise(F.concat(n, F.lit(" (old) Hall")))
    return gazetteer.city_names(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("GeoAssetID"), city.alias("City"))).select("id", "initial", "match")


@query(f"""with o as (select distinct s_suppkey id, nullif(s_name, 'Unknown') initial from supplier), w as (select id, initial, {_WORDS.format('initial', chr(1))} w from o where initial is not null),
m as (select distinct id, initial, unnest({_SPELL}) match from w) select id, initial, match from m where match not in ('', 'nan')""")
def owner_clean(spark, sf_dir):
    o = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("GeoAssetID"), F.col("s_name").alias("CompanyName"))
    return gazetteer.owner_names(o).select("id", "initial", "match")


@query("""with w as (select p_partkey, string_split(p_name, ' ') w from part), c as (select p_partkey, list_transform(w, lambda x: upper(x[:1]) || x[2:]) c, w from w),
t as (select p_partkey, case p_partkey % 5 when 0 then array_to_string(c, '') when 1 then w[1] || array_to_string(c[2:], '') when 2 then upper(array_to_string(c, '')) when 3 then c[1] || '1' else array_to_string(c, '') || (p_partkey % 7)::varchar end tag from c),
u as (select *, len(list_filter(string_split(tag, ''), lambda x: x <> '' and x = upper(x))) n from t)
select p_partkey, tag, upper(array_to_string(regexp_extract_all(tag, '[A-Z][^A-Z]*'), ' ')) match from u where tag[:1] = upper(tag[:1]) and n <> 1 and tag <> upper(tag)""")
def hashtag_camel(spark, sf_dir):
    w, k = F.split("p_name", " "), F.col("p_partkey") % 5
    c = F.transform(w, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2))))
    whole = F.array_join(c, "")
    tag = F.when(k == 0, whole).when(k == 1, F.concat(F.get(w, F.lit(0)), F.array_join(F.slice(c, 2, 9), ""))).when(k == 2, F.upper(whole)).when(k == 3, F.concat(F.get(c, F.lit(0)), F.lit("1"))).otherwise(F.concat(whole, (F.col("p_partkey") % 7).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", tag.alias("tag")).select("p_partkey", "tag", X.camel_words(F.col("tag")).alias("match")).where("match is not null")


@query("""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') iso from events""")
def date_normalize(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "EEE MMM dd HH:mm:ss '+0200' yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(X.post_time(raw), "yyyy-MM-dd HH:mm:ss").alias("iso"))


@query("""with k as (select c_custkey n, count(o_orderkey)::bigint k from customer left join orders on o_custkey = c_custkey where c_custkey > 0 group by c_custkey)
select n, k, case when n = 8 then 0.12 else round(1 / n, 2) end::double confidence, round_even(k / n * 100, 0) / 100 share from k""")
def rounding(spark, sf_dir):
    n = table(spark, sf_dir, "customer").where("c_custkey > 0").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy(F.col("c_custkey").alias("n")).agg(F.count("o_orderkey").alias("k"))
    return n.select("n", "k", X.confidence(F.col("n")).alias("confidence"), X.share(F.col("k"), F.col("n")).alias("share"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body for each event: two posts, or one of the ways in which an answer fails."""
    e, k = table(spark, sf_dir, "events"), F.col("user_id") % 6
    one = lambda n, t: F.concat(F.lit('"'), n.cast("string"), F.lit('":{"id":'), n.cast("string"), F.lit(',"full_text":"'), t, F.lit('"}'))
    sound = F.concat(F.lit('{"globalObjects":{"tweets":{'), one(F.col("event_id") * 2, F.col("event_type")), F.lit(","), one(F.col("event_id") * 2 + 1, F.concat("event_type", F.lit(" again"))), F.lit("}}}"))
    return e.select("event_id", F.when(k == 0, "{broken").when(k == 1, '{"globalObjects":{}}').when(k == 2, F.col("props")).otherwise(sound).alias("body"))


@query("""with e as (select event_id, event_type from events where user_id % 6 > 2)
select event_id * 2 id, event_type full_text from e union all select event_id * 2 + 1, event_type || ' again' from e""")
def json_map_explode(spark, sf_dir):
    return files.posts_of(files.scraped(answers(spark, sf_dir))).select("id", "full_text")


@query("""select case when user_id % 6 = 0 then 'json_convert_failed' when user_id % 6 < 3 then 'retry_clean' else 'ok' end status, count(*)::bigint n_pages from events group by 1""")
def json_status(spark, sf_dir):
    return files.scraped(answers(spark, sf_dir)).groupBy("status").agg(F.count("*").alias("n_pages"))


@query("""select json_extract_string(props, '$.k')::bigint k, count(*)::bigint n from events group by 1""")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.from_json("props", "k long")["k"].alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query("""with e as (select distinct event_type as event from events), p as (select distinct p_name plant from part)
select event, plant, '(#' || event || ' AND #' || plant || ') -filter:replies' search, 'q=%28%23' || replace(event, ' ', '+') || '+AND+%23' || replace(plant, ' ', '+') || '%29+-filter%3Areplies' query from e, p""")
def keyword_cross(spark, sf_dir):
    return search.searches(table(spark, sf_dir, "events").select(F.col("event_type").alias("event")).distinct(), table(spark, sf_dir, "part").select(F.col("p_name").alias("plant")).distinct(), True)


@query(f"""select distinct w[1] NORP, w[2] GPE from (select regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') w from documents) where regexp_matches(w[1] || w[2], '^[A-Za-zÀ-ÖØ-öø-ÿ]+$')""")
def peoples_cp1252(spark, sf_dir):
    """Pairs of words through a file whose letters are those of windows-1252."""
    w = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    pairs = table(spark, sf_dir, "documents").select(F.get(w, F.lit(0)).alias("NORP"), F.get(w, F.lit(1)).alias("GPE")).where(F.rlike(F.concat("NORP", "GPE"), F.lit("^[A-Za-zÀ-ÖØ-öø-ÿ]+$"))).distinct()
    path = f"{shared_dir(spark)}/peoples-{uuid.uuid4().hex}"
    pairs.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return files.read_peoples(spark, path).select("NORP", "GPE")


_NORP = [("de", "Germany"), ("fr", "France"), ("es", "Spain")]


@query("""select doc_id, coalesce(m.GPE, d.lang) place from documents d left join (values ('de', 'Germany'), ('fr', 'France'), ('es', 'Spain')) m(NORP, GPE) on d.lang = m.NORP""")
def norp_lookup(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item"), F.col("lang").alias("text"), F.lit("NORP").alias("label"))
    return entities.places(found, spark.createDataFrame(_NORP, "NORP string, GPE string")).select(F.col("item").alias("doc_id"), F.col("match").alias("place"))


@query("""with g(match, label) as (values ('the', 'GPE'), ('que', 'NORP'), ('est', 'NORP'), ('der', 'GPE')), f as (select doc_id, match, label from documents, g where regexp_matches(text, '(?i)\\b' || match || '\\b'))
select distinct doc_id, coalesce(m.GPE, f.match) place from f left join (values ('que', 'Quebec')) m(NORP, GPE) on f.label = 'NORP' and f.match = m.NORP""")
def gazetteer_ner(spark, sf_dir):
    known = spark.createDataFrame([("the", "GPE"), ("que", "NORP"), ("est", "NORP"), ("der", "GPE")], "match string, label string")
    found = entities.by_gazetteer(docs(spark, sf_dir), known, ["text"])
    return entities.places(found, spark.createDataFrame([("que", "Quebec")], "NORP string, GPE string")).select(F.col("item").alias("doc_id"), F.col("match").alias("place")).distinct()


@query("select doc_id, length(c)::bigint n_chars_clean from (select doc_id, array_to_string(list_transform(list_filter(string_split(replace(text, '#', ''), ' '), lambda x: not contains(x, 'http')), lambda x: regexp_replace(x, '[^\\p{L}\\p{N}_\\s]', '', 'g')), ' ') c from documents)")
def text_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length(X.cleaned(F.col("text"))).cast("long").alias("n_chars_clean"))


@query("""with t as (select conv_id, list(distinct lower(role)) tags from conversations group by conv_id) select conv_id from t where len(list_filter(tags, lambda x: contains(x, 'sys'))) > 0""")
def hashtag_any(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("tags"))
    return t.where(F.exists("tags", lambda h: X.substring(h, F.lit("sys")))).select("conv_id")


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(table(spark, sf_dir, "supplier"), path)
    return files.read_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


@query("select min(doc_id) doc_id, lang, source from documents group by lang, source, text")
def dedup_keep_first(spark, sf_dir):
    return gazetteer.keep_first(table(spark, sf_dir, "documents"), ["lang", "source", "text"], [F.col("doc_id")]).select("doc_id", "lang", "source")


@query("""with a as (select 'd' || doc_id id, text, lang as snippet, 0 f from documents union all select 'c' || conv_id || '-' || turn, text, null, 1 from conversations),
r as (select *, row_number() over (partition by text, snippet order by f, id) n from a) select id, snippet, f = 0 as is_document from r where n = 1""")
def merge_items(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text", F.col("lang").alias("snippet"), F.lit(True).alias("is_document"))
    c = table(spark, sf_dir, "conversations").select(F.concat_ws("", F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text", F.lit(False).alias("is_document"))
    return merge.merged(d, c, ("id", "text", "snippet", "is_document"), ("text", "snippet")).select("id", "snippet", "is_document")


@query("""with n as (select o_custkey id, min(o_orderkey) first_order from orders group by o_custkey), t as (select c_custkey id from customer where c_custkey % 3 = 0) select id, first_order from n where id not in (select id from t)""")
def insert_if_absent(spark, sf_dir):
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("first_order"))
    return merge.insert_if_absent(new, table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id")))


@query("""select distinct c_custkey GeoAssetID from customer where c_custkey not in (select o_custkey from orders) union select 1::bigint""")
def anti_new_ids(spark, sf_dir):
    key = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("GeoAssetID"))
    return gazetteer.new_ids(key("customer", "c_custkey"), key("orders", "o_custkey"), spark.range(1, 2).select(F.col("id").alias("GeoAssetID")))


@query("""select n_name as name, r_regionkey::bigint place_id from nation join region on n_regionkey = r_regionkey where r_regionkey <> 2""")
def gpe_semi(spark, sf_dir):
    from emberlane.operators import resolve

    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    square = F.array(F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)), F.array(F.lit(0.0), F.lit(0.0))))
    kind = F.when(F.col("r_regionkey") == 2, "Point").otherwise("Polygon")
    per = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey").agg(F.collect_list("n_name").alias("GPEs"))
    gpes = per.select("GPEs", F.col("r_regionkey").cast("long").alias("place_id"), (F.col("r_regionkey") / 10).alias("importance"), F.struct(kind.alias("type"), square.alias("coordinates")).alias("boundaries"))
    return resolve.known_places(n.select(F.col("n_name").alias("item"), F.col("n_name").alias("name")), gpes).select(F.col("item").alias("name"), F.col("place.place_id").alias("place_id"))


@query("""select s_suppkey, array_to_string(list_distinct_in_order, '|') aliases from (select s_suppkey, case when trim(split_part(d, ',', 1)) = n then [n] else [trim(split_part(d, ',', 1)), n] end list_distinct_in_order
  from (select s_suppkey, s_name || ' , ' || n_name || ', ' || n_name d, case when s_suppkey % 3 = 0 then s_name else n_name end n from supplier join nation on n_nationkey = s_nationkey))""")
def place_aliases(spark, sf_dir):
    from emberlane.sources.geocoding import aliases

    d = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).otherwise(F.col("n_name"))
    return d.select("s_suppkey", F.array_join(aliases(F.concat("s_name", F.lit(" , "), "n_name", F.lit(", "), "n_name"), name), "|").alias("aliases"))


@query("select r_name as region, r_regionkey::bigint as n from region")
def kept_table(spark, sf_dir):
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    build = lambda: table(spark, sf_dir, "region").select(F.col("r_name").alias("region"), F.col("r_regionkey").cast("long").alias("n"))
    files.kept(spark, path, build)
    return files.kept(spark, path, build)
