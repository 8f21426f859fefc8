"""Queries on what is looked up by index: full text and large gazetteers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.functions.stems import STEMMERS, stem_sql, stop_sql, tokens
from emberlane.operators import entities, fulltext, tagger, tagging
from emberlane.plans.catalog import query, table
from emberlane.plans.items import docs
from emberlane.session import materialize, shared_dir


def indexed(spark: SparkSession, sf_dir: str) -> fulltext.Index:
    """All documents, in increments: the English ones, then the others, and the French
    ones again in the place of themselves."""
    index = fulltext.Index(spark, f"{shared_dir(spark)}/text-{uuid.uuid4().hex}", 16)
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    fulltext.add(index, d.where("lang <=> 'en'"), ["text"])
    fulltext.add(index, d.where("not lang <=> 'en'"), ["text"])
    return fulltext.add(index, d.where("lang = 'fr'"), ["text"])


_FOLDED = "regexp_extract_all(lower(strip_accents({0})), '[\\p{{L}}\\p{{N}}_]+')"
_TOKENS = f"d as (select doc_id, coalesce(lang, '') lang, {_FOLDED.format('text')} w from documents)"


@query(f"""with {_TOKENS}, e as (select doc_id, lang, unnest(w) term from d), c as (select term, lang, count(distinct doc_id)::bigint df, count(*)::bigint cf from e group by all)
select term, lang, {stem_sql('term', 'lang')} stem, {stop_sql('term', 'lang')} stop, df, cf from c""")
def text_terms(spark, sf_dir):
    return fulltext.compacted(indexed(spark, sf_dir)).terms()


def _openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three words of every benchmark item."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query"), F.array_join(F.slice(tokens(F.col("text")), 1, 3), " ").alias("phrase"), F.lit(None).cast("string").alias("lang"))


_PHRASE = f"""with {_TOKENS}, q as (select item_id, {_FOLDED.format('text')}[1:3] q from benchmark), t as (select doc_id, w, unnest(range(1, len(w) + 1)) i from d)
select item_id, doc_id, count(*)::bigint n from q join t on w[i] = q[1] and w[i + 1] = q[2] and w[i + 2] = q[3] group by all"""


@query(_PHRASE)
def text_phrase(spark, sf_dir):
    found = fulltext.phrases(indexed(spark, sf_dir), _openings(spark, sf_dir))
    return found.select(F.col("query").alias("item_id"), F.col("doc").cast("long").alias("doc_id"), "n")


_SEARCH = f"""with {_TOKENS}, l as (select unnest(['{"', '".join(STEMMERS)}']) lang), i as (select item_id, {_FOLDED.format('text')}[1:4] w from benchmark),
u as (select distinct lang, term from (select lang, unnest(w) term from d union all select lang, unnest(w) from i, l)),
s as (select lang, term, {stem_sql('term', 'lang')} stem, {stop_sql('term', 'lang')} stop from u),
q as (select distinct item_id, lang, stem from (select item_id, lang, unnest(w) term from i, l) join s using (lang, term) where not stop),
n as (select item_id, lang, count(*) size from q group by all),
e as (select doc_id, lang, stem, count(*) tf from (select doc_id, lang, unnest(w) term from d) join s using (lang, term) where not stop group by all)
select item_id, lang, doc_id, count(*)::bigint n_terms, sum(tf)::bigint tf from q join e using (lang, stem) join n using (item_id, lang) group by item_id, lang, doc_id, size having count(*) = size"""


@query(_SEARCH)
def text_search(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").withColumn("lang", F.explode(F.array(*[F.lit(x) for x in STEMMERS])))
    q = b.select(F.struct("item_id", "lang").alias("query"), F.array_join(F.slice(tokens(F.col("text")), 1, 4), " ").alias("phrase"), "lang")
    found = fulltext.search(indexed(spark, sf_dir), q)
    return found.select("query.item_id", "query.lang", F.col("doc").cast("long").alias("doc_id"), "n_terms", "tf")


_WORDS = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"


@query(f"""with n as (select p_name match from part union select c_name from customer union select s_name from supplier union select array_to_string({_WORDS}[2:3], ' ') from documents where len({_WORDS}) > 2),
d as (select doc_id, lower(text) t from documents where text is not null), m as (select match, lower(match) low from n)
select doc_id, count(*)::bigint n_names, sum(length(match))::bigint n_chars, min(match) as first, max(match) as last from d join m on contains(t, low) group by doc_id""")
def large_gazetteer(spark, sf_dir):
    w = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    titles = table(spark, sf_dir, "documents").where(F.size(w) > 2).select(F.array_join(F.slice(w, 2, 2), " ").alias("match"))
    names = titles
    for t, c in (("part", "p_name"), ("customer", "c_name"), ("supplier", "s_name")):
        names = names.unionByName(table(spark, sf_dir, t).select(F.col(c).alias("match")))
    found = tagging.contained(docs(spark, sf_dir), names.distinct(), ["text"])
    return found.groupBy(F.col("item").alias("doc_id")).agg(F.count("*").alias("n_names"), F.sum(F.length("match")).alias("n_chars"), F.min("match").alias("first"), F.max("match").alias("last"))


@query()
def ner_tagger(spark, sf_dir):
    """A tagger that knows half of the words with two endings by name, on all
    documents: how many of all such words it finds, and of what it finds are such."""
    labels, ends = ("GPE", "NORP"), ("tion", "ment")
    items = docs(spark, sf_dir)
    names = materialize(_ending(items, labels, ends), "ending")
    told = tagger.labelled(items, names.where(F.xxhash64("match") % 2 == 0), labels, False)
    sure = told.where(~F.exists(F.arrays_zip("words", "tags"), lambda x: (x["tags"] == 0) & F.rlike(F.lower(x["words"]), F.lit(f"({'|'.join(ends)})$"))))
    found = entities.by_tagger(items, tagger.fit(tagger.sample(sure), labels))
    every = tagger.named(items, names, labels)
    gold = every.select(F.col("item").cast("long").alias("item"), F.col("word").alias("text"), F.when(F.col("tag") == 1, labels[0]).otherwise(labels[1]).alias("label")).distinct()
    return tagger.agreement(found, gold).select("label", "n_found", "n_known", "n_both", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"))


def _ending(items: DataFrame, labels: tuple[str, ...], ends: tuple[str, ...]) -> DataFrame:
    """match, label: the distinct words with either ending."""
    w = items.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\w+)"), F.lit(1))).alias("match")).distinct()
    label = F.when(F.col("match").endswith(ends[0]), labels[0]).when(F.col("match").endswith(ends[1]), labels[1])
    return w.where(F.length("match") > 4).withColumn("label", label).where("label is not null")
