"""A full-text index: phrases and words are found without reading the texts.

An index is a folder of segments. A segment has
- terms: the dictionary of folded tokens by language, with stem, whether it is a stop
  word, and in how many documents and how often it occurs;
- postings: for each term and document the places of the term, in buckets of term
  ranges (folders b=...), sorted by term and document within, so that a lookup opens
  the buckets of its terms and skips the row groups of others. A posting is a row, so
  a term that every document holds is dealt over files and tasks like any other;
- docs: the documents, with language and number of tokens.

Documents are added, and documents removed, as a new segment each time; which segments
count, in which order, is a state published atomically (sources.versions), so readers
see whole segments only. A document that is added again hides what earlier segments
say of it. compacted() merges all segments into one.

Phrases meet by position: the rarest token of a phrase gives the candidates, the
others' postings are joined by term and document, and the places of the phrase are the
intersection of its tokens' places, each shifted by its offset.

Defined cases: null texts and documents without an id have no tokens; rows that repeat
an id in one batch are one document with the tokens of all; a phrase without tokens is
found nowhere; a null language, or one without a stemmer, keeps tokens as stems and
has no stop words; texts of several columns do not run into each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.functions.stems import tokens, with_stems
from emberlane.session import materialize, ship
from emberlane.sources import versions

BUCKETS = 64  # term ranges of a segment
AT_ONCE = 64  # rows whose tokens a task holds at a time
SAMPLE = 200  # terms a bucket from which the borders are taken
PARTS = {
    "terms": "term string, lang string, stem string, stop boolean, df long, cf long",
    "postings": "term string, lang string, doc string, positions array<int>, b int",
    "docs": "doc string, lang string, n_tokens long, removed boolean",
}


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    path: str
    buckets: int = BUCKETS  # of the segments that it writes

    def segments(self) -> list[dict]:
        return versions.latest(self.spark, self.path)[1].get("segments", [])

    def _read(self, segment: dict, part: str) -> DataFrame:
        return self.spark.read.schema(PARTS[part]).parquet(f"{self.path}/{segment['name']}/{part}")

    def _all(self, part: str) -> DataFrame:
        out = self.spark.createDataFrame([], f"{PARTS[part]}, seg int") if not self.segments() else None
        for i, s in enumerate(self.segments()):
            one = self._read(s, part).withColumn("seg", F.lit(i))
            out = one if out is None else out.unionByName(one)
        return out

    def terms(self) -> DataFrame:
        """term, lang, stem, stop, df, cf: of hidden documents too, until compacted."""
        return self._all("terms").groupBy("term", "lang").agg(F.first("stem").alias("stem"), F.first("stop").alias("stop"), F.sum("df").alias("df"), F.sum("cf").alias("cf"))

    def docs(self) -> DataFrame:
        """doc, lang, n_tokens of what the index holds."""
        return _newest(self._all("docs")).where(~F.col("removed")).select("doc", "lang", "n_tokens")

    def postings(self, asked: DataFrame) -> DataFrame:
        """term, lang, doc, seg, positions of the asked terms (term, lang, and columns
        of their own): only the buckets of these terms are read."""
        out = None
        for i, s in enumerate(self.segments()):
            bucketed = asked.withColumn("_b", bucket_of(F.col("term"), s["borders"]))
            needed = [r["_b"] for r in bucketed.select("_b").distinct().collect()]  # BUCKETS at most
            if needed:
                one = self._read(s, "postings").where(F.col("b").isin(needed)).drop("b").join(asked, ["term", "lang"]).withColumn("seg", F.lit(i))
                out = one if out is None else out.unionByName(one)
        if out is None:
            out = self.spark.createDataFrame([], "term string, lang string, doc string, positions array<int>, seg int").join(asked, ["term", "lang"])
        return out


def bucket_of(term: Column, borders: list[str]) -> Column:
    """Which range of terms: how many borders are not after it."""

    def among(lo: int, hi: int) -> Column:  # by halves: it is asked for every posting
        mid = (lo + hi) // 2
        return F.lit(lo) if lo == hi else F.when(term < F.lit(borders[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))

    return among(0, len(borders))


def _newest(docs: DataFrame) -> DataFrame:
    last = docs.groupBy("doc").agg(F.max("seg").alias("_last"))
    return docs.join(last, "doc").where(F.col("seg") == F.col("_last")).drop("_last")


def _borders(terms: DataFrame, buckets: int) -> list[str]:
    """Of a bounded sample of the distinct terms, those that cut it into buckets."""
    some = sorted(r["term"] for r in terms.select("term").distinct().orderBy(F.xxhash64("term"), "term").limit(buckets * SAMPLE).collect())
    return [some[len(some) * i // buckets] for i in range(1, buckets)] if len(some) >= buckets else some[1:]


def _write(index: Index, postings: DataFrame, docs: DataFrame) -> dict:
    """Writes a segment: postings (term, lang, doc, positions) should be a written table."""
    spark, path = index.spark, index.path
    name = f"segment-{uuid.uuid4().hex}"
    counts = postings.groupBy("term", "lang").agg(F.count("*").alias("df"), F.sum(F.size("positions")).alias("cf"))
    with_stems(counts).select("term", "lang", "stem", "stop", "df", "cf").write.parquet(f"{path}/{name}/terms")
    borders = _borders(spark.read.schema(PARTS["terms"]).parquet(f"{path}/{name}/terms"), index.buckets)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # each bucket over several tasks, by document, so that no term is one task's
    share = F.pmod(F.xxhash64("doc"), F.lit(max(1, -(-4 * parts // (len(borders) + 1)))))
    dealt = postings.withColumn("b", bucket_of(F.col("term"), borders)).repartition(parts, "b", share).sortWithinPartitions("b", "term", "lang", "doc")
    dealt.write.partitionBy("b").parquet(f"{path}/{name}/postings")
    docs.write.parquet(f"{path}/{name}/docs")
    return {"name": name, "borders": borders}


def _add(index: Index, postings: DataFrame, docs: DataFrame) -> Index:
    segment = _write(index, postings, docs)
    versions.commit(index.spark, index.path, lambda s: {"segments": [*s.get("segments", []), segment]})
    return index


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, lang, doc, positions of each row (doc, lang, _tokens) by itself; some rows at a time."""
    for whole in batches:
        for lo in range(0, whole.num_rows, AT_ONCE):
            b = whole.slice(lo, AT_ONCE)
            lists = b.column("_tokens")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            told = lists.flatten().dictionary_encode()
            code = told.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), sizes)
            place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            named = np.array([t != "" for t in told.dictionary.to_pylist()], bool)[code] if len(code) else np.zeros(0, bool)
            row, place, code = row[named], place[named], code[named]
            if len(code):
                order = np.lexsort((place, code, row))
                row, place, code = row[order], place[order], code[order]
                head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])))
                positions = pa.ListArray.from_arrays(pa.array(np.append(head, len(code)), pa.int32()), pa.array(place, pa.int32()))
                of = pa.array(row[head])
                yield pa.RecordBatch.from_arrays([told.dictionary.take(pa.array(code[head])), b.column("lang").take(of), b.column("doc").take(of), positions], ["term", "lang", "doc", "positions"])


def add(index: Index, rows: DataFrame, texts: list[str], key: str = "doc_id", lang: str = "lang") -> Index:
    """Adds documents, or puts new ones in the place of those with the same key. A row's
    postings are found in the row; only those of rows that repeat a key are merged."""
    parts = [tokens(F.col(texts[0]))]
    for c in texts[1:]:
        parts += [F.array(F.lit("")), tokens(F.col(c))]  # no phrase runs past a column's end
    rows = rows.where(F.col(key).isNotNull()).withColumns({"doc": F.col(key).cast("string"), "_lang": F.coalesce(F.col(lang).cast("string"), F.lit(""))})
    ship(index.spark)
    posted = lambda d: d.select("doc", F.col("_lang").alias("lang"), F.concat(*parts).alias("_tokens")).mapInArrow(_posted, "term string, lang string, doc string, positions array<int>")
    twice = materialize(rows.groupBy("doc").count().where("count > 1").select("doc"), "twice")
    if twice.isEmpty():
        postings = posted(rows)
    else:
        merged = posted(rows.join(twice, "doc", "left_semi")).groupBy("term", "lang", "doc").agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))
        postings = posted(rows.join(twice, "doc", "left_anti")).unionByName(merged)
    postings = materialize(postings, "postings")
    # tokens are counted where they were found; a document without any has none
    sizes = postings.groupBy("doc").agg(F.sum(F.size("positions")).cast("long").alias("n_tokens"))
    docs = rows.groupBy("doc").agg(F.first("_lang").alias("lang")).join(sizes, "doc", "left").select("doc", "lang", F.coalesce("n_tokens", F.lit(0).cast("long")).alias("n_tokens"), F.lit(False).alias("removed"))
    return _add(index, postings, docs)


def remove(index: Index, keys: DataFrame, key: str = "doc_id") -> Index:
    """Hides documents: a segment without postings."""
    gone = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("doc")).distinct()
    docs = gone.select("doc", F.lit("").alias("lang"), F.lit(0).cast("long").alias("n_tokens"), F.lit(True).alias("removed"))
    none = index.spark.createDataFrame([], "term string, lang string, doc string, positions array<int>")
    return _add(index, none, docs)


def compacted(index: Index) -> Index:
    """Merges the segments there are into one, without what is hidden; segments added
    meanwhile stay after it."""
    old = index.segments()
    if len(old) < 2:
        return index
    docs = materialize(_newest(index._all("docs")).where(~F.col("removed")), "index-docs")
    hidden = index._all("docs").select("doc", "seg").join(docs.select("doc", "seg"), ["doc", "seg"], "left_anti")
    live = index._all("postings").join(materialize(hidden, "hidden"), ["doc", "seg"], "left_anti").select("term", "lang", "doc", "positions")
    segment = _write(index, materialize(live, "postings"), docs.drop("seg"))
    names = [s["name"] for s in old]

    def change(state: dict) -> dict | None:
        now = state["segments"]
        return {"segments": [segment, *now[len(old) :]]} if [s["name"] for s in now[: len(old)]] == names else None

    versions.commit(index.spark, index.path, change)
    return index


def _visible(index: Index, found: DataFrame) -> DataFrame:
    """Of what was found (query, doc, seg), what no later segment hides."""
    if len(index.segments()) < 2:
        return found.drop("seg")
    seen = found.select("doc").distinct().join(index._all("docs").select("doc", F.col("seg").alias("_s")), "doc").groupBy("doc").agg(F.max("_s").alias("seg"))
    return found.join(seen, ["doc", "seg"]).drop("seg")


def _asked(queries: DataFrame) -> DataFrame:
    """query, size, off, token, lang of every token."""
    listed = queries.select("query", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), tokens(F.col("phrase")).alias("_t"))
    return listed.select("query", "lang", F.size("_t").alias("size"), F.posexplode("_t").alias("off", "token"))


def _matching(index: Index, asked: DataFrame, stemmed: bool) -> DataFrame:
    """query, size, off, term, lang, df: the terms that stand for each asked token."""
    terms = index.terms()
    if stemmed:
        return with_stems(asked, "token").drop("stop").join(terms, ["stem", "lang"]).select("query", "size", "off", "term", "lang", "df")
    return asked.drop("lang").join(terms, asked["token"] == terms["term"]).select("query", "size", "off", "term", "lang", "df")


def phrases(index: Index, queries: DataFrame, stemmed: bool = False) -> DataFrame:
    """query, doc, n, starts: the documents that hold a phrase, how often, and where.
    queries: query (unique), phrase, lang. stemmed: tokens count as equal by stem, in
    documents of the query's language; else past case and accents, in any."""
    wanted = materialize(_matching(index, _asked(queries), stemmed), "asked")
    # the rarest token of each query gives the candidates; a token not in the dictionary rules its query out
    per = wanted.groupBy("query", "size", "off").agg(F.sum("df").alias("df"))
    rare = per.groupBy("query", "size").agg(F.count("*").alias("known"), F.min_by("off", F.struct("df", "off")).alias("off")).where("known = size").select("query", "off")
    first = wanted.join(rare, ["query", "off"]).select("query", "term", "lang")
    candidates = materialize(_visible(index, index.postings(first).select("query", "doc", "seg", F.lit(True).alias("_")).distinct().drop("_")), "candidates")
    found = index.postings(wanted.select("query", "size", "off", "term", "lang")).join(candidates, ["query", "doc"])
    per_doc = _visible(index, found.groupBy("query", "doc", "seg").agg(F.first("size").alias("size"), F.collect_list(F.struct("off", "positions")).alias("_c")))
    at = lambda o: F.flatten(F.transform(F.filter("_c", lambda x: x["off"] == o), lambda x: F.transform(x["positions"], lambda p: p - o)))
    starts = F.aggregate(F.sequence(F.lit(1), F.col("size")), at(F.lit(0)), lambda a, o: F.when(o < F.col("size"), F.array_intersect(a, at(o))).otherwise(a))
    return per_doc.select("query", "doc", F.sort_array(F.array_distinct(starts)).alias("starts")).where(F.size("starts") > 0).select("query", "doc", F.size("starts").cast("long").alias("n"), "starts")


def search(index: Index, queries: DataFrame, every: bool = True) -> DataFrame:
    """query, doc, n_terms, tf: documents of the query's language with all (or any) of
    the words of a query, by stem, stop words aside: how many of them, and how often
    they occur together."""
    meant = with_stems(_asked(queries), "token").where("not stop").select("query", "lang", "stem").distinct()
    sizes = meant.groupBy("query").agg(F.count("*").alias("size"))
    wanted = materialize(meant.join(index.terms().where("not stop"), ["stem", "lang"]).join(sizes, "query").select("query", "size", "stem", "term", "lang"), "asked")
    hits = index.postings(wanted).groupBy("query", "size", "doc", "seg", "stem").agg(F.sum(F.size("positions")).alias("tf"))
    per = _visible(index, hits.groupBy("query", "size", "doc", "seg").agg(F.count("*").alias("n_terms"), F.sum("tf").cast("long").alias("tf")))
    return per.where("n_terms = size" if every else "true").select("query", "doc", "n_terms", "tf")


def name_tags(index: Index, names: DataFrame) -> DataFrame:
    """(item, names' columns) of the documents that hold a name (match) as a phrase:
    tags from the index, where tagging.refname_tags() reads the texts."""
    asked = names.select(F.struct(*names.columns).alias("query"), F.col("match").alias("phrase"), F.lit(None).cast("string").alias("lang")).distinct()
    return phrases(index, asked).select(F.col("doc").alias("item"), "query.*")
