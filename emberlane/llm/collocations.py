"""Phrase collocation mining over word-id suffix arrays.

A shard is some SHARD bytes of whole texts. Its words are numbered, by language, and
all places of its pieces are sorted by the words from there on, by prefix doubling.
Neighbours in that order share their first LCP words; the places between two falls of
the LCP below n are the occurrences of one n-gram, so a shard gives each of its n-grams
once, with its count, and Spark adds the counts up by key.

A phrase is no more frequent than its words and pairs of words, so the texts are read
three times. First shards give their words and pairs, then the phrases of three and
more words all of whose pairs may be frequent: by hash, packed in arrays, a bucket and
32 bits each. Which of these reach LEAST in all is told to the tasks by Bloom filters of
BITS_EACH bits a hash and at most MOST_BITS, however many there are. At last shards give
the phrases that pass the filters as strings; these meet by language and string, and
their counts are exact. Hashes that collide, and a filter that is full, let more phrases
be counted; the exact count drops them, so results do not depend on either.

A phrase's parts are joined by value, and parts that very many phrases share do not
gather (heavy_join). The rank is taken in SALTS groups of phrases first, so no task
sorts a language.

Defined cases: a null or empty text has no words; a null lang is und; repeated rows
count as often as they occur; doc_id is not read; ties end at the phrase, which is
unique in its language; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlane.llm.common import heavy_join, let_go, map_arrow, materialize, mix64, slices, utf8, whole_groups
from emberlane.llm.textarrays import LOWER, Words, signs, suffix_order, words_of

LEAST, TOP, LONGEST = 30, 2000, 4
INSIDE_PERCENT = 80
SHARD, CHUNK = 8 << 20, 1 << 20
BUCKETS = 4  # per shuffle partition
MOST_BITS = 28  # of a Bloom filter: 32 MB
BITS_EACH, PROBES = 16, 4
SALTS = 256
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
OUTSIDE = BREAK.copy()
OUTSIDE[[9, 32]] = True
_FOLD = np.uint64(0x9FB21C651E98DF25)


def folded(word: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each place on, but for the last n - 1 places."""
    g = word[: max(len(word) - n + 1, 0)]
    for j in range(1, n):
        g = mix64(g * _FOLD + word[j : len(word) - n + 1 + j])
    return g


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: int, table: np.ndarray):
        self.shift, self.table = np.uint64(64 - bits), table

    def places(self, h: np.ndarray, probe: int) -> np.ndarray:
        step = mix64(h ^ _FOLD) | np.uint64(1)
        return (h + step * np.uint64(probe)) >> self.shift

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        at = np.arange(len(h))
        for probe in range(PROBES):
            p = self.places(h[at], probe)
            there = (self.table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0
            out[at[~there]] = False
            at = at[there]
        return out


def _numbered(data: np.ndarray, w: Words, word: np.ndarray) -> np.ndarray:
    """Dense numbers of words, equal for equal words of one language."""
    _, first, ids = np.unique(word, return_index=True, return_inverse=True)
    s = signs(data, w)
    if (s != s[first][ids]).any():  # two words share a hash: go by the bytes
        raw = data.tobytes()
        number: dict[tuple[int, bytes], int] = {}
        ids = np.array([number.setdefault((h, raw[a:z]), len(number)) for h, a, z in zip(ids.tolist(), w.start.tolist(), w.end.tolist())], np.int64)
    return ids


def phrases(data: np.ndarray, w: Words, at: np.ndarray, n: int) -> pa.Array:
    """The n words from each place on, joined by spaces."""
    word = (at[:, None] + np.arange(n)).ravel()
    size = w.end[word] - w.start[word] + 1
    to = np.cumsum(size) - size
    out = data[np.minimum(np.repeat(w.start[word] - to, size) + np.arange(size.sum()), len(data) - 1)]
    out[to + size - 1] = 32
    # the space after a phrase's last word stays between phrases
    whole = size.reshape(-1, n).sum(1)
    offsets = np.concatenate([[0], np.cumsum(whole - 1)]).astype(np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(whole) - 1] = False
    return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[keep].tobytes())])


def ngrams(ids: np.ndarray, end: np.ndarray, levels: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """n, a place of each n-gram, and how often it occurs, from the intervals of the LCP."""
    order = suffix_order(ids, end, max(levels))
    size = end[order] - order
    same = np.zeros(len(order), bool)  # as the one before, in its first n words
    for n in range(1, max(levels) + 1):
        long = size >= n
        there = np.minimum(order + n - 1, len(ids) - 1)
        agree = np.zeros(len(order), bool)
        agree[1:] = long[1:] & long[:-1] & (ids[there[1:]] == ids[there[:-1]])
        same = agree if n == 1 else same & agree
        if n in levels:
            at = np.flatnonzero(long)
            head = np.flatnonzero(~same[at])
            yield n, order[at[head]], np.diff(np.append(head, len(at)))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= SHARD:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """words_of(), some texts at a time, as hashing takes many times a text's size."""
    parts, base = [], 0
    for a, z in slices(np.diff(offsets), CHUNK):
        w = words_of(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a], OUTSIDE)
        parts.append((w.hash, w.start + offsets[a], w.end + offsets[a], w.first[:-1] + base))
        base += len(w.hash)
    hash_, start, end, first = (np.concatenate(x) for x in zip(*parts))
    return Words(hash_, start, end, np.append(first, base))


class Shard:
    """Words of some texts by language: linked where they follow each other in a piece."""

    def __init__(self, lang: pa.Array, salt: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.lang, self.data, self.w = lang, data, _words(data, offsets)
        self.doc = np.repeat(np.arange(len(salt)), np.diff(self.w.first))
        self.word = mix64(self.w.hash + salt[self.doc] * _FOLD)
        piece = np.cumsum(BREAK[data], dtype=np.int32)[self.w.start]
        self.linked = (self.doc[1:] == self.doc[:-1]) & (piece[1:] == piece[:-1])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for t in _tables(batches):
        lang, salt = t.column("lang").combine_chunks(), t.column("lh").to_numpy().view(np.uint64)
        data, offsets = utf8(t.column("text"))
        for a, z in slices(np.diff(offsets), SHARD):
            s = Shard(lang.slice(a, z - a), salt[a:z], LOWER[data[offsets[a] : offsets[z]]], offsets[a : z + 1] - offsets[a])
            if len(s.word):
                yield s


def short(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """What is sent of a hash: its bucket, and 32 bits."""
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), h.astype(np.uint32)


def joined(bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
    return mix64((bucket.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64))


def _grams(s: Shard, levels: tuple[int, ...], buckets: int, known: dict[int, Filter]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """n, a place, the hash and the count of each n-gram of a shard that the filters
    know; of those of over two words, whose pairs the filter of pairs knows."""
    holds = lambda n, h: known[n].holds(joined(*short(h, buckets)))
    linked = s.linked.copy()
    if 2 in known:
        linked[linked] = holds(2, folded(s.word, 2)[linked])
    head = np.flatnonzero(np.append(True, ~linked))
    size = np.diff(np.append(head, len(s.word)))
    keep = np.repeat(size >= max(levels[0], 2), size)
    if levels[0] == 1:  # words by themselves
        alone = ~keep
        keep[alone] = holds(1, s.word[alone]) if 1 in known else True
    at = np.flatnonzero(keep)
    if not len(at):
        return
    size = size[keep[head]]
    ids = _numbered(s.data, Words(s.w.hash[at], s.w.start[at], s.w.end[at], s.w.first), s.word[at])
    for n, place, count in ngrams(ids, np.repeat(np.cumsum(size), size), levels):
        p = at[place]
        h = folded(s.word, n)[p]
        if n in known:
            there = holds(n, h)
            p, h, count = p[there], h[there], count[there]
        yield n, p, h, count


_HASHED = "bucket int, n int, keys array<int>, counts array<int>"


def _hashed(levels: tuple[int, ...], buckets: int, sent):
    """Hashes of the n-grams of each shard, with their counts, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: Filter(*x) for n, x in sent.value.items()}
        for s in _shards(batches):
            for n, _, h, count in _grams(s, levels, buckets, known):
                bucket, key = short(h, buckets)
                order = np.lexsort((key, bucket))
                some, starts = np.unique(bucket[order], return_index=True)
                ends = pa.array(np.append(starts, len(order)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (key[order].view(np.int32), count[order].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), n, np.int32)), *lists], ["bucket", "n", "keys", "counts"])

    return run


def _reaching(least: int):
    """Hashes of a bucket whose counts reach least in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "bucket", "n"):
            bucket, n = t.column("bucket").to_numpy(), t.column("n").to_numpy()
            head = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (n[1:] != n[:-1])))
            for a, z in zip(head.tolist(), np.append(head[1:], len(bucket)).tolist()):
                keys, counts = (t.column(c).slice(a, z - a).combine_chunks().flatten().to_numpy() for c in ("keys", "counts"))
                order = np.argsort(keys)
                keys, counts = keys[order], counts[order].astype(np.int64)
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[: len(keys)]
                many = first[np.add.reduceat(counts, first) >= least] if len(keys) else first
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(many), n[a], np.int32)), pa.array(np.full(len(many), bucket[a], np.int32)), pa.array(keys[many])], ["n", "bucket", "key"])

    return run


_COUNTED = "lang string, n int, phrase string, c long"


def _counts(buckets: int, sent):
    """Phrases of each shard that may be frequent, with their counts, and (n = 0) its
    numbers of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: Filter(*x) for n, x in sent.value.items()}
        for s in _shards(batches):
            told, n = np.unique(s.doc, return_counts=True)
            yield pa.RecordBatch.from_arrays([s.lang.take(pa.array(told)), pa.array(np.zeros(len(told), np.int32)), pa.array([""] * len(told)), pa.array(n)], ["lang", "n", "phrase", "c"])
            for n, place, _, count in _grams(s, tuple(range(1, LONGEST + 1)), buckets, known):
                for lo in range(0, len(place), 50_000):
                    p = place[lo : lo + 50_000]
                    yield pa.RecordBatch.from_arrays([s.lang.take(pa.array(s.doc[p])), pa.array(np.full(len(p), n, np.int32)), phrases(s.data, s.w, p, n), pa.array(count[lo : lo + 50_000])], ["lang", "n", "phrase", "c"])

    return run


def filter_of(hashes: DataFrame) -> tuple[int, np.ndarray]:
    """A filter of hashes (bucket, key): its size is bounded."""
    bits = min(max(10, (BITS_EACH * max(hashes.count(), 1) - 1).bit_length()), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filter(bits, np.zeros(0, np.uint64))
        for b in batches:
            h = joined(b.column("bucket").to_numpy(), b.column("key").to_numpy().view(np.uint32))
            p = np.unique(np.concatenate([f.places(h, i) for i in range(PROBES)]))
            at = p >> np.uint64(6)
            head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))[: len(at)]
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at[head].view(np.int64)), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), head).view(np.int64))], ["at", "bits"])

    told = map_arrow(hashes.select("bucket", "key"), run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[told.column("at").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
    return bits, table


def frequencies(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, n, phrase, c: all phrases of one to LONGEST words that occur least times
    at least, and with n = 0 the number of all words of a language."""
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.where("text is not null").select(name.alias("lang"), F.xxhash64(name).alias("lh"), "text")
    buckets = n_parts * BUCKETS
    known: dict[int, tuple[int, np.ndarray]] = {}
    for levels in ((1, 2), tuple(range(3, LONGEST + 1))):
        packed = map_arrow(texts, _hashed(levels, buckets, spark.sparkContext.broadcast(dict(known))), _HASHED).repartition(n_parts, "bucket").sortWithinPartitions("bucket", "n")
        reached = materialize(map_arrow(packed, _reaching(least), "n int, bucket int, key int"), "phrase-hashes")
        let_go(spark)
        known |= {n: filter_of(reached.where(f"n = {n}")) for n in levels}
    counted = map_arrow(texts, _counts(buckets, spark.sparkContext.broadcast(known)), _COUNTED).groupBy("lang", "n", "phrase").agg(F.sum("c").alias("c"))
    out = materialize(counted.where((F.col("c") >= least) | (F.col("n") == 0)), "phrases")
    let_go(spark)
    return out


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("w", first, n), " ")


def _key(phrase: Column) -> Column:
    """lang and phrase as one value; phrases hold no newline."""
    return F.concat(phrase, F.lit("\n"), "lang")


def scored(freq: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every candidate that no longer one covers."""
    spark = freq.sparkSession
    words = freq.where("n >= 2").select("lang", "phrase", F.col("n").alias("size"), F.col("c").alias("a"), F.split("phrase", " ").alias("w"))
    # both sides of every cut
    cut = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.array(F.struct(k.alias("k"), F.lit(True).alias("left"), _part(F.lit(1), k).alias("part")), F.struct(k.alias("k"), F.lit(False).alias("left"), _part(k + 1, F.col("size") - k).alias("part"))),
    )
    sides = materialize(words.select("lang", "phrase", "a", F.inline(F.flatten(cut))).withColumn("part", _key(F.col("part"))), "phrase-parts")
    asked = sides.groupBy("part").agg(F.count("*").alias("asked"))
    known = materialize(asked.join(freq.where("n >= 1").select(_key(F.col("phrase")).alias("part"), F.col("c").alias("f")), "part"), "phrase-known")
    met = heavy_join(sides, known, "part", "asked", sides.count())
    cuts = met.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.collect_list(F.struct("k", "left", "f")).alias("cuts"))  # six at most

    def side(k: Column, left: bool) -> Column:
        return F.get(F.filter("cuts", lambda x: (x["k"] == k) & (x["left"] == left)), F.lit(0))["f"]

    def priced(k: Column) -> Column:
        return F.struct(k.alias("k"), side(k, True).alias("l"), side(k, False).alias("r"))

    each = cuts.select("lang", "phrase", "a", F.explode(F.transform(F.sequence(F.lit(1), F.array_max(F.transform("cuts", lambda x: x["k"]))), priced)).alias("cut")).select("lang", "phrase", "a", "cut.*")
    exact = each.withColumn("score", F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"))
    best = exact.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    # a candidate goes if a longer one that holds it is nearly as frequent
    shorter = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: _part(i, m))))
    held = words.where("size > 2").select("lang", F.explode(shorter).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    free = materialize(best.join(held, ["lang", "phrase"], "left").where(F.expr(f"around is null or cast(around as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {INSIDE_PERCENT}")).drop("around"), "phrase-free")
    totals = materialize(freq.where("n = 0").select("lang", F.col("c").alias("n")), "phrase-totals")
    per_lang = materialize(free.groupBy("lang").agg(F.count("*").alias("size")).join(totals, "lang"), "phrase-langs")
    total = free.count()
    let_go(spark)
    return heavy_join(free, per_lang, "lang", "size", total).select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first top phrases of each language."""
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored(frequencies(docs, least)).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best_first))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
with p as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) x from documents),
w as (select lang, regexp_extract_all(x, '[^\x20\x09]+') w from p),
g as (select lang, k, w[i:i + k - 1] g from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from w, (select unnest([1, 2, 3, 4]) k))),
f as (select lang, k, g, count(*) c from g group by all),
t as (select lang, sum(c)::bigint n from f where k = 1 group by lang),
s as (select a.lang, a.g, a.c a, i, l.c l, r.c r, (2000000::hugeint * a.c) // (l.c + r.c) s from (select *, unnest(range(1, k)) i from f where k >= 2 and c >= {LEAST}) a join f l on l.lang = a.lang and l.g = a.g[:i] join f r on r.lang = a.lang and r.g = a.g[i + 1:]),
b as (select * from s qualify row_number() over (partition by lang, g order by s, i) = 1),
o as (select lang, g[i:i + m - 1] g, max(c) c from (select *, unnest(range(1, k - m + 2)) i from (select *, unnest(range(2, k)) m from f where k > 2 and c >= {LEAST})) group by all),
x as (select b.*, array_to_string(b.g, ' ') phrase from b left join o using (lang, g) where o.c is null or 100 * o.c < {INSIDE_PERCENT} * b.a)
select lang, row_number() over (partition by lang order by s desc, a desc, phrase)::bigint rank, phrase, a, l, r, n, s::bigint score from x join t using (lang) qualify rank <= {TOP}"""
