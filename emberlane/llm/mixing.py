"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions alone.

Sizes are words. Sources share the total by weight; no target exceeds MAX_REPEATS
times its source. A source gives whole copies of all its documents as often as
the target holds them, and the rest of its budget goes to the documents of the
smallest keyed hashes: sums by source and hash bucket show the bucket in which
the budget ends, and only that bucket's rows are kept and summed again by the next
digits, until the digits are used up. Nothing is sorted but the sums of one source's
buckets, and the sources themselves, by ranges.

The hash is of doc_id and text, so what shares one of them is still told apart; its
last digits are of the row's place in the input, which only counts among rows that
are equal in both. (Reruns over the same files agree; equal rows cannot be told.)

Defined cases: a null text has size 0 and hashes as empty; a null source is a source
of its own, after all others; a null doc_id hashes as such; with no words at all
every target is 0; an empty table gives an empty result; other columns are left out,
or (mixed_documents) returned as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlane.llm.common import heavy_join, materialize, n_words

WEIGHTS = (5, 2, 1)  # dealt to the sources in order, again and again
MAX_REPEATS = 3
DIGITS, LEVELS, TIES = 3, 4, 2  # hexadecimal digits of the hash per level: 4,096 buckets each; levels of it, and of the place


def hashed(doc_id: Column, text: Column, seed: str) -> Column:
    """DIGITS * LEVELS hexadecimal digits of doc_id and text, and DIGITS * TIES of the
    row's place, as text; text order is number order."""
    whole = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))
    place = F.md5(F.monotonically_increasing_id().cast("string").cast("binary"))
    return F.concat(F.substring(F.md5(whole.cast("binary")), 1, DIGITS * LEVELS), F.substring(place, 1, DIGITS * TIES))


def key_of(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def along(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with sums over all rows before a row in an order of the whole table: rows are
    dealt by ranges, and only each range's totals are added up in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "mix-order")
    whole = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_{k}") for k, c in sums.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select("_range", *[F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_{k}") for k in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(F.broadcast(offsets), "_range")  # a row per partition of the shuffle
    return joined.withColumns({k: F.col(f"_{k}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for k, c in sums.items()}).drop("_range", *[f"_{k}" for k in sums])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """skey, source_size, target, docs (rows of the source). Sources that reach their
    cap are those of the least capacity per weight; the share per weight of the others
    is the largest of what is left over per weight left, taken along that order."""
    per = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    nth = along(per, [F.col("source").asc_nulls_last()], {"nth": F.lit(1)}).withColumn("nth", F.pmod("nth", F.lit(len(weights))))
    weighed = nth.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("nth") + 1).cast("int")))
    weighed = weighed.withColumn("cap", max_repeats * F.col("source_size"))
    ordered = materialize(along(weighed, [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()], {"_caps": F.col("cap"), "_weights": F.col("weight")}), "mix-caps")
    total = ordered.agg(F.sum("source_size").alias("_size"), F.sum("weight").alias("_weight"))
    share = (F.col("_size") - F.col("_caps")) / (F.col("_weight") - F.col("_weights"))
    best = ordered.crossJoin(F.broadcast(total)).agg(F.max(share).alias("_share"))  # one row each
    return ordered.crossJoin(F.broadcast(best)).select("skey", "source_size", F.least(F.col("cap").cast("double"), F.col("_share") * F.col("weight")).alias("target"), "docs")


def thresholds(sizes: DataFrame, per_source: DataFrame) -> DataFrame:
    """per_source with copies (whole ones of every document) and upto: documents
    of a smaller hash are taken once more, and of that one if take_last. upto is ''
    if none is."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = per_source.select(
        "skey", "docs", F.struct("source_size", "target").alias("s"), copies.alias("copies"),
        (F.col("target") - copies * F.col("source_size")).alias("budget"), F.lit("").alias("upto"), F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("bucket_size"),
    )
    inside = sizes.where("size > 0").select("skey", "hash", "size")
    for level in range(1, LEVELS + TIES + 1):
        state = materialize(state, "mix-state")  # a row per source; read several times below
        if level > 1:  # only rows of the bucket in which the budget ends; it is some 4,096th of them
            upto = state.select("skey", "docs", F.col("upto").alias("_upto"))
            met = heavy_join(inside, upto, "skey", "docs", inside.count()).where("startswith(hash, _upto)").drop("_upto")
            inside = materialize(met, "mix-bucket")
        sums = inside.groupBy("skey", F.substring("hash", 1, DIGITS * level).alias("bucket")).agg(F.sum("size").alias("n"))
        joined = sums.join(state.select("skey", "budget", "below"), "skey")  # at most 4,096 rows of a source
        upto_here = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        rank = joined.withColumn("_below", F.col("below") + F.coalesce(F.sum("n").over(upto_here), F.lit(0)))
        # the last bucket that begins within the budget is where the budget ends
        reached = rank.where(F.col("_below") <= F.col("budget")).groupBy("skey").agg(F.max_by(F.struct("bucket", "_below", "n"), F.col("bucket")).alias("at"))
        state = state.join(reached, "skey", "left").select(
            "skey", "docs", "s", "copies", "budget", F.coalesce("at.bucket", "upto").alias("upto"), F.coalesce("at._below", "below").alias("below"), F.coalesce("at.n", "bucket_size").alias("bucket_size")
        )
    state = materialize(state, "mix-state")
    # the documents of the last hash go in if that comes nearer to the budget
    take_last = (F.col("bucket_size") > 0) & (F.col("below") + F.col("bucket_size") - F.col("budget") < F.col("budget") - F.col("below"))
    return state.select("skey", "docs", "s.*", "copies", "upto", take_last.alias("take_last"))


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, skey, size and hash, kept in the shared folder: the text is read once."""
    return materialize(docs.select("doc_id", "source", key_of(F.col("source")).alias("skey"), n_words(F.col("text")).alias("size"), hashed(F.col("doc_id"), F.col("text"), seed).alias("hash")), "mix-sizes")


def repeats(hash_: Column) -> Column:
    more = (hash_ < F.col("upto")) | ((hash_ == F.col("upto")) & F.col("take_last"))
    return F.least(F.col("copies") + F.when(more, 1).otherwise(0), F.lit(MAX_REPEATS))


def mixed(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken, and repeats (copies in the mix)."""
    sizes = sized(docs, seed)
    joined = heavy_join(sizes, thresholds(sizes, targets(sizes)), "skey", "docs", sizes.count())
    taken = repeats(F.col("hash")).cast("long")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * taken).alias("taken"), taken.alias("repeats"), "source")


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    return mixed(docs, seed).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    sizes = sized(docs, seed)
    per = thresholds(sizes, targets(sizes)).select("skey", "docs", "copies", "upto", "take_last")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key_of(F.col("source")).alias("skey"), hashed(F.col("doc_id"), F.col("text"), seed).alias("hash"))
    each = heavy_join(packed, per, "skey", "docs", sizes.count()).withColumn("copy", F.explode(F.array_repeat(F.lit(0), repeats(F.col("hash")).cast("int"))))
    return each.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


SQL = f"""
with d as (select doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::bigint size,
  substr(md5('mix:' || coalesce(doc_id::varchar, 'null') || ':' || coalesce(text, '')), 1, {DIGITS * LEVELS}) hash from documents),
p as (select source, sum(size)::bigint source_size from d group by source),
w as (select *, [{', '.join(map(str, WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] weight, {MAX_REPEATS} * source_size cap from p),
a as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
  / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)) share from w),
t as (select source, source_size, least(cap::double, max(share) over () * weight) target from a),
c as (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint copies from t),
h as (select source, hash, sum(size)::bigint n from d where size > 0 group by source, hash),
b as (select source, hash, n, coalesce(sum(n) over (partition by source order by hash rows between unbounded preceding and 1 preceding), 0)::bigint below from h),
e as (select c.*, b.hash upto, below, n, target - copies * source_size budget from c left join b on b.source is not distinct from c.source and below <= target - copies * source_size
  qualify row_number() over (partition by c.source order by b.hash desc nulls last) = 1)
select doc_id, size, source_size, target, (size * least({MAX_REPEATS}, copies + case when hash < upto or (hash = upto and below + n - budget < budget - below) then 1 else 0 end))::bigint taken
from d join e on d.source is not distinct from e.source"""
