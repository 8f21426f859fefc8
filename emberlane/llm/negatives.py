"""Hard-negative mining by bit-sliced integer products.

A component x becomes the integer floor(256 * x), in two's complement; a score is the
integer inner product of an anchor with a row. The rows' components are taken apart
into bit-planes, the most significant first: after each plane a score lies between what
the planes so far give, plus the least and plus the most that the bits to come can add,
and both ends close in plane by plane. A pair is dropped once its interval cannot
qualify: for a positive, once its upper end is below the scores that an anchor's first
POSITIVES have reached; for a negative, once it misses all of the ranges that the
anchor's positives allow, above what their first NEGATIVES have reached. While most
pairs live a plane is one matrix product; then the few left are listed.

The anchors, a hundredth of the rows, are broadcast in groups of GROUP bytes at most,
and for each group every row is read where it lies, without a shuffle. What a task sends
is its own best rows for an anchor. To send few, a sixteenth of the rows goes first: its
best are thresholds for the others, which then send some hundred rows an anchor and not
as many as there are tasks.

Defined cases: rows with a null vec_id, a null label, a null vector, or any null or
non-finite component take no part, nor do those whose products could leave 64 bits
(dimension times the square of the largest integer is 2**62 or more); rows of another
dimension are not compared; other rows are those with another vec_id; rows that repeat
a vec_id are compared and listed each; an empty vector scores 0 with its like; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlane.llm.common import map_arrow, materialize

SCALE, EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
GROUP = 16 << 20  # bytes of anchors at a time
FIRST = 16  # one row of so many goes first
BLOCK = 1 << 21  # pairs at a time
LISTED = 8  # pairs are listed once fewer than one of so many is left
NEVER = -(1 << 63)


def planes(q: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Weight, the most that lower planes can add, and the bits, from the sign down."""
    for j in range(n - 1, -1, -1):
        yield (-1 if j == n - 1 else 1) << j, (1 << j) - 1, ((q >> j) & 1).astype(np.float64)


def scores(anchors: np.ndarray, q: np.ndarray, able: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and score of the pairs that may go together (able) and whose score is
    from least to most (of the anchor), by planes of q."""
    a = anchors.astype(np.float64)
    up, down = np.maximum(anchors, 0).sum(1), np.minimum(anchors, 0).sum(1)
    n = int(max(q.max(initial=0), -1 - q.min(initial=0))).bit_length() + 1
    total = np.zeros(able.shape, np.int64)
    listed: tuple[np.ndarray, np.ndarray] | None = None
    if np.count_nonzero(able) * LISTED < able.size:
        listed = np.nonzero(able)
        total = total[listed]
    for weight, rest, bits in planes(q, n):
        if listed is None:
            total += weight * (a @ bits.T).astype(np.int64)
            able = able & (total + (rest * up)[:, None] >= least[:, None]) & (total + (rest * down)[:, None] <= most[:, None])
            if np.count_nonzero(able) * LISTED < able.size:
                listed = np.nonzero(able)
                total = total[listed]
        else:
            i, j = listed
            for lo in range(0, len(i), BLOCK // 16):
                part = slice(lo, lo + BLOCK // 16)
                total[part] += weight * np.einsum("nd,nd->n", a[i[part]], bits[j[part]]).astype(np.int64)
            keep = (total + rest * up[i] >= least[i]) & (total + rest * down[i] <= most[i])
            listed, total = (i[keep], j[keep]), total[keep]
    if listed is None:
        listed = np.nonzero(able)
        total = total[listed]
    return *listed, total


def first_of(keys: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best of each key: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score, keys))
    k = keys[order]
    head = np.flatnonzero(np.append(True, k[1:] != k[:-1]))[: len(k)]
    rank = np.arange(len(k)) - np.repeat(head, np.diff(np.append(head, len(k))))
    return order[rank < n]


class Best:
    """The n best rows of each key so far, and the score that a further one must reach."""

    def __init__(self, reached: np.ndarray, n: int):
        self.n, self.reached = n, reached.copy()
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(3))  # key, score, id

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.rows, (key, score, ids))]
        keep = first_of(*rows, self.n)
        self.rows = tuple(x[keep] for x in rows)
        full = np.flatnonzero(np.bincount(self.rows[0], minlength=len(self.reached)) == self.n)
        last = np.searchsorted(self.rows[0], full, side="right") - 1
        self.reached[full] = np.maximum(self.reached[full], self.rows[1][last])


def _blocks(batches: Iterator[pa.RecordBatch], group: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Places of anchors, and ids, labels and components of rows, of one dimension."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            mine = group["by_dim"].get(dim)
            if mine is None:
                continue
            t = b.filter(pa.array(dims == dim))
            q = t.column("q").flatten().to_numpy().reshape(t.num_rows, dim)
            ids, labels = t.column("vec_id").to_numpy(), t.column("label").to_numpy()
            step = max(1, BLOCK // max(t.num_rows, 1))
            for lo in range(0, len(mine), step):
                yield mine[lo : lo + step], ids, labels, q


def _vectors(group: dict, at: np.ndarray, dim: int) -> np.ndarray:
    return group["q"][group["from"][at][:, None] + np.arange(dim)]


def _positives(sent, sent_reached):
    """The best rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = sent.value
        best = Best(sent_reached.value, POSITIVES)
        for at, ids, labels, q in _blocks(batches, g):
            able = (g["label"][at][:, None] == labels) & (g["vec_id"][at][:, None] != ids)
            i, j, s = scores(_vectors(g, at, q.shape[1]), q, able, best.reached[at], np.full(len(at), (1 << 63) - 1))
            best.add(at[i], s, ids[j])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.rows], ["key", "score", "id"])

    return run


def _negatives(sent, sent_asked, sent_reached):
    """The best rows of other labels in the range of each anchor's positives. asked:
    anchor, least and most of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, (anchor, least, most) = sent.value, sent_asked.value
        best = Best(sent_reached.value, NEGATIVES)
        begin = np.searchsorted(anchor, np.arange(len(g["label"]) + 1))  # keys lie by anchor
        for at, ids, labels, q in _blocks(batches, g):
            at = at[begin[at + 1] > begin[at]]
            if not len(at):
                continue
            low = np.maximum(least, best.reached)
            able = g["label"][at][:, None] != labels
            lowest, highest = np.full(len(begin), -NEVER - 1), np.full(len(begin), NEVER)
            np.minimum.at(lowest, anchor, low)
            np.maximum.at(highest, anchor, most)
            lowest, highest = lowest[at], highest[at]
            i, j, s = scores(_vectors(g, at, q.shape[1]), q, able, lowest, highest)
            n = (begin[at + 1] - begin[at])[i]
            pair = np.repeat(np.arange(len(i)), n)
            key = np.repeat(begin[at][i] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            good = (s[pair] >= low[key]) & (s[pair] <= most[key])
            best.add(key[good], s[pair][good], ids[j][pair][good])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.rows], ["key", "score", "id"])

    return run


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim and q (integers) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    largest = F.lit(float(SCALE)) * F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)) + 1
    small = F.size("v") * largest * largest < float(1 << 62)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    q = F.transform("v", lambda x: F.floor(F.lit(float(SCALE)) * x).cast("long"))
    return rows.where(F.coalesce(sound, F.lit(False))).where(small).select("vec_id", moved.alias("label"), F.size("v").alias("dim"), q.alias("q"))


def _group(rows: pa.Table) -> dict:
    dims = rows.column("dim").to_numpy().astype(np.int64)
    begin = np.cumsum(dims) - dims
    q = rows.column("q").combine_chunks().flatten().to_numpy()
    return {"vec_id": rows.column("vec_id").to_numpy(), "label": rows.column("label").to_numpy(), "from": begin, "q": q, "by_dim": {d: np.flatnonzero(dims == d) for d in np.unique(dims).tolist()}}


def _leading(rows: DataFrame, n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.asc("id")))).where(F.col("rank") <= n)


_SENT = "key long, score long, id long"


def _mined(spark, stages: list[DataFrame], sent_by, reached: np.ndarray, n: int, tag: str) -> DataFrame:
    """key, score, id, rank of the n best rows of each key, stage after stage."""
    found: DataFrame | None = None
    for stage in stages:
        more = map_arrow(stage, sent_by(spark.sparkContext.broadcast(reached)), _SENT)
        both = more if found is None else more.unionByName(found.drop("rank"))
        found = materialize(_leading(both, n), tag)
        last = found.where(F.col("rank") == n).select("key", "score").toArrow()
        reached = reached.copy()
        reached[last.column("key").to_numpy()] = last.column("score").to_numpy()
    return found


def hard_negatives(vectors: DataFrame, every: int = EVERY, most: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = integers(vectors)
    early = F.pmod(F.xxhash64("vec_id", "q"), F.lit(FIRST)) == 0
    stages = [materialize(rows.where(early), "vectors-first"), materialize(rows.where(~early), "vectors-rest")]
    anchors = materialize(stages[0].unionByName(stages[1]).where(F.col("vec_id") % every == 0), "anchors")
    size = anchors.agg(F.sum(F.lit(64) + 8 * F.col("dim"))).first()[0] or 0
    n = math.ceil(2 * size / most) if size > most else 1
    out: DataFrame | None = None
    for k in range(n):
        part = _group(anchors.where(F.pmod(F.xxhash64("vec_id", "q"), F.lit(n)) == k).toArrow())
        ids = part["vec_id"]
        sent = spark.sparkContext.broadcast(part)
        positives = _mined(spark, stages, lambda r, sent=sent: _positives(sent, r), np.full(len(ids), NEVER), POSITIVES, "positives")
        told = positives.select("key", "rank", "id", "score").orderBy("key", "rank").toArrow()  # POSITIVES rows an anchor of the group
        anchor, score = told.column("key").to_numpy(), told.column("score").to_numpy()
        # 30 p <= 100 s <= 90 p, in integers that fit
        whole, left = np.divmod(score, 100)
        asked = anchor, whole * LOW_PERCENT + -(-left * LOW_PERCENT // 100), whole * HIGH_PERCENT + left * HIGH_PERCENT // 100
        sent_asked = spark.sparkContext.broadcast(asked)
        found = _mined(spark, stages, lambda r, sent=sent, a=sent_asked: _negatives(sent, a, r), np.full(len(anchor), NEVER), NEGATIVES, "negatives")
        keys = pa.table({"key": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": told.column("id"), "positive_score": told.column("score")})
        named = spark.createDataFrame(keys)
        each = found.join(F.broadcast(named), "key").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = each if out is None else out.unionByName(each)
    return out


def _usable_sql() -> str:
    return "vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


SQL = f"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label, list_transform(embedding, lambda x: floor({SCALE} * x::double)) q from embeddings where {_usable_sql()}),
s as (select a.vec_id a, b.vec_id b, a.label = b.label same, list_dot_product(a.q, b.q)::bigint s from v a join v b on a.vec_id % {EVERY} = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
p as (select * from s where same qualify row_number() over (partition by a order by s desc, b) <= {POSITIVES}),
n as (select p.a, p.b p, s.b n, p.s ps, s.s ns from p join s on s.a = p.a and not s.same and {LOW_PERCENT} * p.s <= 100 * s.s and 100 * s.s <= {HIGH_PERCENT} * p.s)
select a anchor_id, p positive_id, (row_number() over (partition by a, p order by ns desc, n))::int rank, n negative_id, ps positive_score, ns negative_score from n qualify rank <= {NEGATIVES}"""
