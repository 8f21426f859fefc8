"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact
cosine verification, and distributed connected components.

Vectors of one label and dimension are compared. Exact copies are one class with
a count. A class meets those that share its sign hash in one of several tables of
some hyperplanes each; at cosine 0.93 two signs agree with chance 0.88, so a
pair is missed by all tables with chance (1 - 0.88**bits)**tables. Bits grow with
the logarithm of the most classes that one label and dimension hold, so that a
bucket of vectors spread evenly stays near BLOCK of them, and tables grow with the
bits, so that the chance stays at MISSED: 10 bits and 32 tables up to a million
classes, 20 bits and 129 tables for a billion.
Within a bucket cosines are taken in double precision by blocks of BLOCK
vectors, pair of blocks by pair of blocks; a bucket of any size is dealt over
tasks that way. A pair counts in the first table that brings it together, which
the signatures of both tell, so links are summed and no pair is written out;
what a block writes is one count per vector and a spanning forest of its links.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and those of a null label, link with nothing and are kept; rows that
repeat a vec_id count as vectors of their own; a null vec_id links but is no
component's smallest; ties are exact copies; an empty table gives an empty
result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.llm.common import map_arrow, materialize, whole_groups
from emberlane.llm.graph import components

THRESHOLD = 0.93
AGREE = 1 - math.acos(THRESHOLD) / math.pi  # chance that a pair at the threshold shares a sign
MISSED = 3e-5  # chance that no table brings such a pair together
LEAST_BITS, MOST_BITS = 10, 31  # a hash is an int; beyond 2**41 classes buckets grow, and none is left out
BLOCK = 1024
SEED = 20240607


def bits_for(n: int) -> int:
    """Bits with which n vectors, spread evenly, make buckets of about BLOCK."""
    return min(max(LEAST_BITS, math.ceil(math.log2(max(n, 1) / BLOCK))), MOST_BITS)


def tables_for(bits: int) -> int:
    return math.ceil(math.log(MISSED) / math.log1p(-(AGREE**bits)))


def planes(dim: int, n: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, n)).astype(np.float32)


def signatures(x: np.ndarray, bits: int) -> np.ndarray:
    """rows x tables hashes of that many signs."""
    tables = tables_for(bits)
    signs = (x.astype(np.float32) @ planes(x.shape[1], tables * bits)) >= 0
    return (signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits))).astype(np.int32)


def _sign(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims):
            rows = b.filter(pa.array(dims == dim))
            x = rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, dim)
            sig = signatures(x, bits)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.FixedSizeListArray.from_arrays(pa.array(sig.ravel()), sig.shape[1]).cast(pa.list_(pa.int32()))], [*rows.schema.names, "sig"])


def forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the link matrix connects: one per joined class."""
    ids = np.concatenate([left, right])
    n = len(left)
    label = np.arange(len(ids))
    edges = []
    for i in np.flatnonzero(links.any(1)):
        js = np.flatnonzero(links[i]) + n
        other = np.unique(label[js])
        mine = label[i]
        if len(other) == 1 and other[0] == mine:
            continue
        for o in other[other != mine]:
            edges.append((int(ids[i]), int(ids[js[label[js] == o][0]])))
        label[np.isin(label, other)] = mine
    return edges


def _verify(batches: Iterator[pa.RecordBatch], tables: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block pair lie together, side 0 before side 1 (a block with itself has side 0 alone)."""
    for t in whole_groups(batches, "bucket", "pair"):
        bucket, pair, side, table, ids, n = (t.column(c).to_numpy() for c in ("bucket", "pair", "side", "tab", "rep", "n"))
        starts = np.concatenate([[0], np.flatnonzero((bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])) + 1, [len(bucket)]])
        lists, sigs = t.column("v").combine_chunks(), t.column("sig").combine_chunks()
        counted: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for a, z in zip(starts, starts[1:]):
            if z - a < 2:
                continue
            part = lists.slice(a, z - a)
            x = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(z - a, -1)
            x /= np.sqrt((x * x).sum(1))[:, None]
            s = sigs.slice(a, z - a).flatten().to_numpy().reshape(z - a, tables)
            cut = int((side[a:z] == 0).sum())
            own = cut == z - a
            if cut == 0:
                continue
            l, r = (slice(0, z - a), slice(0, z - a)) if own else (slice(0, cut), slice(cut, z - a))
            links = x[l] @ x[r].T >= THRESHOLD
            if own:
                np.fill_diagonal(links, False)
            i, j = np.nonzero(links)
            if not len(i):
                continue
            for lo in range(0, len(i), 200_000):  # the first common table counts
                ii, jj = i[lo : lo + 200_000], j[lo : lo + 200_000]
                late = (s[l][ii, : table[a]] == s[r][jj, : table[a]]).any(1) if table[a] else np.zeros(len(ii), bool)
                links[ii[late], jj[late]] = False
            left, right, nl, nr = ids[a:z][l], ids[a:z][r], n[a:z][l], n[a:z][r]
            for k, c in zip(left, links @ nr):
                if c:
                    counted[int(k)] = counted.get(int(k), 0) + int(c)
            if not own:
                for k, c in zip(right, nl @ links):
                    if c:
                        counted[int(k)] = counted.get(int(k), 0) + int(c)
            edges += forest(links, left, right)
        k = len(counted)
        rows_a = [*counted, *[e[0] for e in edges]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows_a, pa.int64()), pa.array([None] * k + [e[1] for e in edges], pa.int64()), pa.array([*counted.values(), *[0] * len(edges)], pa.int64())], ["a", "b", "links"]
        )


def usable() -> Column:
    """Whether the row's vector can link at all."""
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    return F.coalesce(sound, F.lit(False))


def near_duplicates(vectors: DataFrame, bits: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row. bits: of a table's hash;
    by the number of classes if not given."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    # -0.0 and 0.0 are one component; sha2 over the text of the numbers stands for the vector
    digest = F.sha2(F.concat_ws(",", F.col("label"), F.array_join(F.transform("v", lambda x: (x + 0.0).cast("string")), ",")), 256)
    good = rows.where(usable()).withColumn("key", digest)
    keyed = good.select("vec_id", "key")
    per = materialize(
        good.groupBy("key").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v")).withColumn("rep", F.xxhash64("key")).withColumn("dim", F.size("v")),
        "vector-classes",
    )
    if bits is None:
        bits = bits_for(per.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0)
    tables = tables_for(bits)
    signed = map_arrow(per.select("rep", "n", "dim", "label", "v"), lambda batches: _sign(batches, bits), "rep long, n long, dim int, label string, v array<double>, sig array<int>")
    signed = materialize(signed, "vector-signs")
    spread = signed.select("rep", "n", "dim", "label", F.posexplode("sig").alias("tab", "h"))
    key = F.xxhash64("label", "dim", "tab", "h")
    blocks = spread.select(key.alias("bucket"), F.lit(1).alias("one")).groupBy("bucket").agg(F.ceil(F.count("one") / BLOCK).cast("int").alias("blocks"), F.count("one").alias("size")).where("size > 1").drop("size")
    placed = signed.select("rep", "n", "dim", "label", "v", "sig", F.posexplode("sig").alias("tab", "h")).withColumn("bucket", key).join(blocks, "bucket")
    mine = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int")
    # a row goes to every pair of blocks that holds its own; the smaller block is side 0
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct((F.least(mine, o) * F.col("blocks") + F.greatest(mine, o)).cast("long").alias("pair"), F.when(mine <= o, 0).otherwise(1).alias("side")))
    dealt = placed.select("bucket", "tab", "rep", "n", "v", "sig", F.inline(pairs))
    n_parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(n_parts, "bucket", "pair").sortWithinPartitions("bucket", "pair", "side", "rep")
    found = materialize(map_arrow(sorted_, lambda batches: _verify(batches, tables), "a long, b long, links long"), "vector-links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    parts = components(found.where("b is not null").select("a", "b"))
    # a component is named by the smallest vec_id in it
    per_class = per.select("key", "rep", "n", "first").join(links, per["rep"] == links["a"], "left").join(parts, per["rep"] == parts["node"], "left").select("key", "n", "first", "links", F.coalesce("component", "rep").alias("component"))
    names = per_class.groupBy("component").agg(F.min("first").alias("component_id"))
    told = per_class.join(names, "component").select("key", "n", "links", "component_id")
    ids = keyed.join(told, "key").select("vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component_id")
    alone = rows.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ids.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = f"""
with recursive v as (select vec_id, label, embedding::double[] e from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id and list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {THRESHOLD}),
r as (select vec_id a, vec_id c from embeddings union select p.b, r.c from r join p on p.a = r.a),
m as (select a, min(c) component_id from r group by a)
select vec_id, (select count(*) from p where p.a = vec_id)::bigint n_links, component_id, vec_id = component_id kept from embeddings join m on m.a = vec_id"""
