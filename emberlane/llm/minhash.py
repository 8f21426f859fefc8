"""MinHash near-dedup by DartMinHash over weighted five-word shingles.

A shingle weighs as often as it occurs. Each element's weight axis is cut into
the regions [0, 1), [1, 2), [2, 4), [4, 8) and so on; hashed darts are thrown
into a region in order of their rank (a Poisson process whose gaps and places
come from hashes of element, region and throw), and a dart hits if its place
lies below the element's weight. Of the hits the earliest per coordinate is
kept. Only darts up to a rank that fills all coordinates are thrown, about
COORDINATES * (ln COORDINATES + 2) for a text of any length; a text with an
empty coordinate gets darts of twice that rank. Two texts agree in a coordinate
with the chance of their weighted Jaccard similarity.

Bands of ROWS coordinates are joined on. A pair at 0.8 is missed by all bands
with chance (1 - 0.8**6)**32, below 1e-4. Equal texts are one class first. The
classes of a bucket are held against its pivot, exactly; then, where a bucket
still holds several components, every pair across them whose signatures do not
rule out 0.8 by seven standard deviations is compared too, in the first bucket
it shares, by blocks; only links are written. Big pivots and pairs of blocks are
dealt over tasks, and what a bucket, a class or a component is told meets its
rows by heavy_join(), so a third of all rows in one of them gathers nowhere.
Verified links give connected components.

A class is told by two 64-bit hashes of its text. The first is its node; a row
whose second differs from its node's is another text, by chance: it links with
nothing and is kept, so that no text goes for one that it does not equal.

Defined cases: a text of one to four words is one shingle; a null text, or one
without words, links with nothing; rows that repeat a doc_id count by their
texts, and each is kept or goes by its own; a null doc_id follows its text's
class but names none, and of a component without any id one text stays; ties are
equal texts; an empty table gives an empty result; other columns are left out, or
(deduplicated) returned as they are, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.llm.common import heavy_join, map_arrow, materialize, mix64, slices, utf8, whole_groups
from emberlane.llm.graph import components
from emberlane.llm.textarrays import words_of

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (math.log(COORDINATES) + 2)
RULED_OUT = THRESHOLD - 7 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / COORDINATES)  # of agreeing coordinates
MEMBERS = 256  # of a pivot in one task's group
BLOCK = 512  # nodes
ELEMENTS = 1 << 21  # of a block's texts
CHUNK = 1 << 20  # bytes of text in arrays at a time

_LANE = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the text that each is of."""
    w = words_of(data, offsets)
    counts = np.diff(w.first)
    n = len(w.hash)
    doc = np.repeat(np.arange(len(counts)), counts)
    rolled = np.zeros(n, np.uint64)
    have = np.minimum(w.first[1:][doc] - np.arange(n), SHINGLE)  # words of a shingle that begins here
    for k in range(SHINGLE):
        next_ = np.zeros(n, np.uint64)
        next_[: n - k] = w.hash[k:]
        rolled = np.where(have > k, (rolled ^ next_) * _LANE[0] + np.uint64(k + 1), rolled)
        rolled ^= rolled >> np.uint64(29)
    keep = have == SHINGLE
    short = (counts > 0) & (counts < SHINGLE)
    keep[w.first[:-1][short]] = True
    return mix64(rolled[keep]), doc[keep]


def weighted(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with counts, in the order of texts."""
    _, at, count = np.unique(mix64(h + doc.astype(np.uint64) * _LANE[1]), return_index=True, return_counts=True)
    order = np.argsort(doc[at], kind="stable")
    return h[at][order], doc[at][order], count[order]


def darts(h: np.ndarray, doc: np.ndarray, weight: np.ndarray, rank_limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, rank, id) of every dart that hits below its text's rank limit."""
    regions = [(h, doc, weight, np.full(len(h), 0.0), np.full(len(h), 1.0), np.zeros(len(h), np.uint64))]
    lo, v = 1.0, 1
    while (more := weight > lo).any():
        regions.append((h[more], doc[more], weight[more], np.full(more.sum(), lo), np.full(more.sum(), lo), np.full(more.sum(), v, np.uint64)))
        lo, v = lo * 2, v + 1
    h, doc, weight, low, width, level = (np.concatenate(x) for x in zip(*regions))
    seed = mix64(h + level * _LANE[2])
    limit = rank_limit[doc]
    rank = np.zeros(len(h))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def thrown(seed, j, width):
        ident = mix64(seed + np.atleast_1d(j) * _LANE[3])
        u = ((ident >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        return ident, -np.log(u) / width

    j = 0
    alive = np.arange(len(h))
    while len(alive):
        if j < 24:
            ident, gap = thrown(seed[alive], np.uint64(j + 1), width[alive])
            rank[alive] += gap
            ok = rank[alive] <= limit[alive]
            alive, ident = alive[ok], ident[ok]
            place = low[alive] + width[alive] * (mix64(ident ^ _LANE[0]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            hit = place < weight[alive]
            out.append((doc[alive][hit], rank[alive][hit], ident[hit]))
            j += 1
            continue
        # the few that still get darts, of short texts or wide regions: many throws at once
        left = (limit[alive] - rank[alive]) * width[alive]
        n = np.ceil(left + 6 * np.sqrt(left) + 8).astype(np.int64)
        for a, z in slices(n, 1 << 18):
            some, k = alive[a:z], n[a:z]
            rows = np.repeat(some, k)
            first = np.repeat(np.cumsum(k) - k, k)
            nth = np.arange(len(rows)) - first
            ident, gap = thrown(seed[rows], (nth + j + 1).astype(np.uint64), width[rows])
            total = np.cumsum(gap)
            start = np.cumsum(k) - k
            before = np.where(start > 0, total[start - 1], 0.0)
            r = rank[rows] + total - np.repeat(before, k)
            place = low[rows] + width[rows] * (mix64(ident ^ _LANE[0]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            hit = (r <= limit[rows]) & (place < weight[rows])
            out.append((doc[rows][hit], r[hit], ident[hit]))
        break  # six deviations beyond the limit: what is thrown later does not count
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (doc[:0], rank[:0], seed[:0])


def signatures(h: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """n_docs x COORDINATES ids of the earliest darts (0: the text has no shingle)."""
    sig = np.zeros(n_docs * COORDINATES, np.uint64)
    total = np.bincount(doc, weight, n_docs)
    todo = total > 0
    throws = DARTS
    while todo.any():
        sel = todo[doc]
        limit = np.divide(throws, total, out=np.zeros(n_docs), where=total > 0)
        d, rank, ident = darts(h[sel], doc[sel], weight[sel].astype(np.float64), limit)
        at = d * COORDINATES + ((ident >> np.uint64(7)) % np.uint64(COORDINATES)).astype(np.int64)
        best = np.full(n_docs * COORDINATES, np.inf)
        np.minimum.at(best, at, rank)
        first = rank == best[at]
        sig[at[first]] = ident[first] | np.uint64(1)
        empty = (sig.reshape(n_docs, COORDINATES) == 0).any(1)
        todo &= empty
        throws *= 2
    return sig.reshape(n_docs, COORDINATES)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = utf8(b.column("text"))
        for a, z in slices(np.diff(offsets), CHUNK):
            part, off = data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]
            h, doc, count = weighted(*shingles(part, off))
            sig = signatures(h, doc, count, z - a)
            bands = np.zeros((z - a, BANDS), np.uint64)
            cells = sig.reshape(z - a, BANDS, ROWS)
            for r in range(ROWS):
                bands = mix64(bands + cells[:, :, r] * _LANE[r % 4] + np.uint64(r + 1))
            bands += np.arange(BANDS, dtype=np.uint64) * _LANE[1]  # a bucket's key tells its band
            some = np.bincount(doc, minlength=z - a) > 0
            sketch = sig.astype(np.uint16)
            yield pa.RecordBatch.from_arrays([
                *[b.column(c).slice(a, z - a) for c in ("doc_id", "node", "half")], pa.array(some),
                pa.ListArray.from_arrays(pa.array(np.arange(z - a + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel())),
                pa.array([s.tobytes() for s in sketch], pa.binary()),
            ], ["doc_id", "node", "half", "some", "bands", "sketch"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's weighted shingles as a sorted set: the k-th occurrence of a shingle is an element."""
    for b in batches:
        data, offsets = utf8(b.column("text"))
        for a, z in slices(np.diff(offsets), CHUNK):
            part, off = data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]
            h, doc, count = weighted(*shingles(part, off))
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            e, d = mix64(np.repeat(h, count) + nth.astype(np.uint64) * _LANE[2]).view(np.int64), np.repeat(doc, count)
            order = np.lexsort((e, d))
            e, ends = e[order], np.concatenate([[0], np.cumsum(np.bincount(d, minlength=z - a))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("node").slice(a, z - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(e))], ["node", "elements"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of a pivot (side 0) and members (side 1): the links at THRESHOLD or above."""
    for t in whole_groups(batches, "pivot", "part"):
        pivot, part, side, node = (t.column(c).to_numpy() for c in ("pivot", "part", "side", "node"))
        lists = t.column("elements").combine_chunks()
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((pivot[1:] != pivot[:-1]) | (part[1:] != part[:-1])) + 1, [len(pivot)]])
        a_, b_ = [], []
        for a, z in zip(starts, starts[1:]):
            if side[a] != 0 or z - a < 2:
                continue
            own = flat[offsets[a] : offsets[a + 1]]
            members = flat[offsets[a + 1] : offsets[z]]
            if not len(own):
                continue
            place = np.minimum(np.searchsorted(own, members), len(own) - 1)
            shared = np.concatenate([[0], np.cumsum(own[place] == members)])
            ends = offsets[a + 1 : z + 1] - offsets[a + 1]
            both = shared[ends[1:]] - shared[ends[:-1]]
            sizes = np.diff(ends)
            link = both >= THRESHOLD * (len(own) + sizes - both)
            b_.append(node[a + 1 : z][link])
            a_.append(np.full(int(link.sum()), pivot[a]))
        if a_:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_)), pa.array(np.concatenate(b_))], ["a", "b"])


def verified(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    """The pairs (a: pivot, b) whose similarity reaches THRESHOLD. A pivot's
    members are dealt over groups of about MEMBERS."""
    parts = materialize(pairs.groupBy("a").agg(F.count("*").alias("size")).withColumn("parts", F.ceil(F.col("size") / MEMBERS).cast("int")), "minhash-parts")
    dealt = heavy_join(pairs, parts, "a", "size", pairs.count()).select(F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("node"))
    members = dealt.join(elements, "node").select("pivot", "part", F.lit(1).alias("side"), "node", "elements")
    pivots = parts.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(elements, "node").select(F.col("node").alias("pivot"), "part", F.lit(0).alias("side"), "node", "elements")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = pivots.unionByName(members).repartition(n, "pivot", "part").sortWithinPartitions("pivot", "part", "side")
    return map_arrow(sorted_, _compare, "a long, b long")


def block_pairs(rows: DataFrame, blocks: str) -> DataFrame:
    """Deals the nodes of a bucket to its pairs of blocks: a row goes to every pair
    that holds its own block, the smaller block as side 0."""
    mine, n = F.pmod(F.xxhash64("node", F.lit(1)), F.col(blocks)).cast("int"), F.col(blocks)
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda o: F.struct((F.least(mine, o) * n + F.greatest(mine, o)).cast("long").alias("pair"), F.when(mine <= o, 0).otherwise(1).alias("side")))
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*[c for c in rows.columns if c != blocks], F.inline(pairs)).repartition(n_parts, "bucket", "pair").sortWithinPartitions("bucket", "pair", "side")


def _open_pairs(t: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows) of a table of whole block pairs: nodes of different components
    whose first common bucket this is and whose signatures do not rule out a link."""
    bucket, pair, side, comp = (t.column(c).to_numpy() for c in ("bucket", "pair", "side", "component"))
    sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(len(bucket), COORDINATES)
    bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(bucket), BANDS)
    starts = np.concatenate([[0], np.flatnonzero((bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])) + 1, [len(bucket)]])
    for a, z in zip(starts, starts[1:]):
        cut = a + int((side[a:z] == 0).sum())
        for i in range(a, cut):
            js = np.arange(i + 1, z) if cut == z else np.arange(cut, z)
            js = js[comp[js] != comp[i]]
            if len(js):
                first = np.argmax(bands[js] == bands[i], axis=1)
                js = js[bands[js, first] == bucket[i]]
                js = js[(sketch[js] == sketch[i]).sum(1) >= RULED_OUT * COORDINATES]
            if len(js):
                yield i, js


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node) that have a pair to be compared there."""
    for t in whole_groups(batches, "bucket", "pair"):
        wanted = np.zeros(t.num_rows, bool)
        for i, js in _open_pairs(t):
            wanted[i] = wanted[js] = True
        if wanted.any():
            yield pa.RecordBatch.from_arrays([pa.array(t.column(c).to_numpy()[wanted]) for c in ("bucket", "node")], ["bucket", "node"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links between nodes of different components, exactly: no pair is
    written that is not a link, and of a node's links to a component one."""
    for t in whole_groups(batches, "bucket", "pair"):
        node, comp = t.column("node").to_numpy(), t.column("component").to_numpy()
        lists = t.column("elements").combine_chunks()
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        links = []
        for i, js in _open_pairs(t):
            own = flat[offsets[i] : offsets[i + 1]]
            sizes = offsets[js + 1] - offsets[js]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            members = flat[np.repeat(offsets[js] - ends[:-1], sizes) + np.arange(ends[-1])]
            place = np.minimum(np.searchsorted(own, members), len(own) - 1)
            shared = np.concatenate([[0], np.cumsum(own[place] == members)])
            both = shared[ends[1:]] - shared[ends[:-1]]
            found = js[both >= THRESHOLD * (len(own) + sizes - both)]
            if len(found):
                _, one = np.unique(comp[found], return_index=True)
                links += [(int(node[i]), int(node[j])) for j in found[one]]
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*links)], ["a", "b"])


def told(text: Column) -> list[Column]:
    """node and half: two 64-bit hashes of a text, apart by their seeds."""
    return [F.xxhash64(text).alias("node"), F.xxhash64(F.lit(1), text).alias("half")]


def _judged(docs: DataFrame) -> DataFrame:
    """near_duplicates() with node and half of each row's text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *told(F.col("text")))
    signed = materialize(map_arrow(texts, _sign, "doc_id long, node long, half long, some boolean, bands array<long>, sketch binary"), "minhash")
    # equal texts have equal signatures: one row of each class speaks for it
    speaker = materialize(signed.where("some").dropDuplicates(["node"]), "minhash-classes")
    entries = speaker.select("node", F.explode("bands").alias("bucket"))
    sizes = materialize(entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").withColumn("members", F.col("size")), "minhash-sizes")
    inside = materialize(heavy_join(entries, sizes, "bucket", "size", BANDS * speaker.count()).select("bucket", "node", "members"), "minhash-buckets")
    n_inside = inside.count()
    # a bucket's pivot is the class that meets most others over all buckets: in a
    # group of copies that is the one they were made from, or close to it
    meets = inside.groupBy("node").agg(F.sum(F.col("members") - 1).alias("meets"))
    pivots = materialize(inside.join(meets, "node").groupBy("bucket").agg(F.max(F.struct("meets", "node"))["node"].alias("pivot"), F.first("members").alias("size")), "minhash-pivots")
    stars = materialize(heavy_join(inside, pivots, "bucket", "size", n_inside).where("pivot <> node").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "minhash-stars")
    wanted = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    # the text of each class that meets another, from the row that speaks for it; of
    # rows without an id any one of an equal text will do
    asked = wanted.join(speaker.select("node", "half", "doc_id"), "node")
    by_id = texts.where("doc_id is not null").join(asked.where("doc_id is not null"), ["doc_id", "node", "half"], "left_semi")
    nameless = texts.where("doc_id is null").dropDuplicates(["node", "half"]).join(asked.where("doc_id is null"), ["node", "half"], "left_semi")
    both = by_id.unionByName(nameless).select("node", "text")
    elements = materialize(map_arrow(both, _elements, "node long, elements array<long>").dropDuplicates(["node"]), "minhash-elements")
    first_links = materialize(verified(stars, elements), "minhash-links")
    parts = materialize(components(first_links), "minhash-stars-parts")
    # buckets that still hold several components
    here = materialize(inside.select("bucket", "node").join(parts, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")), "minhash-here")
    open_ = here.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
    open_ = materialize(open_.select("bucket", "size", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "minhash-open")
    signs = speaker.select("node", "sketch", "bands")
    looked = block_pairs(heavy_join(here, open_, "bucket", "size", n_inside).join(signs, "node"), "blocks")
    needed = materialize(map_arrow(looked, _needed, "bucket long, node long").distinct(), "minhash-needed")
    lengths = elements.select("node", F.size("elements").alias("n"))
    blocks = materialize(needed.join(lengths, "node").groupBy("bucket").agg(F.ceil(F.sum("n") / ELEMENTS).cast("int").alias("blocks"), F.count("*").alias("size")), "minhash-blocks")
    held = heavy_join(needed, blocks, "bucket", "size", needed.count()).join(elements, "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")).join(signs, "node")
    across = map_arrow(block_pairs(held.select("bucket", "node", "component", "sketch", "bands", "elements", "blocks"), "blocks"), _across, "a long, b long")
    final = materialize(components(first_links.unionByName(across)), "minhash-final")
    per = signed.groupBy("node").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    named = materialize(per.join(final, "node", "left").withColumn("component", F.coalesce("component", "node")), "minhash-named")
    least = materialize(named.groupBy("component").agg(F.min("class_id").alias("component_id"), F.min("node").alias("least"), F.count("*").alias("size")), "minhash-least")
    whole = heavy_join(named, least, "component", "size", named.count())
    whole = whole.join(speaker.select("node", F.col("half").alias("spoken")), "node", "left").select("node", "n", "class_id", "component_id", "least", "spoken")
    rows = heavy_join(signed.select("doc_id", "node", "half"), materialize(whole, "minhash-told"), "node", "n", signed.count())
    linked = F.coalesce(F.col("half") == F.col("spoken"), F.lit(False))
    own = lambda c: F.when(linked, F.col(c)).otherwise(F.col("doc_id")).alias(c)
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("component_id").isNotNull() | (F.col("node") == F.col("least")))
    return rows.select("doc_id", own("class_id"), own("component_id"), (~linked | first).alias("kept"), "node", "half")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of equal texts), component_id (smallest
    doc_id reachable by links), kept, per row."""
    return _judged(docs).drop("node", "half")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all columns.
    A row stays by its doc_id and text; of rows that repeat both, one stays."""
    keep = _judged(docs).where("kept").select(F.col("doc_id").alias("k"), F.col("node").alias("n"), F.col("half").alias("h")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), *told(F.col("text")))
    same = F.col("id").eqNullSafe(F.col("k")) & (F.col("node") == F.col("n")) & (F.col("half") == F.col("h"))
    stay = packed.join(keep, same, "left_semi").dropDuplicates(["id", "node", "half"])
    return stay.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
