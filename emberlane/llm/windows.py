"""Repeated windows of a corpus, found through minimizers. The frame that
suffixes.py (bytes) and superkmers.py (words) share.

A window's minimizer is the smallest hash of the K-unit spans inside it (the
leftmost of equals); it depends on the window's content alone. Consecutive
windows with the same minimizer are one super-k-mer.

1. Minimizers with the documents that hold them travel, packed, to their
   buckets. A minimizer seen once in the corpus proves its windows unique; they
   are never moved. One that occurs twice within a task's batch is settled there
   and sends a single witness, so a common one costs a row per batch.
2. Documents with repeated minimizers cut those super-k-mers out and send each
   as one packed string to its minimizer's bucket; equal strings of one batch
   are settled there too, and a string that one document holds in many places is
   one row with those places. For minimizers with more than HOT occurrences, whose
   strings differ by what surrounds a common passage, every window travels by
   itself under a key of its own, the first half of its 128-bit BLAKE2b digest: no
   bucket gathers more than one window's holders, a few per batch. Strings are
   compared by their bytes, and such windows by that digest, which is
   cryptographic: two that differ and share one are not known for any input.
3. Buckets compare windows exactly and return marked ranges, which meet their
   documents again by doc_id and a 64-bit hash of the text.

Everything that is kept between steps is in the shared folder. The texts are dealt
by document once and kept in buckets of that dealing, where both the asked
minimizers and the marks find them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.llm.common import heavy_join, let_go, map_arrow, materialize, mix64, slices, utf8, whole_groups
from emberlane.llm.textarrays import Spans
from emberlane.session import shared_dir

NO_ID = (1 << 63) - 1  # stands for a null doc_id; after all others
WITNESS, MORE = -(1 << 63), -(1 << 63) + 1  # stand for a document: several of them; more places in the one before
HOT = 1000
CHUNK = 1 << 21  # bytes of text in arrays at a time
BUCKETS = 4  # per shuffle partition
_POSITION = np.uint64(32)  # bits of a unit's place in a batch; a text has less than 2**31 bytes


@dataclass
class Units:
    """A batch's texts as units: their hashes' prefix sums, and each text's first unit."""

    value: np.ndarray
    first: np.ndarray
    cut: Callable[[int, int], bytes]  # the packed string of a range of units


@dataclass(frozen=True)
class Kind:
    width: int  # units of a window
    span: int  # units of a minimizer
    ordered: bool  # only windows of smaller doc_ids count
    units: Callable[[np.ndarray, np.ndarray], Units]
    hot: int = HOT  # occurrences of a minimizer beyond which windows travel one by one


def superkmers(u: Units, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Spans]:
    """key, text, first window and number of windows of each super-k-mer."""
    n = len(u.value)
    spans = Spans.over(u.value)
    none = np.zeros(0, np.int64)
    if n < kind.width:
        return none.astype(np.uint64), none, none, none, spans
    g = spans.runs(kind.span)
    places = kind.width - kind.span + 1
    packed = (g >> _POSITION << _POSITION) | np.arange(len(g), dtype=np.uint64)
    m = packed
    done = 1
    while done * 2 <= places:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    if rest := places - done:
        m = np.minimum(m[:-rest], m[rest:])
    sizes = np.diff(u.first)
    doc = np.repeat(np.arange(len(sizes)), np.maximum(sizes - kind.width + 1, 0))
    window = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(sizes - kind.width + 1, 0)) - np.maximum(sizes - kind.width + 1, 0), np.maximum(sizes - kind.width + 1, 0)) + u.first[doc]
    if not len(window):
        return none.astype(np.uint64), none, none, none, spans
    at = (m[window] & np.uint64((1 << int(_POSITION)) - 1)).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    return g[at[head]], doc[head], window[head], np.diff(np.append(head, len(window))), spans


def _batches(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    data, offsets = utf8(b.column("text"))
    for a, z in slices(np.diff(offsets), CHUNK):
        yield data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a], a, z


def _lists(ends: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("th"), "text")


_PACKED = "bucket int, settled boolean, keys array<long>, docs array<long>, ths array<long>"
_FLAGGED = "key long, doc long, th long, n long"


def _minimizers(kind: Kind, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ths = b.column("doc").to_numpy(), b.column("th").to_numpy()
            for data, offsets, a, z in _batches(b):
                key, doc, _, _, _ = superkmers(kind.units(data, offsets), kind)
                if not len(key):
                    continue
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = key[1:] != key[:-1]
                other = new.copy()
                other[1:] |= doc[1:] != doc[:-1]
                run_of = np.cumsum(new) - 1
                occurs = np.bincount(run_of)
                n = np.bincount(run_of[other]) if kind.ordered else occurs
                key, doc, run_of = key[other], doc[other], run_of[other]
                many = n[run_of] > 1
                lone = ~many
                first = np.ones(len(key), bool)
                first[1:] = run_of[1:] != run_of[:-1]
                w = first & many  # a witness for each key that is settled here
                extra = lone & (occurs[run_of] > 1)  # only where one document is one holder
                out_key = np.concatenate([key[lone], key[w], key[extra]])
                out_doc = np.concatenate([ids[a + doc[lone]], np.full(w.sum(), WITNESS), np.full(extra.sum(), MORE)])
                out_th = np.concatenate([ths[a + doc[lone]], occurs[run_of[w]], occurs[run_of[extra]] - 1])
                out_bucket = (out_key >> np.uint64(40)).astype(np.int64) % buckets
                order = np.argsort(out_bucket, kind="stable")
                some, starts = np.unique(out_bucket[order], return_index=True)
                ends = np.append(starts, len(order))
                parts = [(some, np.zeros(len(some), bool), ends, out_key[order], out_doc[order], out_th[order])]
                if many.any():
                    k = np.flatnonzero(many)
                    cuts = np.append(np.arange(0, len(k), 4096), len(k))
                    spread = (mix64(key[k[cuts[:-1]]] + ids[a + doc[k[cuts[:-1]]]].astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % buckets
                    parts.append((spread, np.ones(len(spread), bool), cuts, key[k], ids[a + doc[k]], ths[a + doc[k]]))
                for bk, settled, e, kk, dd, tt in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bk, pa.int32()), pa.array(settled), _lists(e, kk.view(np.int64), pa.int64()), _lists(e, dd, pa.int64()), _lists(e, tt, pa.int64())], ["bucket", "settled", "keys", "docs", "ths"]
                    )

    return run


def _repeated(kind: Kind):
    """(key, doc, th) of repeated minimizers, and (key, null, null, n) of each common one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "bucket"):
            settled = t.column("settled").combine_chunks()
            for part, direct in ((t.filter(settled), True), (t.filter(pc.invert(settled)), False)):
                if not part.num_rows:
                    continue
                key, doc, th = (part.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "docs", "ths"))
                if direct:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(th), pa.nulls(len(key), pa.int64())], ["key", "doc", "th", "n"])
                    continue
                order = np.argsort(key, kind="stable")
                key, doc, th = key[order], doc[order], th[order]
                head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                witness, more = doc == WITNESS, doc == MORE
                holders = np.add.reduceat(np.where(witness, 2, np.where(more, 0, 1)), head)
                n = np.add.reduceat(np.where(witness | more, th, 1), head)
                size = np.diff(np.append(head, len(key)))
                tell = np.repeat(holders > 1, size) & ~witness & ~more
                hot = (holders > 1) & (n > kind.hot)
                yield pa.RecordBatch.from_arrays([pa.array(key[tell]), pa.array(doc[tell]), pa.array(th[tell]), pa.nulls(int(tell.sum()), pa.int64())], ["key", "doc", "th", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(key[head][hot]), pa.nulls(int(hot.sum()), pa.int64()), pa.nulls(int(hot.sum()), pa.int64()), pa.array(n[hot])], ["key", "doc", "th", "n"])

    return run


_CUT = "key long, doc long, th long, starts array<long>, n int, many boolean, content binary"
_CUT_NAMES = ["key", "doc", "th", "starts", "n", "many", "content"]


def _cut(kind: Kind):
    """Packed strings of super-k-mers with repeated minimizers; rows without
    content are ranges that are settled (their key only spreads them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ths = b.column("doc").to_numpy(), b.column("th").to_numpy()
            asked = b.column("asked")
            for data, offsets, a, z in _batches(b):
                u = kind.units(data, offsets)
                key, doc, window, n, spans = superkmers(u, kind)
                part = asked.slice(a, z - a)
                flat = part.flatten()
                want_key, want_hot = flat.field("key").to_numpy(), flat.field("hot").to_numpy(zero_copy_only=False)
                want_doc = np.repeat(np.arange(z - a), np.diff(part.offsets.to_numpy()))
                # a (text, key) pair is told by one mixed number
                told = mix64(want_key.view(np.uint64) + want_doc.astype(np.uint64) * np.full(1, 0x9FB21C651E98DF25, np.uint64))
                order = np.argsort(told)
                mine = mix64(key + doc.astype(np.uint64) * np.full(1, 0x9FB21C651E98DF25, np.uint64))
                if not len(told) or not len(mine):
                    continue
                place = order[np.minimum(np.searchsorted(told[order], mine), len(told) - 1)]
                hit = told[place] == mine
                hot = hit & want_hot[place]
                cold = np.flatnonzero(hit & ~hot)
                if len(cold):
                    content = [u.cut(int(s), int(s + c - 1 + kind.width)) for s, c in zip(window[cold], n[cold])]
                    yield settle(key[cold].view(np.int64), a + doc[cold], window[cold] - u.first[doc[cold]], n[cold], content, ids, ths, kind)
                h = np.flatnonzero(hot)
                if len(h):
                    each = np.repeat(window[h], n[h]) + np.arange(n[h].sum()) - np.repeat(np.cumsum(n[h]) - n[h], n[h])
                    digests = np.frombuffer(b"".join(hashlib.blake2b(u.cut(w, w + kind.width), digest_size=16).digest() for w in each.tolist()), np.uint64).reshape(-1, 2)
                    d = np.repeat(doc[h], n[h])
                    yield settle_digests(digests[:, 0].copy(), digests[:, 1].copy(), a + d, each - u.first[d], ids, ths, kind)

    return run


def _rows(key, row, starts, ends, n, many, content, ids, ths) -> pa.RecordBatch:
    """Rows for the buckets; starts of all rows lie end to end."""
    doc = np.where(many, WITNESS, ids[row])
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(ths[row], pa.int64()), _lists(ends, starts, pa.int64()), pa.array(n, pa.int32()), pa.array(many), content], _CUT_NAMES)


def settle(key, row, start, n, content, ids, ths, kind: Kind) -> pa.RecordBatch:
    """Leaves one string of equals in the batch. Ordered: those of the smallest
    document stay, a row for each text with all its places, and later documents are
    marked. Else all are marked and a witness stays. row: the text's place in the batch."""
    groups: dict[tuple[int, bytes], list[int]] = {}
    for i, c in enumerate(zip(key.tolist(), content)):
        groups.setdefault(c, []).append(i)
    stay: list[list[int]] = []  # the places of each row that travels with its string
    marked: list[list[int]] = []
    many: list[bool] = []
    for at in groups.values():
        if len(at) == 1:
            stay.append(at)
            many.append(False)
            continue
        texts: dict[int, list[int]] = {}
        for i in at:
            texts.setdefault(int(row[i]), []).append(i)
        if kind.ordered:
            least = min(ids[r] for r in texts)
            for r, mine in texts.items():
                if ids[r] == least:
                    stay.append(mine)
                    many.append(False)
                else:
                    marked.append(mine)
        else:
            marked += texts.values()
            stay.append(at[:1])
            many.append(True)
    out = stay + marked
    i = np.array([x[0] for x in out], np.int64)
    flat = np.array([j for x in out for j in x], np.int64)
    ends = np.cumsum([0, *map(len, out)])
    settled = np.arange(len(out)) >= len(stay)
    spread = mix64(row[i].astype(np.uint64) + start[i].astype(np.uint64) * np.full(1, 0x9E3779B97F4A7C15, np.uint64)).view(np.int64)
    told = pa.array([None if s else content[k] for k, s in zip(i.tolist(), settled)], pa.binary())
    return _rows(np.where(settled, spread, key[i]), row[i], start[flat], ends, n[i], np.array(many + [False] * len(marked), bool), told, ids, ths)


def in_runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring places of a row as ranges: row, first place, how many."""
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] > place[:-1] + 1)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(row))[: len(head)] - 1
    return row[head], place[head], place[last] - place[head] + 1


def repeats(hi: np.ndarray, lo: np.ndarray, doc: np.ndarray, many: np.ndarray, kind: Kind, row: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of windows by their digests: the order that brings equals together, where
    their runs begin in it, and (in that order) which windows are repeats."""
    order = np.lexsort((doc, lo, hi) if row is None else (row, doc, lo, hi))
    h, l = hi[order], lo[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    head = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    if kind.ordered:
        return order, head, doc[order] > doc[order][head][run]
    count = np.add.reduceat(np.where(many[order], 2, 1), head) if len(head) else head
    return order, head, (count[run] > 1) & (doc[order] != WITNESS)


def settle_digests(hi, lo, row, start, ids, ths, kind: Kind) -> pa.RecordBatch:
    """As settle(), for windows that travel one by one."""
    doc = ids[row]
    order, head, gone = repeats(hi, lo, doc, np.zeros(len(hi), bool), kind, row)
    gone_at, stay = order[gone], order[~gone]
    # a text's places of one window are one row
    new = np.ones(len(stay), bool)
    new[1:] = (hi[stay[1:]] != hi[stay[:-1]]) | (lo[stay[1:]] != lo[stay[:-1]]) | (row[stay[1:]] != row[stay[:-1]])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(stay)))
    rep, flat, many = stay[heads], stay, np.zeros(len(heads), bool)
    if not kind.ordered and len(gone_at):
        witness = order[head[gone[head]]]
        rep, flat = np.concatenate([rep, witness]), np.concatenate([flat, witness])
        sizes, many = np.concatenate([sizes, np.ones(len(witness), np.int64)]), np.concatenate([many, np.ones(len(witness), bool)])
    text, first, count = in_runs(row[gone_at], start[gone_at])
    spread = mix64(text.astype(np.uint64) + first.astype(np.uint64) * np.full(1, 0x9E3779B97F4A7C15, np.uint64)).view(np.int64)
    half = lo[rep].tobytes()  # the key is the other half
    content = pa.concat_arrays([pa.array([half[i : i + 8] for i in range(0, len(half), 8)], pa.binary()), pa.nulls(len(text), pa.binary())])
    ends = np.concatenate([[0], np.cumsum(np.concatenate([sizes, np.ones(len(text), np.int64)]))])
    return _rows(
        np.concatenate([hi[rep].view(np.int64), spread]), np.concatenate([row[rep], text]), np.concatenate([start[flat], first]), ends,
        np.concatenate([np.ones(len(rep), np.int64), count]), np.concatenate([many, np.zeros(len(text), bool)]), content, ids, ths,
    )


def _marks(kind: Kind, compare: Callable):
    """compare(list of contents of one key, least document or repeat count each)
    gives for each content the places of its windows that are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key"):
            key, doc, th, n, many = (t.column(c).to_numpy() for c in ("key", "doc", "th", "n", "many"))
            starts = t.column("starts").combine_chunks()
            column = t.column("content").combine_chunks()
            size = pc.fill_null(pc.binary_length(column), -1).to_numpy(zero_copy_only=False)
            settled = np.flatnonzero(size < 0)
            out = [(settled, np.zeros(len(settled), np.int64), n[settled].astype(np.int64))]  # row, first window, windows
            one = np.flatnonzero(size == 8)
            if len(one):
                half = np.frombuffer(b"".join(column.take(pa.array(one)).to_pylist()), np.uint64)
                order, _, gone = repeats(key[one].view(np.uint64), half, doc[one], many[one], kind)
                i = one[order[gone]]
                out.append((i, np.zeros(len(i), np.int64), np.ones(len(i), np.int64)))
            rest = np.flatnonzero(size > 8)
            content = column.take(pa.array(rest)).to_pylist()
            groups: dict[int, dict[bytes, list[int]]] = {}
            for i, c in zip(rest.tolist(), content):
                groups.setdefault(int(key[i]), {}).setdefault(c, []).append(i)
            whole: list[int] = []
            jobs = []
            for contents in groups.values():
                told = []
                for at in contents.values():
                    if kind.ordered:
                        least = min(doc[i] for i in at)
                        whole += [i for i in at if doc[i] > least]
                        told.append((least, [i for i in at if doc[i] == least]))
                    elif len(at) > 1 or many[at[0]]:
                        whole += [i for i in at if doc[i] != WITNESS]
                        told.append((2, []))
                    else:
                        told.append((1, at))
                if len(contents) > 1 and any(rows for _, rows in told):
                    jobs.append(([*contents], told, [int(n[at[0]]) for at in contents.values()]))
            i = np.array(whole, np.int64)
            out.append((i, np.zeros(len(i), np.int64), n[i].astype(np.int64)))
            found = [(r, place) for r, place, _ in compare(jobs)]
            if found:
                out.append(in_runs(*(np.array(x, np.int64) for x in zip(*found))))
            i, first, count = (np.concatenate(x) for x in zip(*out))
            if len(i):
                # every place of the row's windows
                offsets, flat = starts.offsets.to_numpy().astype(np.int64), starts.values.to_numpy()
                size = offsets[i + 1] - offsets[i]
                at = np.repeat(offsets[i] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                i, first, count = (np.repeat(x, size) for x in (i, first, count))
                a = flat[at] + first
                yield pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(th[i]), pa.array(a), pa.array(a + count - 1 + kind.width)], ["doc", "th", "a", "z"])

    return run


def dealt(df: DataFrame, tag: str, n: int, *by: str) -> DataFrame:
    """Writes df to a table in n buckets of by in the shared folder and reads that:
    joins on by do not move it again."""
    spark: SparkSession = df.sparkSession
    name = f"emberlane_{tag}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").bucketBy(n, *by).saveAsTable(name)
    return spark.table(name)


def marked(docs: DataFrame, kind: Kind, compare: Callable) -> DataFrame:
    """doc, th, text and marks (array of a, z: unit ranges to remove) of every row."""
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows(docs)
    packed = map_arrow(texts, _minimizers(kind, n_parts * BUCKETS), _PACKED)
    flagged = materialize(map_arrow(packed.repartition(n_parts, "bucket").sortWithinPartitions("bucket"), _repeated(kind), _FLAGGED), "window-keys")
    let_go(spark)
    hot = materialize(flagged.where("n is not null").select("key", F.lit(True).alias("hot"), "n"), "window-hot")
    wanted = flagged.where("n is null").select("key", "doc", "th")
    asked = heavy_join(wanted, hot, "key", "n", wanted.count(), "left").groupBy("doc", "th").agg(F.collect_set(F.struct("key", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
    table = dealt(texts.join(asked, ["doc", "th"], "left").select("doc", "th", "text", "asked"), "texts", n_parts, "doc", "th")
    let_go(spark)
    strings = map_arrow(table.where("asked is not null"), _cut(kind), _CUT)
    found = map_arrow(strings.repartition(n_parts, "key").sortWithinPartitions("key"), _marks(kind, compare), "doc long, th long, a long, z long")
    found = materialize(found, "window-marks")
    let_go(spark)
    marks = found.groupBy("doc", "th").agg(F.collect_set(F.struct("a", "z")).alias("marks"))
    return table.select("doc", "th", "text").join(marks, ["doc", "th"], "left")


def removed(n: int, ranges: list | None) -> np.ndarray:
    """Which of n units the ranges cover."""
    depth = np.zeros(n + 1, np.int64)
    if ranges is not None and len(ranges):
        a, z = np.array([r["a"] for r in ranges]), np.array([r["z"] for r in ranges])
        np.add.at(depth, a, 1)
        np.add.at(depth, z, -1)
    return np.cumsum(depth[:-1]) > 0


def hexdigest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
