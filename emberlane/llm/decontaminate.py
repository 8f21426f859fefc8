"""Benchmark decontamination: suffix arrays of the training words, in which every
suffix of the benchmark is looked up.

A shard is some SHARD bytes of whole documents. Its words that occur in the benchmark
at all are numbered as there; other words, and the ends of documents, end a run, and
runs too short for any window are left out, since no match reaches past them. The
suffixes of the runs are sorted by prefix doubling. All suffixes of the benchmark are
looked up side by side: a suffix's range in the array narrows word by word, by binary
search. Its range at the window's depth holds all places of the window; from there it
narrows on until it is empty, and each place keeps the most words with which it
matched (places leave a range once, and suffixes that share a range share the walk, so
no pairs of places and suffixes are made).

Documents are never moved: a document's result is made where it is read. What each
task holds of the benchmark is broadcast, PART bytes of it (or a single item) at a
time; a larger benchmark takes a pass over the documents for each part, and each pass
adds to the written result of the last.

Windows are WINDOW consecutive words of an item, or all words of a shorter one. Words
are told apart by a 64-bit hash, their length and their first and last eight bytes.

Defined cases: a null text has no words; an item without words has no window; items
that repeat an item_id are one item, and those of a null one are one whose name is
empty; rows that repeat a doc_id are documents apart; a null doc_id is kept as null;
an empty table of documents gives an empty result, an empty benchmark finds nothing;
other columns are left out (`decontaminated` keeps them, whatever their names).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from emberlane.llm.common import map_arrow, materialize, slices, utf8
from emberlane.llm.textarrays import LOWER, Words, signs, suffix_order, words_of

WINDOW = 10
SHARD = 8 << 20
PART = 16 << 20
# [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing A-Z
OUTSIDE = np.ones(256, bool)
OUTSIDE[0x30:0x3A] = OUTSIDE[0x61:0x7B] = OUTSIDE[0x80:] = False


def lower_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words]:
    data = LOWER[data]
    return data, words_of(data, offsets, OUTSIDE)


@dataclass
class Tests:
    """A part of the benchmark: its vocabulary, its words by number, and its suffixes."""

    hash: np.ndarray  # of the vocabulary, sorted
    sign: np.ndarray
    known: np.ndarray  # a bit for the low bits of each hash
    ids: np.ndarray  # of all words, item after item
    start: np.ndarray  # suffixes that begin with a window
    end: np.ndarray
    window: np.ndarray  # words of each suffix's window
    name: np.ndarray  # number of each suffix's item among names
    names: list[str]

    @classmethod
    def of(cls, items: pa.Table, window: int = WINDOW) -> Tests:
        names = [x or "" for x in items.column("item").to_pylist()]
        distinct = sorted(set(names))
        number = {x: i for i, x in enumerate(distinct)}
        data, w = lower_words(*utf8(items.column("text")))
        vocabulary, first, ids = np.unique(w.hash, return_index=True, return_inverse=True)
        known = np.zeros(1 << 20, bool)
        known[vocabulary & np.uint64(known.size - 1)] = True
        sizes = np.diff(w.first)
        item = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(item)) - w.first[item]
        begins = np.flatnonzero((place == 0) | (place + window <= sizes[item]))
        return cls(
            vocabulary, signs(data, w)[first], known, ids, begins, w.first[item[begins] + 1], np.minimum(sizes[item[begins]], window),
            np.array([number[x] for x in names], np.int64)[item[begins]], distinct,
        )


def _numbered(data: np.ndarray, w: Words, t: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Words of the shard that are in the vocabulary: which, and their numbers."""
    at = np.flatnonzero(t.known[w.hash & np.uint64(t.known.size - 1)])
    number = np.minimum(np.searchsorted(t.hash, w.hash[at]), len(t.hash) - 1)
    same = t.hash[number] == w.hash[at]
    at, number = at[same], number[same]
    some = Words(w.hash[at], w.start[at], w.end[at], w.first)
    same = (signs(data, some) == t.sign[number]).all(1)
    return at[same], number[same]


def _narrow(ids: np.ndarray, end: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range of suffixes, equal in their first depth words, that whose next word is word."""

    def bound(after: bool) -> np.ndarray:
        a, z = lo.copy(), hi.copy()
        while len(i := np.flatnonzero(a < z)):
            mid = (a[i] + z[i]) // 2
            p = order[mid]
            there = p + depth
            value = np.where(there < end[p], ids[np.minimum(there, len(ids) - 1)], -1)
            up = value <= word[i] if after else value < word[i]
            a[i[up]] = mid[up] + 1
            z[i[~up]] = mid[~up]
        return a

    return bound(False), bound(True)


def look_up(ids: np.ndarray, end: np.ndarray, t: Tests) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """For runs of numbered words: the most words with which a place matches a suffix
    of the benchmark (0: no window begins there); the most that a window covers from
    there; and, of each window's length, ranges: places, which range each, and (range, item)."""
    longest, covers = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(ids) or not len(t.start):
        return longest, covers, found
    order = suffix_order(ids, end, int((t.end - t.start).max()))
    suffix = np.arange(len(t.start))
    lo, hi = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(ids))
    depth = 0

    def leave(a: np.ndarray, z: np.ndarray) -> None:
        """Places that leave at this depth."""
        size = z - a
        if total := int(size.sum()):
            at = order[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(total)]
            np.maximum.at(longest, at, depth)

    while len(suffix):
        here = t.window[suffix] == depth
        if here.any():
            pairs = np.unique(np.stack([lo[here], t.name[suffix[here]]], 1), axis=0)
            heads, which = np.unique(pairs[:, 0], return_inverse=True)
            ends = np.zeros(len(heads), np.int64)
            ends[np.searchsorted(heads, lo[here])] = hi[here]
            size = ends - heads
            places = order[np.repeat(heads - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            covers[places] = np.maximum(covers[places], depth)
            found.append((places, np.repeat(np.arange(len(heads)), size), np.stack([which, pairs[:, 1]], 1)))
        over = t.start[suffix] + depth >= t.end[suffix]
        told = over & (depth >= t.window[suffix])
        leave(*np.unique(np.stack([lo[told], hi[told]], 1), axis=0).T)
        suffix, lo, hi = suffix[~over], lo[~over], hi[~over]
        if not len(suffix):
            break
        a, z = _narrow(ids, end, order, lo, hi, depth, t.ids[t.start[suffix] + depth])
        gone = np.unique(np.stack([lo, a, np.maximum(a, z), hi], 1)[(depth >= t.window[suffix]) & (depth > 0)], axis=0)
        leave(np.concatenate([gone[:, 0], gone[:, 2]]), np.concatenate([gone[:, 1], gone[:, 3]]))
        left = a < z
        suffix, lo, hi = suffix[left], a[left], z[left]
        depth += 1
    return longest, covers, found


def scan(data: np.ndarray, offsets: np.ndarray, t: Tests) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, int, list[str]]]]:
    """Words of each document, and of those that hold a window: which words are hit,
    the longest match, and the items."""
    data, w = lower_words(data, offsets)
    n_words = np.diff(w.first)
    out: dict[int, tuple[np.ndarray, int, list[str]]] = {}
    if not len(t.start) or not len(w.hash):
        return n_words, out
    at, number = _numbered(data, w, t)
    doc = np.searchsorted(w.first, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(at)))
    keep = np.repeat(size >= int(t.window.min()), size)
    size = size[size >= int(t.window.min())]
    at, number, doc = at[keep], number[keep], doc[keep]
    longest, covers, found = look_up(number, np.repeat(np.cumsum(size), size), t)
    hit = np.flatnonzero(covers)
    if not len(hit):
        return n_words, out
    depth = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(depth, at[hit], 1)
    np.add.at(depth, at[hit] + covers[hit], -1)
    covered = np.cumsum(depth[:-1]) > 0
    ranges: dict[int, list[tuple[int, int]]] = {}
    items: list[list[np.ndarray]] = []
    for k, (places, which, pairs) in enumerate(found):
        items.append(np.split(pairs[:, 1], np.flatnonzero(np.diff(pairs[:, 0])) + 1))
        for d, r in np.unique(np.stack([doc[places], which], 1), axis=0).tolist():
            ranges.setdefault(d, []).append((k, r))
    most = np.zeros(len(n_words), np.int64)
    np.maximum.at(most, doc, longest)
    told: dict[tuple, list[str]] = {}
    for d, got in ranges.items():
        key = tuple(got)
        if key not in told:
            told[key] = [t.names[i] for i in np.unique(np.concatenate([items[k][r] for k, r in key]))]
        out[d] = covered[w.first[d] : w.first[d + 1]], int(most[d]), told[key]
    return n_words, out


def _shards(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    data, offsets = utf8(text)
    for a, z in slices(np.diff(offsets), SHARD):
        yield data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a], a


def runs_of(covered: np.ndarray) -> list[int]:
    """Where runs of hit words begin and end, in turn."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return edge.tolist()


_FOUND = StructType().add("n_words", LongType()).add("runs", ArrayType(IntegerType())).add("items", ArrayType(StringType())).add("longest", IntegerType())
_FOUND_TYPE = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("longest", pa.int32())])


def _merged(runs: list[int], more: list[int]) -> list[int]:
    out: list[int] = []
    for a, z in sorted([*zip(runs[::2], runs[1::2]), *zip(more[::2], more[1::2])]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], z)
        else:
            out += [a, z]
    return out


def _marked(sent, before: bool, last: bool):
    """Adds the column _found; before: to what an earlier part found. The last part
    leaves the text out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tests(**sent.value)
        for b in batches:
            rows: list[dict | None] = []
            for data, offsets, _ in _shards(b.column("_text")):
                n_words, got = scan(data, offsets, t)
                for i, n in enumerate(n_words.tolist()):
                    hit, longest, items = got.get(i, (None, 0, []))
                    rows.append({"n_words": n, "runs": [] if hit is None else runs_of(hit), "items": items, "longest": longest})
            if before:
                old = b.column("_found").to_pylist()
                rows = [n | {"runs": _merged(o["runs"], n["runs"]), "items": sorted({*o["items"], *n["items"]}), "longest": max(o["longest"], n["longest"])} for o, n in zip(old, rows)]
            kept = [i for i, c in enumerate(b.schema.names) if c != "_found" and not (last and c == "_text")]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(rows, _FOUND_TYPE)], [*(b.schema.names[i] for i in kept), "_found"])

    return run


def parts(items: DataFrame, most: int = PART) -> list[pa.Table]:
    """The benchmark in parts of about most bytes, each a bounded table."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / most)) if total > most else 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [rows.where(part == i) for i in range(n)]


def _scanned(docs: DataFrame, items: DataFrame, window: int, most: int) -> DataFrame:
    """docs (a column _text, and any others) with _found."""
    spark = docs.sparkSession
    fields, found = docs.schema, StructType().add("_found", _FOUND)
    todo = parts(items, most)
    for i, part in enumerate(todo):
        last = i + 1 == len(todo)
        sent = spark.sparkContext.broadcast(vars(Tests.of(part.toArrow(), window)))
        docs = map_arrow(docs, _marked(sent, i > 0, last), StructType([*(f for f in fields if not (last and f.name == "_text")), *found]))
        if not last:
            docs = materialize(docs, "decontaminate")
    return docs


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = PART) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest
    (words of the longest verbatim match), runs (where each run of hit words begins and
    ends, by word) and items."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    f = _scanned(rows, items, window, most).select("doc_id", "_found.*")
    n_hit = F.aggregate(F.transform("runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    names = F.array_join(F.array_sort("items"), ",")
    return f.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), F.col("longest").cast("long").alias("longest"), "runs", "items")


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = PART) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns."""
    held = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    return _scanned(held, items, window, most).where(F.size("_found.items") == 0).select("_row.*")


SQL = rf"""
with d as (select doc_id, row_number() over () r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select coalesce(item_id::varchar, '') item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
t as (select distinct item, least(len(w), {WINDOW}) k, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') g from b, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) u(i) where len(w) > 0),
k as (select distinct k from t),
p as (select r, i, k, array_to_string(w[i:i + k - 1], ' ') g from (select r, w, k, unnest(range(1, len(w) - k + 2)) i from d, k)),
h as (select r, i, p.k, item from p join t on p.g = t.g and p.k = t.k),
n as (select r, count(distinct j) n from (select distinct r, unnest(range(i, i + k)) j from h) group by r),
m as (select r, count(distinct item) c, string_agg(distinct item, ',' order by item) ids from h group by r)
select doc_id, len(w)::bigint n_words, coalesce(n.n, 0)::bigint n_hit, coalesce(m.c, 0)::bigint n_items, sha256(coalesce(m.ids, '')) items_sha256, n.n is not null contaminated from d left join n using (r) left join m using (r)"""
