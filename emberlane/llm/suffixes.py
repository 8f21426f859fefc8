"""Suffix-array dedup: a byte goes if it lies in a 200-byte string that also
starts anywhere else in the corpus, same document included.

Strings meet in the buckets of their minimizers (MINIMIZER bytes; see
windows.py). What could be equal in a bucket is sorted as suffixes: mergesort
whose comparisons find the common extension of two suffixes by binary search
over prefix polynomial hashes, in log2(200) steps, and then look at one byte.
Neighbours in that order whose common extension reaches 200 bytes are compared
byte for byte, so a collision of hashes marks nothing. Windows of minimizers with
over HOT occurrences are dealt one by one and compared by a cryptographic digest.

Defined cases: a null text is empty; texts under 200 bytes lose nothing;
strings never cross documents; rows that repeat a doc_id are documents apart,
and equal ones are each other's copies; a null doc_id is kept as null; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberlane.llm.common import map_arrow
from emberlane.llm.textarrays import Spans
from emberlane.llm.windows import NO_ID, Kind, Units, hexdigest, marked, removed

WINDOW, MINIMIZER = 200, 64


def units(data: np.ndarray, offsets: np.ndarray) -> Units:
    raw = data.tobytes()
    return Units(data, offsets, lambda a, z: raw[a:z])


KIND = Kind(WINDOW, MINIMIZER, False, units)


class Suffixes:
    """Suffixes of one buffer, compared over their first WINDOW bytes."""

    def __init__(self, data: np.ndarray):
        self.data, self.spans = data, Spans.over(data)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix, by binary search over prefix hashes."""
        long = self.spans.raw(x, x + WINDOW) == self.spans.raw(y, y + WINDOW)
        out = np.full(len(x), WINDOW)
        i = np.flatnonzero(~long)
        xi, yi, n = x[i], y[i], np.zeros(len(i), np.int64)
        step = 1 << (WINDOW - 1).bit_length() - 1
        while step:
            room = n + step < WINDOW
            a, b = xi + n, yi + n
            w = np.where(room, step, 0)
            same = room & (self.spans.raw(a, a + w) == self.spans.raw(b, b + w))
            n += np.where(same, step, 0)
            step >>= 1
        out[i] = n
        return out

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.extension(x, y)
        short = n < WINDOW
        at = np.where(short, n, 0)
        return np.where(short, self.data[x + at] < self.data[y + at], or_equal)

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Mergesort of the suffixes within each group (groups lie together): the
        order. All merges of a level advance at once; an item's place in a merged
        run is its place in its own run and its rank, by binary search, in the other."""
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(head, len(group)))
        base, count = np.repeat(head, size), np.repeat(size, size)
        order = np.arange(len(start))
        run = 1
        while run < size.max():
            place = np.arange(len(start)) - base  # of the item now at each index
            own = place // run
            lo = (own ^ 1) * run
            hi = np.minimum(lo + run, count)
            i = np.flatnonzero((lo < count) & (count > run))
            a, z = lo[i] + base[i], hi[i] + base[i]
            x, right = start[order[i]], (own[i] & 1).astype(bool)
            first = a.copy()
            while len(open_ := np.flatnonzero(a < z)):
                mid = (a[open_] + z[open_]) // 2
                y = start[order[mid]]
                # items of the right run go after equals of the left one
                before = self.less(y, x[open_], right[open_])
                a[open_[before]] = mid[before] + 1
                z[open_[~before]] = mid[~before]
            target = np.arange(len(start))
            target[i] = base[i] + (own[i] & ~1) * run + (place[i] - own[i] * run) + (a - first)
            moved = np.empty_like(order)
            moved[target] = order
            order, run = moved, run * 2
        return order

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether two windows agree byte for byte."""
        out = np.zeros(len(x), bool)
        for lo in range(0, len(x), 20_000):
            at = np.arange(WINDOW)
            out[lo : lo + 20_000] = (self.data[x[lo : lo + 20_000, None] + at] == self.data[y[lo : lo + 20_000, None] + at]).all(1)
        return out


def compare(jobs: list) -> list[tuple[int, int, int]]:
    """Marks the windows that two different strings of a bucket share. A window's
    place relative to its minimizer depends on its content, but strings begin at
    different places, so all windows of a bucket are sorted together."""
    strings, starts, groups, owner, place = [], [], [], [], []
    at = 0
    for g, (contents, told, counts) in enumerate(jobs):
        for c, (content, count) in enumerate(zip(contents, counts)):
            if len(content) != WINDOW + count - 1:  # a digest, equal to no other
                continue
            strings.append(content)
            starts.append(np.arange(at, at + count))
            groups.append(np.full(count, g))
            row = told[c][1][0] if told[c][1] else -1
            owner.append(np.full(count, row))
            place.append(np.arange(count))
            at += len(content)
    if not strings:
        return []
    start, group, owner, place = (np.concatenate(x) for x in (starts, groups, owner, place))
    s = Suffixes(np.frombuffer(b"".join(strings), np.uint8))
    # a suffix whose first WINDOW bytes have a hash of their own in the bucket needs no place in the order
    h = s.spans.raw(start, start + WINDOW)
    by = np.lexsort((h, group))
    same = (group[by[1:]] == group[by[:-1]]) & (h[by[1:]] == h[by[:-1]])
    keep = np.zeros(len(start), bool)
    keep[by[1:][same]] = keep[by[:-1][same]] = True
    if not keep.any():
        return []
    start, group, owner, place = start[keep], group[keep], owner[keep], place[keep]
    order = s.sort(start, group)
    x, y = start[order[:-1]], start[order[1:]]
    near = np.flatnonzero(group[order[:-1]] == group[order[1:]])
    near = near[s.spans.raw(x[near], x[near] + WINDOW) == s.spans.raw(y[near], y[near] + WINDOW)]
    near = near[s.equal(x[near], y[near])]
    twice = np.zeros(len(start), bool)
    twice[order[near]] = twice[order[near + 1]] = True
    i = np.flatnonzero(twice & (owner >= 0))
    return list(zip(owner[i].tolist(), place[i].tolist(), [1] * len(i)))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc, text, marks in zip(b.column("doc").to_pylist(), b.column("text").to_pylist(), b.column("marks").to_pylist()):
            data = (text or "").encode()
            kept, n_spans = data, 0
            if marks:
                gone = removed(len(data), marks)
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            out.append((None if doc == NO_ID else doc, len(data), len(data) - len(kept), n_spans, hexdigest(kept)))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    return map_arrow(marked(docs, kind, compare).select("doc", "text", "marks"), _report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
