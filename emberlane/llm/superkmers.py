"""Substring dedup by super-k-mer partitioning: a word goes if it lies in a
window of 13 words whose sequence also starts in a document of a smaller doc_id.

Consecutive windows that share a minimizer (of MINIMIZER words) travel as one
packed string, words joined by one space, to the minimizer's bucket. There the
windows are cut out of the strings again, sorted, and runs of equal windows are
compared by document, byte for byte. See windows.py for how the strings of
windows that are proven unique stay at home, and how windows of common minimizers
are dealt one by one, which are compared by a cryptographic digest.

Defined cases: a null text has no words; texts under 13 words lose nothing;
rows that repeat a doc_id are judged apart, and no row's windows make those of
the same doc_id go; a null doc_id comes after all others; an empty table gives
an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberlane.llm.common import map_arrow
from emberlane.llm.textarrays import words_of
from emberlane.llm.windows import NO_ID, Kind, Units, hexdigest, marked, removed

WINDOW, MINIMIZER = 13, 5


def units(data: np.ndarray, offsets: np.ndarray) -> Units:
    w = words_of(data, offsets)
    raw = data.tobytes()

    def cut(a: int, z: int) -> bytes:
        return b" ".join(raw[w.start[a] : w.end[z - 1]].split())

    return Units(w.hash, w.first, cut)


KIND = Kind(WINDOW, MINIMIZER, True, units)


def compare(jobs: list) -> Iterator[tuple[int, int, int]]:
    """Sorts the windows of each bucket; in a run of equals, those of later
    documents than the first are repeats. (A digest is its one window.)"""
    for contents, told, counts in jobs:
        rows = []
        for c, (content, count) in enumerate(zip(contents, counts)):
            words = content.split(b" ")
            if len(words) == WINDOW + count - 1:
                rows += [(b" ".join(words[i : i + WINDOW]), told[c][0], c, i) for i in range(count)]
        rows.sort()
        last, least = None, 0
        for window, doc, c, i in rows:
            if window != last:
                last, least = window, doc
            elif doc > least:
                for r in told[c][1]:
                    yield r, i, 1


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc, text, marks in zip(b.column("doc").to_pylist(), b.column("text").to_pylist(), b.column("marks").to_pylist()):
            words = (text or "").encode().split()
            gone = removed(len(words), marks) if marks else None
            kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
            out.append((None if doc == NO_ID else doc, len(words), len(words) - len(kept), hexdigest(b" ".join(kept))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, [pa.int64(), pa.int64(), pa.int64(), pa.string()])], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row."""
    return map_arrow(marked(docs, kind, compare).select("doc", "text", "marks"), _report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


SQL = f"""
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) i from d where len(w) >= {WINDOW}),
g as (select doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') g from p),
r as (select doc_id, i, doc_id > min(doc_id) over (partition by g) gone from g),
x as (select distinct doc_id, unnest(range(i, i + {WINDOW})) i from r where gone),
e as (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) i from d),
k as (select e.doc_id, count(*) filter (x.i is not null) n_removed, string_agg(word, ' ' order by e.i) filter (x.i is null) kept from e left join x on e.doc_id = x.doc_id and e.i = x.i group by e.doc_id)
select d.doc_id, len(w)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join k on d.doc_id = k.doc_id"""
