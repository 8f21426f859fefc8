"""Tags texts with the names of a gazetteer of any size: one scan of the texts, and no
name on the driver or in a task.

Names are in classes by length: those of 2**c to 2**(c+1) - 1 characters are known by
the rolling hash of their first 2**c, and each by the hash of all of it. Both are told
to the tasks by a Bloom filter of bounded size (rolling.filter_of), and which pairs of
characters names begin with by a bit each of STARTS. A task hashes its texts once, asks
for the places where a name may begin whether a class knows what follows, and then for
the lengths of that class; what may be a name is sent, once an item, and meets the
names by a join on what it says, which Spark may broadcast, or deal and split if a name
is in very many texts. A full filter only sends more; the join decides.

Ways to look for a name:
- word: as a whole word, past case. Borders are those of ASCII word characters.
- exact: as a whole word in this spelling.
- part: anywhere, past case.
- phrase: anywhere, past case and accents.

Defined cases: a null or empty text holds no name; a null or empty name is in no
text; rows that repeat a name are all found; names are taken literally; rows of one
item are looked at each by itself.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlane.operators import rolling
from emberlane.session import materialize, ship

CHUNK = 1 << 18  # code points hashed at a time
AT_ONCE = 64  # rows whose texts a task holds at a time
WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")
# Letters that have no decomposition but differ from others by a stroke alone.
STROKES = {"ø": "o", "đ": "d", "ħ": "h", "ł": "l", "ŧ": "t", "æ": "ae", "œ": "oe", "ı": "i"}


class _Same(dict):
    """Code points to what they are past case; always one character."""

    def __missing__(self, c: int) -> str:
        upper = chr(c).upper()
        one = upper if len(upper) == 1 else chr(c)
        lower = one.lower()
        self[c] = lower if len(lower) == 1 else one
        return self[c]


class _Bare(dict):
    """Code points of decomposed text to what is left without accents."""

    def __missing__(self, c: int) -> str:
        self[c] = "" if unicodedata.category(chr(c)) == "Mn" else STROKES.get(chr(c), chr(c))
        return self[c]


_same, _bare = _Same(), _Bare()


def past_case(s: str) -> str:
    return s.lower() if s.isascii() else s.translate(_same)


def past_accents(s: str) -> str:
    return s.lower() if s.isascii() else unicodedata.normalize("NFD", s.casefold()).translate(_bare)


FOLDS = {"word": past_case, "exact": str, "part": past_case, "phrase": past_accents}
WAYS = list(FOLDS)
STARTS = 1 << 16  # what a name may begin with, by its first two characters
COMMON = 0x3000  # code points that are folded by table
_IS_WORD = np.zeros(128, bool)
_IS_WORD[[ord(c) for c in WORD]] = True
_NOT_ONE = 0xFFFFFFFF  # folds to no or to several characters
_tables: dict[str, np.ndarray] = {}


def _fold_table(way: str) -> np.ndarray:
    key = "case" if FOLDS[way] is past_case else way
    if key not in _tables:
        told = [FOLDS[way](chr(c)) for c in range(COMMON)]
        _tables[key] = np.array([ord(x) if len(x) == 1 else _NOT_ONE for x in told], np.uint32)
    return _tables[key]


class Folded:
    """Texts end to end as code points, folded: where each begins and ends."""

    def __init__(self, texts: list[str], raw: np.ndarray, size: np.ndarray, way: str):
        points = raw if way == "exact" else _fold_table(way)[np.minimum(raw, COMMON - 1)]
        if way != "exact":
            owner = np.repeat(np.arange(len(texts)), size)
            odd = np.unique(owner[(raw >= COMMON) | (points == _NOT_ONE)]).tolist()
            if odd:
                end = np.cumsum(size)
                parts, size, last = [], size.copy(), 0
                for i in odd:  # these texts by themselves
                    mine = rolling.points(FOLDS[way](texts[i]))
                    parts += [points[last : end[i] - size[i]], mine]
                    last = int(end[i])
                    size[i] = len(mine)
                # ends above are those before any text changed its size
                points = np.concatenate([*parts, points[last:]])
        self.points, self.size, self.end = points, size, np.cumsum(size)
        self.first, self.last = self.end - size, np.repeat(self.end, size)
        self.owner = np.repeat(np.arange(len(texts)), size)
        self.hashes = rolling.Rolling(points)
        # the first two characters of what begins at each place, in the same text or not
        self.start = (points * np.uint32(31) + np.append(points[1:], np.uint32(0))).astype(np.uint32) & np.uint32(STARTS - 1) if len(points) else points

    def cut(self, at: int, n: int) -> str:
        return self.points[at : at + n].tobytes().decode("utf-32-le", "surrogatepass")


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The form under which each name is looked for; null for none."""
    for b in batches:
        i = b.schema.get_field_index("_form")
        forms = [FOLDS[way](name) or None if name else None for name, way in zip(b.column("_form").to_pylist(), b.column("_way").to_pylist())]
        yield b.set_column(i, "_form", pa.array(forms, pa.string()))


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_way and, of each batch's forms, what they begin with; -1 - c of the single character c."""
    for b in batches:
        told = {(w, (ord(f[0]) * 31 + ord(f[1])) & (STARTS - 1) if len(f) > 1 else -1 - (ord(f) & (STARTS - 1))) for w, f in zip(b.column("_way").to_pylist(), b.column("_form").to_pylist())}
        ways, starts = zip(*sorted(told)) if told else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(ways, pa.string()), pa.array(starts, pa.int32())], ["_way", "start"])


def _known(batch: pa.RecordBatch) -> np.ndarray:
    """Hashes of a batch of forms (_way, _form): of what they begin with, and of all."""
    ways, forms = batch.column("_way").to_pylist(), batch.column("_form").to_pylist()
    sizes = np.array([len(f) for f in forms], np.int64)
    text = rolling.Rolling(rolling.points("".join(forms)))
    start = np.cumsum(sizes) - sizes
    out = [np.zeros(0, np.uint64)]
    for way in WAYS:
        mine = np.array([w == way for w in ways], bool)
        for n in np.unique(sizes[mine]).tolist():
            at = start[mine & (sizes == n)]
            out += [text.spans(at, 1 << (n.bit_length() - 1), WAYS.index(way)), text.spans(at, n, WAYS.index(way) + len(WAYS))]
    return np.concatenate(out)


def _places(texts: list[str], lengths: dict[str, list[int]], starts: dict[str, np.ndarray], known: rolling.Filter) -> Iterator[tuple[str, int, np.ndarray, np.ndarray, Folded]]:
    """way, length, places and hashes of what may be a name, and the texts as looked at."""
    raw = rolling.points("".join(texts))
    size = np.array([len(t) for t in texts], np.int64)
    folded: dict[object, Folded] = {}
    begins = ends = None
    for way, sizes in lengths.items():
        f = folded.setdefault(FOLDS[way], None) or Folded(texts, raw, size, way)
        folded[FOLDS[way]] = f
        two, one = starts[way][:STARTS], starts[way][STARTS:]
        start = two[f.start]
        if one.any():
            start |= one[f.points & np.uint32(STARTS - 1)]
        whole = way in ("word", "exact")  # borders are those of the text as it is: folding keeps places
        if whole and begins is None:
            is_word = _IS_WORD[np.minimum(raw, 127)] & (raw < 128)
            before = np.append(False, is_word[:-1])[: len(raw)]
            before[f.first[f.first < len(raw)]] = False
            after = np.append(is_word[1:], False)[: len(raw)]
            after[f.end[size > 0] - 1] = False
            begins, ends = before != is_word, after != is_word
        every = np.flatnonzero(start & begins if whole else start)
        salt = WAYS.index(way)
        for width in sorted({1 << (n.bit_length() - 1) for n in sizes}):
            at = every[every + width <= f.last[every]]
            at = at[known.holds(f.hashes.spans(at, width, salt))]
            for n in sizes:
                if not width <= n < 2 * width or not len(at):
                    continue
                here = at[at + n <= f.last[at]]
                if whole:
                    here = here[ends[here + n - 1]]
                h = f.hashes.spans(here, n, salt + len(WAYS))
                hit = known.holds(h)
                if len(hit):
                    yield way, n, here[hit], h[hit], f


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str], list[int]]]:
    """Items, texts, and of each text the row of its item: whole rows, of CHUNK code
    points or one row, so that what a task holds does not grow with its batches."""
    for whole in batches:
        for start in range(0, whole.num_rows, AT_ONCE):
            b = whole.slice(start, AT_ONCE)
            texts, rows, size = [], [], 0
            for i, cells in enumerate(zip(*(c.to_pylist() for c in b.columns[1:]))):
                if size >= CHUNK:
                    yield b.column(0), texts, rows
                    texts, rows, size = [], [], 0
                for cell in cells:
                    for text in cell if isinstance(cell, list) else (cell,):
                        if text:
                            texts.append(text)
                            rows.append(i)
                            size += len(text)
            if texts:
                yield b.column(0), texts, rows


def _candidates(sent, lengths: dict[str, list[int]]):
    """(item, way, form) of what may be a name, once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table, starts = sent.value
        known = rolling.Filter(bits, table)
        for items, texts, rows in _chunks(batches):
            row = np.array(rows, np.int64)
            for way, n, place, h, f in _places(texts, lengths, starts, known):
                mine = row[f.owner[place]]
                order = np.lexsort((h, mine))
                one = order[np.append(True, (h[order[1:]] != h[order[:-1]]) | (mine[order[1:]] != mine[order[:-1]]))]
                # a 64-bit hash stands for one form in a chunk; rows are whole here, so none is told twice
                _, first, which = np.unique(h[one], return_index=True, return_inverse=True)
                forms = pa.array([f.cut(p, n) for p in place[one[first]].tolist()], pa.string()).take(pa.array(which.reshape(-1)))
                yield pa.RecordBatch.from_arrays([items.take(pa.array(mine[one])), pa.array([way], pa.string()).take(pa.array(np.zeros(len(one), np.int64))), forms], ["item", "_way", "_form"])

    return run


def found(items: DataFrame, names: DataFrame, texts: list[str], ways: Column, spelled: Column | None = None) -> DataFrame:
    """(item, names' columns) where one of the item's texts (strings, or arrays of
    them) holds the name, looked for in one of its ways (an array), as its column
    match or as spelled. One row for each item, row of names, and way."""
    spark = items.sparkSession
    ship(spark)
    known = names.withColumn("_form", F.col("match") if spelled is None else spelled).withColumn("_way", F.explode(ways))
    known = materialize(known.mapInArrow(_spelled, known.schema).where("_form is not null"), "names")
    forms = known.select("_way", "_form").distinct()
    sizes = known.groupBy("_way", F.length("_form").alias("n")).count().collect()  # a row for each length that names have
    lengths = {w: sorted(r["n"] for r in sizes if r["_way"] == w) for w in WAYS if any(r["_way"] == w for r in sizes)}
    starts = {w: np.zeros(2 * STARTS, bool) for w in WAYS}
    for r in forms.mapInArrow(_beginnings, "_way string, start int").distinct().collect():  # 2 * STARTS a way at most
        starts[r["_way"]][r["start"] if r["start"] >= 0 else STARTS - 1 - r["start"]] = True
    sent = spark.sparkContext.broadcast((*rolling.filter_of(forms, 2 * sum(r["count"] for r in sizes), _known), starts))
    schema = T.StructType([items.schema["item"], T.StructField("_way", T.StringType()), T.StructField("_form", T.StringType())])
    maybe = items.select("item", *texts).mapInArrow(_candidates(sent, lengths), schema)
    return maybe.join(known, ["_way", "_form"]).select("item", *names.columns)


def whole_words(items: DataFrame, names: DataFrame, texts: list[str], case_sensitive: bool = False) -> DataFrame:
    """(item, names' columns) where one of the item's texts holds the name as a whole word."""
    return found(items, names, texts, F.array(F.lit("exact" if case_sensitive else "word")))


def contained(items: DataFrame, names: DataFrame, texts: list[str], way: str = "part") -> DataFrame:
    return found(items, names, texts, F.array(F.lit(way)))


def refname_tags(items: DataFrame, names: DataFrame, texts: list[str]) -> DataFrame:
    """Whole word, or phrase past case and accents."""
    return found(items, names, texts, F.array(F.lit("word"), F.lit("phrase"))).distinct()


city_tags = refname_tags


def owner_tags(items: DataFrame, names: DataFrame, texts: list[str]) -> DataFrame:
    """Names under 8 characters as whole words, others as substrings, those over
    10 also past accents; 'Total' only as Total or TOTAL."""
    total, n = F.lower("match") == "total", F.length("match")
    way = lambda *ways: F.array(*[F.lit(w) for w in ways])
    ways = F.when(total, way("exact")).when(n < 8, way("word")).when(n > 10, way("part", "phrase")).otherwise(way("part"))
    spelled = names.withColumn("_spelled", F.explode(F.when(total, F.array(F.lit("Total"), F.lit("TOTAL"))).otherwise(F.array("match"))))
    return found(items, spelled, texts, ways, F.col("_spelled")).select("item", *names.columns).distinct()


def event_tags(items: DataFrame, keywords: DataFrame, texts: list[str], hashtags: str | None = None) -> DataFrame:
    """Keywords in the texts as whole words, or inside one of the hashtags."""
    out = whole_words(items, keywords, texts)
    return (out.unionByName(contained(items, keywords, [hashtags])) if hashtags else out).distinct()


def collected(items: DataFrame, tags: DataFrame, field: str, value: Column) -> DataFrame:
    """items with the sorted distinct values of their tags in field; empty if none."""
    per = tags.groupBy("item").agg(F.sort_array(F.collect_set(value)).alias(field))
    joined = items.drop(field).join(per, "item", "left")
    return joined.withColumn(field, F.coalesce(F.col(field), F.array().cast(per.schema[field].dataType)))


def without_overlaps(tags: Column) -> Column:
    """Of tags with more than one initial, those whose match lies inside a longer match of the same array go."""
    longer = lambda x: F.exists(tags, lambda y: (F.length(y["match"]) > F.length(x["match"])) & F.contains(F.lower(y["match"]), F.lower(x["match"])))
    several = F.size(F.array_distinct(F.transform(tags, lambda t: t["initial"]))) > 1
    return F.when(several, F.filter(tags, lambda x: ~longer(x))).otherwise(tags)
