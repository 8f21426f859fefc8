"""Clusters of items: sessions in time, split by events and by the asset that
most of a session agrees on."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlane.operators.sessions import time_sessions
from emberlane.session import materialize, ship

MARK = "\x1f"  # between the events of a kind


def similarity(pairs: DataFrame, corr: DataFrame) -> DataFrame:
    """(a, b, sim): mean correlation over all pairs of their events; 0 if one has
    none. pairs: a, ea, b, eb (arrays of events); a pair of events that corr does
    not name is 0, of equal ones 1."""
    n = F.size("ea") * F.size("eb")
    each = pairs.select("a", "b", n.alias("n"), F.explode_outer("ea").alias("event_a"), "eb").select("a", "b", "n", "event_a", F.explode_outer("eb").alias("event_b"))
    value = F.coalesce("corr", F.when(F.col("event_a") == F.col("event_b"), 1.0).otherwise(0.0))
    return each.join(corr, ["event_a", "event_b"], "left").groupBy("a", "b").agg(F.coalesce(F.sum(value) / F.nullif(F.first("n"), F.lit(0)), F.lit(0.0)).alias("sim"))


BLOCK = 1024  # kinds compared with all others at a time


class Kinds:
    """Kinds (tuples of events) of some sessions, and which are alike."""

    def __init__(self, kinds: list[tuple[str, ...]], corr: dict[tuple[str, str], float]):
        words = sorted({e for k in kinds for e in k})
        matrix = np.array([[corr.get((a, b), float(a == b)) for b in words] for a in words]).reshape(len(words), len(words))
        place = {e: i for i, e in enumerate(words)}
        self.share = np.zeros((len(kinds), len(words)))
        for row, k in enumerate(kinds):
            for e in k:
                self.share[row, place[e]] += 1
        self.size, self.weighed = self.share.sum(1), self.share @ matrix

    def alike(self, some: np.ndarray, threshold: float) -> list[np.ndarray]:
        """For each of some kinds, which of them have a mean correlation with it above
        the threshold. A pair of events that corr, a symmetric matrix, does not name is
        0, of equal ones 1. Kinds are compared by blocks: only the alike are kept."""
        out: list[np.ndarray] = []
        other, size = self.share[some].T, self.size[some]
        for lo in range(0, len(some), BLOCK):
            each = np.outer(size[lo : lo + BLOCK], size)
            mean = np.divide(self.weighed[some[lo : lo + BLOCK]] @ other, each, out=np.zeros_like(each), where=each > 0)
            out += [np.flatnonzero(row) for row in mean > threshold]
        return out


def grouped(t: np.ndarray, kind: np.ndarray, like: np.ndarray | list[np.ndarray], close: int) -> tuple[np.ndarray, int]:
    """like: for each kind, which kinds are like it, by number or as a row of flags.
    The group of each item in order of time t, and how many groups there were. An
    item's neighbours are itself, the items less than close away, and those of a kind
    like its own. An item in no group brings its neighbours to the first group that
    holds one of them, or to a new one; an item of several groups is in the last.
    Neighbours are a range of t and whole kinds, and an item that opens is in no
    range of another, so the work is in the number of items and not of pairs."""
    at = np.arange(len(t))
    a, z = np.minimum(np.searchsorted(t, t - close, "right"), at), np.maximum(np.searchsorted(t, t + close, "left"), at + 1)
    none = len(t)
    first, last = np.full(len(t), none), np.full(len(t), -1)  # of an item, by ranges
    kind_first, kind_last = np.full(len(like), none), np.full(len(like), -1)  # of whole kinds
    met = np.full(len(like), none)  # the first group that any item of the kind is in
    near = [np.flatnonzero(row) if row.dtype == bool else row for row in map(np.asarray, like)]
    groups = 0
    for i in range(len(t)):
        if last[i] >= 0 or kind_last[kind[i]] >= 0:
            continue
        span, kinds = slice(a[i], z[i]), near[kind[i]]
        g = int(min(first[span].min(), kind_first[kind[span]].min(), met[kinds].min(initial=none)))
        if g == none:
            g, groups = groups, groups + 1
        first[span], last[span] = np.minimum(first[span], g), np.maximum(last[span], g)
        np.minimum.at(met, kind[span], g)
        for low, high in ((kind_first, kind_last), (met, kind_last)):
            low[kinds], high[kinds] = np.minimum(low[kinds], g), np.maximum(high[kinds], g)
    return np.maximum(last, kind_last[kind]), groups


def changes(table: pa.Table, by: list[str]) -> np.ndarray:
    """Where a row's values of by differ from those of the row before; nulls are equal."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in by:
        c = table.column(name).combine_chunks()
        x, y = c.slice(1), c.slice(0, len(c) - 1)
        same = pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y)))
        new[1:] |= ~same.to_numpy(zero_copy_only=False)
    return new


def whole_groups(batches: Iterable[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Batches sorted by by, recut so that no group is split."""
    held: pa.Table | None = None
    for b in batches:
        held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        cut = int(np.flatnonzero(changes(held, by))[-1]) if held.num_rows else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def subsplit(items: DataFrame, by: list[str], ts: str, item: str, events: str, corr: dict[tuple[str, str], float], threshold: float, close_seconds: float) -> DataFrame:
    """(by, item, sub, subs): greedy groups within each group of by. Assignment depends
    on order, so a group of by is one task's; but items of one time and the same
    events always fare alike, so a row for each such pair is all that goes there.
    corr is a vocabulary's matrix, of fixed size."""
    tags = F.array_join(F.sort_array(F.coalesce(events, F.array().cast("array<string>"))), MARK)
    rows = items.select(*by, ts, item, tags.alias("_tags"))
    distinct = rows.groupBy(*by, ts, "_tags").agg(F.min(item).alias("_item"))
    keys = [*by, ts, "_tags"]
    schema = distinct.select(*keys).withColumns({"sub": F.lit(0), "subs": F.lit(0)}).schema
    close = round(close_seconds * 1e6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, by):
            t = table.column(ts).cast(pa.timestamp("us")).cast(pa.int64()).to_numpy()
            coded = table.column("_tags").combine_chunks().dictionary_encode()
            kinds, kind = [tuple(x.split(MARK)) if x else () for x in coded.dictionary.to_pylist()], coded.indices.to_numpy()
            known = Kinds(kinds, corr)
            sub, subs = np.zeros(len(t), np.int32), np.ones(len(t), np.int32)
            starts = np.append(np.flatnonzero(changes(table, by)), len(t))
            for a, z in zip(starts, starts[1:]):
                if z - a > 1:
                    some, mine = np.unique(kind[a:z], return_inverse=True)
                    sub[a:z], subs[a:z] = grouped(t[a:z], mine, known.alike(some, threshold), close)
            yield from table.select(keys).append_column("sub", pa.array(sub)).append_column("subs", pa.array(subs)).to_batches()

    ship(items.sparkSession)
    found = distinct.repartition(*by).sortWithinPartitions(*by, ts, "_item").mapInArrow(run, schema)
    told = found.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "sub", "subs")
    return rows.join(told, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]).select(*by, item, "sub", "subs")


def session_kinds(sessions: DataFrame, by: list[str], ids: str) -> DataFrame:
    """by, n, homogeneous (all id arrays equal), unambiguous (items of one id)."""
    same = F.min(F.to_json(F.struct(ids))) == F.max(F.to_json(F.struct(ids)))
    return sessions.groupBy(*by).agg(F.count("*").alias("n"), same.alias("homogeneous"), F.sum(F.when(F.size(ids) == 1, 1).otherwise(0)).alias("unambiguous"))


def consensus(sessions: DataFrame, by: list[str], item: str, ids: str) -> DataFrame:
    """(by, item, ref, match_rank): the id that most unambiguous items of the
    session have, of those in the item's own ids (ties: the smaller id). Items
    with none of them are left out."""
    lone = sessions.where(F.size(ids) == 1).groupBy(*by, F.get(ids, F.lit(0)).alias("ref")).agg(F.count("*").alias("n"))
    ranked = lone.withColumn("match_rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("n").desc(), F.col("ref"))))
    mine = sessions.select(*by, item, F.explode(F.array_distinct(ids)).alias("ref")).join(ranked, [*by, "ref"])
    return mine.groupBy(*by, item).agg(F.min(F.struct("match_rank", "ref")).alias("best")).select(*by, item, "best.ref", "best.match_rank")


def clustered(items: DataFrame, corr: dict[tuple[str, str], float], gap: str, close_seconds: float, threshold: float, min_size: int, split: bool = True) -> DataFrame:
    """item, cluster_id (country-number), ref_match_cl (ids). items: item, country,
    ts, ids (sorted array), events (array). An item of a mixed session that shares
    no id with its unambiguous items has a null cluster."""
    s = materialize(time_sessions(items.select("item", "country", "ts", "ids", "events"), "country", "ts", "item", gap), "sessions")  # read several times
    by = ["country", "session"]
    kinds = session_kinds(s, by, "ids")
    s = s.join(kinds, by)
    whole = s.where("n = 1 or homogeneous").select("item", *by, F.lit(0).alias("match_rank"), F.lit(0).alias("sub"), F.lit(1).alias("subs"), F.col("ids").alias("ref_match_cl"))
    mixed = s.where("n > 1 and not homogeneous")
    none = mixed.where("unambiguous = 0")
    agreed = consensus(mixed.where("unambiguous > 0"), by, "item", "ids")
    agreed = mixed.drop("n").join(agreed, [*by, "item"]).withColumn("size", F.count("*").over(Window.partitionBy(*by, "match_rank")))
    to_split = none.withColumn("match_rank", F.lit(0)).withColumn("ref_match_cl", F.col("ids"))
    agreed = agreed.withColumn("ref_match_cl", F.array("ref"))
    big = (F.col("size") >= min_size) & F.lit(split)
    cols = ["item", *by, "match_rank", "ref_match_cl", "ts", "events"]
    to_split = to_split.select(*cols).unionByName(agreed.where(big).select(*cols))
    subs = subsplit(to_split, [*by, "match_rank"], "ts", "item", "events", corr, threshold, close_seconds)
    parted = to_split.join(subs, [*by, "match_rank", "item"]).select("item", *by, "match_rank", "sub", "subs", "ref_match_cl")
    kept = agreed.where(~big).select("item", *by, "match_rank", F.lit(0).alias("sub"), F.lit(1).alias("subs"), "ref_match_cl")
    groups = whole.unionByName(parted).unionByName(kept)
    # numbers run over a country's groups in time, then by rank; a group that later
    # ones emptied keeps its number, so counts of groups are summed, not rows
    sets = groups.groupBy(*by, "match_rank").agg(F.max("subs").alias("subs"))
    before = Window.partitionBy("country").orderBy("session", "match_rank").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sets.withColumn("offset", F.coalesce(F.sum("subs").over(before), F.lit(0))).drop("subs")
    number = (F.col("offset") + F.col("sub")).cast("string")
    named = groups.join(offsets, [*by, "match_rank"]).select("item", F.concat_ws("-", "country", number).alias("cluster_id"), "ref_match_cl")
    return items.select("item").join(named, "item", "left")


