"""Helpers that the corpus operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.session import materialize, ship

__all__ = ["materialize"]  # for the operators

# Words are maximal runs of anything but these six ASCII characters.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """mapInArrow, with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


HEAVY = 10_000


def heavy_join(left: DataFrame, right: DataFrame, on: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row per value of on and, in size, how many
    rows of left hold it (size is left out of the result). Values that more than a
    HEAVYth of left's total rows hold are fewer than HEAVY, however large the input:
    their rows of right are broadcast, so that no task gathers a heavy value's rows of
    left. The others meet by a shuffle. The values of the largest size always count
    as heavy (HEAVY of them at most), so plans are alike whatever the data. A null
    value meets nothing. right is read several times and should be a written table."""
    top = right.agg(F.max(F.struct(size, on)).alias("top")).first()["top"]
    common = (F.col(size) * HEAVY > total) | (F.col(on) == F.lit(top[1]) if top is not None else F.lit(False))
    heavy, light = right.where(common).drop(size), right.where(~common).drop(size)
    first = left.join(F.broadcast(heavy), on)
    return first.unionByName(left.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on, how))


def let_go(spark: SparkSession) -> None:
    """Shuffle files of steps whose results are written are of no more use; Spark's
    cleaner deletes them once the driver's collector has met their plans, which it
    otherwise may not for half an hour (spark.cleaner.periodicGC.interval)."""
    gc.collect()
    spark._jvm.java.lang.System.gc()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over value, evaluated once: a one-element transform binds it, so
    that the optimizer cannot copy a costly expression into a lambda's loop."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """withColumn that the optimizer does not merge into later projections, so
    that what is built on the column reads it and does not compute it anew."""
    return df.withColumn(name, F.explode(F.array(value)))


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    text = F.coalesce(text, F.lit(""))
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " "), lambda x: x != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def whole_groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Batches sorted by integer keys, recut so that no group is split."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for i, c in enumerate(cols):
            new[1:] |= c[1:] != c[:-1]
            new[0] |= last is not None and c[0] != last[i]
        last = [c[-1] for c in cols]
        at = np.flatnonzero(new)
        if len(at) and (held or at[-1]):
            cut = int(at[-1])
            yield pa.Table.from_batches([*held, b.slice(0, cut)] if cut else held).combine_chunks()
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finisher for 64-bit hashes (uint64 in, uint64 out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of width neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts rows into runs whose sizes sum to about most, one row at least."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def utf8(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and len + 1 offsets (nulls are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks)
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
