"""Rolling hashes of texts, and a Bloom filter that tells tasks of a table's hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlane.session import ship

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MOST_BITS = 28  # of a filter: 32 MB
BITS_EACH, PROBES = 16, 4
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finisher (uint64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any span of code points, in two lookups each."""

    def __init__(self, points: np.ndarray):
        up, self.down = powers(len(points))
        self.prefix = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=self.prefix[1:])

    def spans(self, at: np.ndarray, n: int, salt: int) -> np.ndarray:
        """Of the n code points from each place on; salt keeps kinds of span apart."""
        h = (self.prefix[at + n] - self.prefix[at]) * self.down[at]
        return mixed(h + np.uint64((salt * 0x10001 + n) * int(_SALT) % (1 << 64)))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: int, table: np.ndarray):
        self.shift, self.table = np.uint64(64 - bits), table

    def places(self, h: np.ndarray, probe: int) -> np.ndarray:
        return (h + (mixed(h ^ _SALT) | np.uint64(1)) * np.uint64(probe)) >> self.shift

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be in it."""
        at = np.arange(len(h))
        for probe in range(PROBES):
            p = self.places(h[at], probe)
            at = at[(self.table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0]
        return at


def filter_of(rows: DataFrame, count: int, hashes: Callable[[pa.RecordBatch], np.ndarray]) -> tuple[int, np.ndarray]:
    """A filter of the hashes of count rows; it has BITS_EACH bits a row, MOST_BITS in
    all at most, so what comes to the driver is bounded however many rows there are."""
    bits = min(max(10, (BITS_EACH * max(count, 1) - 1).bit_length()), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filter(bits, np.zeros(0, np.uint64))
        for b in batches:
            h = hashes(b)
            p = np.unique(np.concatenate([f.places(h, i) for i in range(PROBES)]))
            if len(p):
                word = p >> np.uint64(6)
                head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(word[head].astype(np.int64)), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), head).view(np.int64))], ["at", "bits"])

    ship(rows.sparkSession)
    told = rows.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[told.column("at").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
    return bits, table
