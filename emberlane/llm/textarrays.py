"""Texts of a batch as flat arrays: bytes, words, and polynomial hashes of any span."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from emberlane.llm.common import mix64

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[9, 10, 11, 12, 13, 32]] = True

_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n at least."""
    if len(_tables.get("up", ())) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _tables[name] = np.multiply.accumulate(p)
    return _tables["up"], _tables["down"]


@dataclass
class Spans:
    """Prefix hashes of a run of 64-bit units: the hash of any span in two lookups.
    Spans of equal units have equal hashes wherever they begin."""

    prefix: np.ndarray

    @classmethod
    def over(cls, units: np.ndarray) -> Spans:
        up, _ = powers(len(units))
        prefix = np.zeros(len(units) + 1, np.uint64)
        np.cumsum((units.astype(np.uint64) + np.uint64(1)) * up[: len(units)], out=prefix[1:])
        return cls(prefix)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, down = powers(len(self.prefix))
        return (self.prefix[end] - self.prefix[start]) * down[start]

    def runs(self, width: int) -> np.ndarray:
        """Mixed hashes of all spans of one width."""
        n = len(self.prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        _, down = powers(len(self.prefix))
        return mix64((self.prefix[width:] - self.prefix[:n]) * down[:n])


@dataclass
class Words:
    """Words of texts laid end to end: hash, byte span, and each text's first word."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text, and the number of words last


def words_of(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = IS_WHITE) -> Words:
    """data: bytes of all texts; offsets: where each begins, and the end; outside:
    which of the 256 bytes belong to no word."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~outside[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    cut = offsets[:-1][offsets[:-1] < n]
    begins[cut] = inside[cut]  # a text's first byte never continues the word before
    start = np.flatnonzero(begins)
    stops = np.zeros(n + 1, bool)
    stops[1:] = inside[:n]
    stops[:n] &= ~inside[:n]
    ends_at = np.zeros(n + 1, bool)
    ends_at[:n] = ~inside[:n]
    ends_at[offsets] = True
    borders = np.flatnonzero(ends_at)
    end = borders[np.searchsorted(borders, start, side="right")] if len(start) else start
    spans = Spans.over(data)
    hashes = mix64(spans.raw(start, end) + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return Words(hashes, start, end, np.searchsorted(start, offsets))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def signs(data: np.ndarray, w: Words) -> np.ndarray:
    """Length, first eight and last eight bytes of every word, in three columns: with
    the hash, all that a word of up to 16 bytes is."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[8 : 8 + len(data)] = data
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
    size = w.end - w.start
    cut = ((8 - np.minimum(size, 8)) * 8).astype(np.uint64)
    return np.stack([size.astype(np.uint64), eight[w.start + 8] << cut, eight[w.end] >> cut], 1)


def suffix_order(ids: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ids from there on, depth of them at least or to the end of
    the place's run (end, exclusive), by prefix doubling: each round sorts what the
    rounds before left equal by the ranks of what follows, twice as deep."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    if not n:
        return order
    new = np.append(True, ids[order[1:]] != ids[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    places = np.flatnonzero(~(new & np.append(new[1:], True)))
    h = 1
    while h < depth and len(places):
        u = order[places]
        there = u + h
        follows = np.where(there < end[u], rank[np.minimum(there, n - 1)] + 1, 0)
        key = rank[u] * (n + 1) + follows
        o = np.argsort(key, kind="stable")
        u, key, follows = u[o], key[o], follows[o]
        order[places] = u
        new = np.append(True, key[1:] != key[:-1])
        rank[u] = np.maximum.accumulate(np.where(new, places, 0))
        places = places[~(new & np.append(new[1:], True)) & (follows > 0)]
        h *= 2
    return order
