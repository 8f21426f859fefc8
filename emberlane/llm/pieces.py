"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies with byte
fallback, with seeded merge-dropout.

An agenda holds the candidate merges of neighbouring symbols; the best score
goes first, the leftmost of equals. With dropout a candidate is skipped if a
hash keyed by seed, document and the candidate's place falls below the rate:
whether it is skipped depends on nothing else, so reruns and any partitioning
agree, while the same word differs from place to place. A skipped candidate
stays out until a neighbour's merge makes another one of the symbol.

Pieces never hold a space after another character, so words (with the spaces
before them) are independent: agendas of all short words of a batch advance
together in arrays, one merge each a round; a long unbroken run has a heap of
its own. Both give the same pieces.

Decoding is lossless for every text: characters without a piece, and the mark
that stands for a space should a text hold it, are written in byte pieces.

Defined cases: a null text has null ids and decodes to null; an empty text has
no ids; texts of any length are encoded whole; rows that repeat a doc_id have
equal dropout; a null doc_id is a key of its own; an empty table gives an empty
result; other columns are passed by.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlane.llm.common import map_arrow, mix64, slices

SPACE = "▁"
DROPOUT, SEED = 0.1, 17
SHORT = 40  # symbols of words that advance in arrays
CHUNK = 1 << 19  # characters at a time
NONE = np.float32(np.inf)
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def vocabulary(path: str | None = None) -> tuple[list[str], list[float], list[int]]:
    """Pieces, scores, and the ids of the 256 byte pieces, from a model file."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(m.get_piece_size())
    as_bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    plain = ["" if m.is_byte(i) or m.is_control(i) or m.is_unknown(i) else m.id_to_piece(i) for i in ids]
    return plain, [m.get_score(i) for i in ids], as_bytes


class Coder:
    """Tables of one vocabulary."""

    def __init__(self, pieces: list[str], scores: list[float], as_bytes: list[int]):
        self.n = len(pieces)
        self.ids = {p: i for i, p in enumerate(pieces) if p}
        self.rank = np.array([-s for s in scores], np.float32)
        self.as_bytes = np.array(as_bytes, np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1 and p != SPACE:
                self.of_char[ord(p)] = i
        self.of_char[ord(" ")] = self.ids[SPACE]
        keys, merged = [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    merged.append(i)
        self.bits = max(16, len(keys).bit_length() + 3)
        self.keys, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        for k, m, s in zip(keys, merged, self.slot(np.array(keys, np.int64))):
            while self.keys[s] >= 0:
                s = (s + 1) & ((1 << self.bits) - 1)
            self.keys[s], self.merged[s] = k, m
        raw = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in enumerate(as_bytes):
            raw[i] = bytes([b])
        self.lengths = np.array([len(r) for r in raw])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _K[0]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or -1."""
        key = a.astype(np.int64) * self.n + b
        at = self.slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.merged[at], -1)
        todo = np.flatnonzero((found >= 0) & (found != key))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.merged[at[todo[hit]]]
            todo = todo[(found >= 0) & ~hit]
        return out

    def candidates(self, a, b, key, start, end, rate) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; no rank for what is no piece or is skipped."""
        made = self.pair(a, b)
        rank = np.where(made >= 0, self.rank[made], NONE)
        if rate > 0:
            at = np.flatnonzero(made >= 0)
            h = mix64(key[at] + start[at].astype(np.uint64) * _K[1] + end[at].astype(np.uint64) * _K[2] + made[at].astype(np.uint64))
            rank[at[(h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < rate]] = NONE
        return rank, made

    def short(self, sym, start, chunk, stop, key, rate, out) -> None:
        """Merges words of few symbols: each advances by its best merge a round.
        start: places in the batch; stop: where each chunk ends; key: by place."""
        rank, made = np.full(len(sym), NONE), np.full(len(sym), -1, np.int32)

        def weigh(at: np.ndarray) -> None:
            """Ranks the pairs of the symbols at these indices with their right neighbours."""
            beyond = np.minimum(at + 2, len(sym) - 1)
            end = np.where((at + 2 < len(sym)) & (chunk[beyond] == chunk[at]), start[beyond], stop[chunk[at]])
            rank[at], made[at] = self.candidates(sym[at], sym[at + 1], key[start[at]], start[at], end, rate)

        weigh(np.flatnonzero(chunk[:-1] == chunk[1:]))
        while len(sym):
            new = np.ones(len(sym), bool)
            np.not_equal(chunk[1:], chunk[:-1], out=new[1:])
            head = np.flatnonzero(new)
            least = np.minimum.reduceat(rank, head)[np.cumsum(new) - 1]
            done = least == NONE
            out[start[done]] = sym[done]
            at = np.flatnonzero((rank == least) & ~done)
            if not len(at):
                return
            at = at[np.concatenate([[True], chunk[at[1:]] != chunk[at[:-1]]])]
            sym[at] = made[at]
            # the pair to the right of a merged symbol is that of the symbol taken in
            rank[at], made[at] = NONE, -1
            fresh = np.zeros(len(sym), bool)
            fresh[at] = True
            fresh[at[at > 0] - 1] = True
            keep = ~done
            keep[at + 1] = False
            sym, start, chunk, rank, made, fresh = (x[keep] for x in (sym, start, chunk, rank, made, fresh))
            near = np.flatnonzero(fresh[:-1] & (chunk[:-1] == chunk[1:]))
            weigh(near)

    def long(self, sym, start, end, key, rate, out) -> None:
        """Merges one long run by a heap."""
        n = len(sym)
        sym, left, right, end, place = sym.tolist(), list(range(-1, n - 1)), list(range(1, n + 1)), end.tolist(), start.tolist()
        whole = np.arange(n - 1)
        rank, made = self.candidates(np.array(sym[:-1]), np.array(sym[1:]), key[whole], start[:-1], np.array(end[1:]), rate)
        heap = [(float(rank[i]), i, i + 1, int(made[i]), sym[i], sym[i + 1]) for i in whole[rank < NONE].tolist()]
        heapq.heapify(heap)
        alive = [True] * n

        def offer(i: int, j: int) -> None:
            r, m = self.candidates(np.array([sym[i]]), np.array([sym[j]]), key[:1], np.array([place[i]]), np.array([end[j]]), rate)
            if r[0] < NONE:
                heapq.heappush(heap, (float(r[0]), i, j, int(m[0]), sym[i], sym[j]))

        while heap:
            _, i, j, m, a, b = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and right[i] == j and sym[i] == a and sym[j] == b):
                continue
            sym[i], end[i], alive[j], right[i] = m, end[j], False, right[j]
            if right[j] < n:
                left[right[j]] = i
                offer(i, right[j])
            if left[i] >= 0:
                offer(left[i], i)
        keep = np.array(alive)
        out[start[keep]] = np.array(sym)[keep]

    def encode(self, texts: list[str], keys: list[int], rate: float = 0.0) -> list[np.ndarray]:
        """Ids of each text. keys: 64 bits for each text's dropout."""
        marked = [" " + t if t else "" for t in texts]
        sizes = np.array([len(t) for t in marked], np.int64)
        chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        if not len(chars):
            return [np.zeros(0, np.int32) for _ in texts]
        sym = self.of_char[chars]
        doc = np.repeat(np.arange(len(texts)), sizes)
        first = np.cumsum(sizes) - sizes
        # a document's places begin at 0 whatever the batch: the key takes the batch's place out again
        key = (np.array(keys, np.uint64) - first.astype(np.uint64) * np.full(1, _K[1]) - first.astype(np.uint64) * np.full(1, _K[2]))[doc]
        known = sym >= 0
        space = chars == 32
        begins = np.ones(len(chars), bool)
        begins[1:] = (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1] | (doc[1:] != doc[:-1])
        chunk = np.cumsum(begins, dtype=np.int32)
        stop = np.append(0, np.append(np.flatnonzero(begins)[1:], len(chars))).astype(np.int32)  # by chunk, from 1
        out = np.full(len(chars), -1, np.int32)
        i = np.flatnonzero(known)
        if len(i):
            size = np.bincount(chunk[i])
            big = size[chunk[i]] > SHORT
            j = i[~big]
            if len(j):
                self.short(sym[j], j.astype(np.int32), chunk[j], stop, key, rate, out)
            for c in np.unique(chunk[i[big]]):
                j = np.arange(np.searchsorted(chunk, c), np.searchsorted(chunk, c, side="right"))
                self.long(sym[j], j, j + 1, key[j], rate, out)
        n_bytes = np.where(chars < 0x80, 1, np.where(chars < 0x800, 2, np.where(chars < 0x10000, 3, 4)))
        count = np.where(known, (out >= 0).astype(np.int64), n_bytes)
        ids = np.repeat(out, count)
        at = np.cumsum(count) - count
        for i in np.flatnonzero(~known):
            ids[at[i] : at[i] + count[i]] = self.as_bytes[list(chr(chars[i]).encode())]
        total = np.concatenate([[0], np.cumsum(count)])
        ends = total[np.cumsum(sizes)]
        return np.split(ids, ends[:-1])

    def decode(self, ids: np.ndarray) -> str:
        n = self.lengths[ids]
        before = np.cumsum(n) - n
        at = np.repeat(self.starts[ids] - before, n) + np.arange(int(n.sum()))
        return self.raw[at].tobytes()[1:].decode()


_coders: dict[str, Coder] = {}


def coder(vocab: tuple) -> Coder:
    name = hashlib.md5("\0".join(vocab[0]).encode()).hexdigest()
    if name not in _coders:
        _coders[name] = Coder(*vocab)
    return _coders[name]


def key_of(doc_id: int | None, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{doc_id}".encode(), digest_size=8).digest(), "little")


def tokenized(docs: DataFrame, model_path: str | None = None, rate: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_sha256 (of the text decoded from ids) and
    lossless (whether that is the text)."""
    vocab = vocabulary(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocab)
        for b in batches:
            sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in b.column("text")])
            for a, z in slices(sizes, CHUNK):
                doc_ids, texts = b.column("doc_id").slice(a, z - a), b.column("text").slice(a, z - a).to_pylist()
                ids = c.encode([t or "" for t in texts], [key_of(d, seed) for d in doc_ids.to_pylist()], rate)
                back = [c.decode(x) for x in ids]
                ends = np.cumsum([0, *[len(x) for x in ids]]).astype(np.int32)
                null = pa.array([t is None for t in texts])
                yield pa.RecordBatch.from_arrays([
                    doc_ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else [], pa.int32()), mask=null),
                    pa.array(np.diff(ends), pa.int64()), pa.array([None if t is None else hashlib.sha256(x.encode()).hexdigest() for t, x in zip(texts, back)], pa.string()),
                    pa.array([x == (t or "") for t, x in zip(texts, back)]),
                ], ["doc_id", "ids", "n_tokens", "decoded_sha256", "lossless"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string, lossless boolean")
