"""Secret scans: three fixed patterns, and values after credential words that are
costly to guess.

The guess cost of a value is the least sum of log10 guesses over all ways to cut
it into common words, dates, repeats, sequences, keyboard walks and brute-force
spans (dynamic programming over cut points, which ends as soon as no way is left
below the threshold, so a value's length costs no more than reading it). Words are
the fixed ones and then those of a public vocabulary (a parameter) by their rank.
Every value in credential context is scored, and one whose cost reaches MIN_COST is
a span of kind "guess" from its first character to its last, whatever spans of the
patterns overlap it; those always stay. scan() reports all spans. find() and
redact() leave out a guess span that lies within one pattern's span, which masks
it already.

Python's re runs inside Arrow batches: spans need places, and the cost needs a
dynamic program, which SQL functions do not give. Rows are independent, so a
lost executor costs its tasks alone, and nothing is shuffled.

Defined cases: a null or empty text has no spans; places count code points of
the whole text, however long; equal rows give equal results; rows that repeat a
doc_id, or have none, are scanned one by one; an empty table gives an empty
result; other columns are passed by or left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlane.llm.common import map_arrow
from emberlane.llm.pieces import SPACE, vocabulary

# The patterns and the lengths their matches need.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "guess")
WORD = r"(?:password|passwd|passphrase|passcode|pwd|secret|token|api_?key|credentials?|auth)"
# In prose ("the token is ...") the word stands alone; a key may be joined to others, as in dbPassword=.
CONTEXT = re.compile(rf"""(?:{WORD}["']?\x20*[:=]|(?<![A-Za-z0-9]){WORD}\x20+is:?)\x20*["']?([^\s"'<>]+)""", re.IGNORECASE | re.ASCII)
LAST = re.compile(rf"{WORD}[:=]?$", re.IGNORECASE | re.ASCII)
HINT = re.compile(r"pass|pwd|secret|token|api_?key|credential|auth", re.IGNORECASE | re.ASCII)

MIN_VALUE, MIN_COST = 6, 8.0  # characters; log10 of guesses

# Words by how soon a guesser tries them, and rows of keys.
WORDS = """password the of and to in is that it for as with you love admin welcome login letmein qwerty dragon monkey master
hello secret token user test root guest access default public private server summer winter spring autumn monday friday
shadow sunshine princess football baseball superman batman trust freedom whatever flower cookie pepper orange banana
michael jordan jennifer thomas charlie daniel robert matthew george andrew computer internet system network change this
here your none null true false example sample value string name email phone number key data base code word pass""".split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qazwsxedcrfvtgbyhnujm")
NEXT = {a + b for row in ROWS for x in (row, row[::-1]) for a, b in zip(x, x[1:])}
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
PLAIN = str.maketrans("@4301!$57", "aaeoiisst")


def brute(piece: str) -> float:
    """log10 guesses of one character, by the classes in the whole value."""
    some = set(piece)
    n = 10 * any(c.isdigit() for c in some) + 26 * any(c.islower() for c in some) + 26 * any(c.isupper() for c in some)
    n += 33 * any(c.isascii() and not c.isalnum() for c in some) + 100 * any(not c.isascii() for c in some)
    return math.log10(max(n, 10))


def agreement(value: str, i: int, j: int) -> int:
    """How many characters from i on equal those from j on, by slices that double and halve."""
    n, step = 0, 16
    while value[i + n : i + n + step] == value[j + n : j + n + step] and j + n + step <= len(value):
        n, step = n + step, step * 2
    while step:
        if j + n + step <= len(value) and value[i + n : i + n + step] == value[j + n : j + n + step]:
            n += step
        step //= 2
    return n


class Value:
    """A value, and where its runs that were looked at end."""

    def __init__(self, text: str):
        self.text, self._walk, self._climb = text, (0, 0), (0, 0)

    def walk(self, i: int) -> int:
        """Where the keyboard walk that holds i ends."""
        if not self._walk[0] <= i < self._walk[1]:
            z, t = i + 1, self.text
            while z < len(t) and t[z - 1].lower() + t[z].lower() in NEXT:
                z += 1
            self._walk = i, z
        return self._walk[1]

    def climb(self, i: int) -> int:
        """Where the run of code points that rise, or fall, by one from i on ends."""
        if not self._climb[0] <= i < self._climb[1] - 1:
            z, t = i + 1, self.text
            if z < len(t) and (step := ord(t[z]) - ord(t[i])) in (1, -1):
                while z < len(t) and ord(t[z]) - ord(t[z - 1]) == step:
                    z += 1
            self._climb = i, z
        return self._climb[1]


class Guesser:
    """Guess costs by a list of words, the soonest tried first."""

    def __init__(self, words: list[str]):
        self.rank: dict[str, int] = {}
        for w in words:
            self.rank.setdefault(w, len(self.rank) + 1)
        self.longest = max(map(len, self.rank), default=0)
        self.cached = lru_cache(100_000)(self.cost)

    def spans(self, v: Value, i: int, room: float = math.inf) -> Iterator[tuple[int, float]]:
        """End and cost of each cheap span that begins at i and may cost less than room.
        A repeat costs 1.5 for each character of its unit at least, so room bounds the
        units to try."""
        value, n = v.text, len(v.text)
        piece = value[i : i + self.longest]
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in piece)
        plain = low.translate(PLAIN)
        for k in range(3, len(piece) + 1):
            for form, extra in ((low, 0.0), (plain, 0.5)):
                if r := self.rank.get(form[:k]):
                    own = piece[:k]
                    case = 0.0 if own.islower() or not any(c.isalpha() for c in own) else 0.5
                    yield i + k, math.log10(r + 1) + extra + case
                    break
        if m := DATE.match(value, i):
            yield m.end(), 4.5 if m.end() - i > 4 else 2.1
        most = (n - i) // 2 if math.isinf(room) else min((n - i) // 2, int(room / 1.5) + 1)
        for unit in range(1, most + 1):  # repeats
            if value[i] == value[i + unit] and value[i : i + unit] == value[i + unit : i + 2 * unit]:
                more = agreement(value, i, i + unit) // unit
                yield i + unit * (more + 1), unit * 1.5 + math.log10(more + 1)
        if (z := v.climb(i)) - i >= 3:  # sequences
            yield z, 1.2 + math.log10(z - i)
        if (z := v.walk(i)) - i >= 3:  # keyboard walks
            yield z, 1.8 + math.log10(z - i)

    def cost(self, value: str, enough: float = math.inf) -> float:
        """Least log10 guesses over all segmentations, or enough where that is not
        less. A span between two cuts costs a factor of two more, as its guesser must
        also find the cut. Cut points are met from left to right; one that costs enough
        already is not followed."""
        v, n, each, cut = Value(value), len(value), brute(value), math.log10(2)
        best, open_ = {0: 0.0}, [0]
        while open_:
            i = heapq.heappop(open_)
            at = best.pop(i)
            if i == n:
                return min(at, enough)
            ways = [(i + 1, at + each)]
            if at + cut < enough:
                ways += [(j, at + c + cut) for j, c in self.spans(v, i, enough - at - cut)]
            for j, c in ways:
                if c < enough and c < best.get(j, math.inf):
                    if j not in best:
                        heapq.heappush(open_, j)
                    best[j] = c
        return enough

    def secret(self, value: str) -> bool:
        return len(value) >= MIN_VALUE and (self.cached if len(value) <= 200 else self.cost)(value, MIN_COST) >= MIN_COST


def dictionary(model_path: str | None = None) -> list[str]:
    """The fixed words, then the words of three letters or more of a public vocabulary, by their rank there."""
    ranked = (p[1:].lower() for p in vocabulary(model_path)[0] if p.startswith(SPACE))
    return [*WORDS, *(w for w in ranked if len(w) > 2 and w.isalpha())]


_guessers: dict[str, Guesser] = {}


def guesser(words: list[str] | None = None) -> Guesser:
    """Made once per worker and list of words (None: the default dictionary)."""
    key = "" if words is None else hashlib.md5("\n".join(words).encode()).hexdigest()
    if key not in _guessers:
        _guessers[key] = Guesser(dictionary() if words is None else words)
    return _guessers[key]


def guess_cost(value: str) -> float:
    return guesser().cost(value)


def contexts(text: str) -> Iterator[re.Match]:
    """Every credential word with its value; a value that ends in such a word may be the next one's key."""
    at = 0
    while m := CONTEXT.search(text, at):
        yield m
        last = LAST.search(m[1])
        at = m.start(1) + last.start() if last else m.end()


def found(text: str | None, guess: Guesser | None = None) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of every span, in order."""
    if not text:
        return []
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if HINT.search(text):
        guess = guess or guesser()
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
        for m in contexts(text):
            value = m[1].rstrip(".,;:!?)]}")
            if guess.secret(value):
                out.append((m.start(1), 3, m.start(1) + len(value)))
    return sorted(out)


def find(text: str | None, guess: Guesser | None = None) -> list[tuple[int, int, int]]:
    """The spans that decide what is masked: all but guesses within one pattern's
    span. Of the patterns' spans that began, the one that ends last tells."""
    out, reach = [], -1
    for span in found(text, guess):
        a, kind, b = span
        if kind < 3:
            reach = max(reach, b)
        elif b <= reach:
            continue
        out.append(span)
    return out


def redacted(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with a mark in the place of every span (of joined ones, one)."""
    if not spans:
        return text
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Per document the counts by pattern, a digest of the patterns' spans, and all spans."""
    words = dictionary(model_path)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = guesser(words)
        for b in batches:
            spans = [found(t, guess) for t in b.column("text").to_pylist()]
            base = [[s for s in x if s[1] < 3] for x in spans]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), *[pa.array([sum(s[1] == k for s in x) for x in base], pa.int64()) for k in range(3)],
                pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base], pa.string()), pa.array([joined(x) for x in spans], pa.string()),
            ], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), report, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """The documents, all columns, with every span of their texts masked."""
    at, words = docs.columns.index("text"), dictionary(model_path)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = guesser(words)
        for b in batches:
            texts = pa.array([redacted(t, find(t, guess)) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    return map_arrow(docs, masked, docs.schema)
