"""A trained sequence tagger for entities: an averaged perceptron over sentences, with
Viterbi decoding.

Sentences come labelled, by hand or by what a gazetteer knows (labelled()). Training goes
in rounds: each task learns on its own share from the weights of the round, sentence by
sentence, and sends the sum of its weights over all steps, by feature; Spark adds these
up, and their mean is the next round's start. Features are hashed into SLOTS, so that
weights have a fixed size (SLOTS by the number of tags, 32-bit floats: some megabytes),
whatever there is to read; that is what is broadcast. Fitting reads at most the sentences
that it is given: sample() bounds them, deterministically. Tagging reads every text,
where it lies.

Tags are O and, for each label, B (first word of a span) and I (further ones). Defined
cases: null and empty texts have no spans; ties go to the first tag; without sentences
the tagger finds nothing.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlane.operators import rolling
from emberlane.session import materialize, ship

SLOTS = 1 << 17
ROUNDS = 5
SAMPLE = 20_000  # sentences that a tagger is fitted on at most
AT_ONCE = 1 << 18  # code points whose words a task holds at a time, or one longer text
KEPT = 1 << 18  # words whose weights a task keeps
LONGEST = 200  # words that are decoded at once; longer sentences are cut there
JOINS, ENDS = "'’-", ".!?\n"  # within a word, and of a sentence


@functools.cache
def _kinds() -> np.ndarray:
    """What each code point is: 1 a letter or digit, 2 one of JOINS, 3 one of ENDS."""
    out = np.zeros(0x110000, np.uint8)
    out[[m.start() for m in re.finditer(r"[^\W_]", "".join(map(chr, range(0x110000))))]] = 1
    out[[ord(c) for c in JOINS]], out[[ord(c) for c in ENDS]] = 2, 3
    return out


@dataclass(frozen=True)
class Words:
    """The words of some texts in order: letters and digits, with one of JOINS between
    two of them at most. Of each: its row, its place in its sentence, and where it is
    in the joined texts; head: the first words of the sentences."""

    joined: str
    points: np.ndarray
    row: np.ndarray
    place: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    head: np.ndarray

    @property
    def tail(self) -> np.ndarray:
        """Where each sentence ends among the words."""
        return np.append(self.head[1:], len(self.row))

    @property
    def sentence(self) -> np.ndarray:
        """Of each sentence its number in its row."""
        row = self.row[self.head]
        return np.arange(len(row)) - np.searchsorted(row, row)

    def said(self) -> list[str]:
        return [self.joined[a:z] for a, z in zip(self.begin.tolist(), self.end.tolist())]


def words_of(texts: list[str | None]) -> Words:
    """All words of all texts; a sentence has LONGEST at most."""
    joined = "\n".join([t or "" for t in texts])  # which ends a sentence
    points = rolling.points(joined)
    kind = _kinds()[points]
    letter = np.zeros(len(kind) + 2, bool)
    letter[1:-1] = kind == 1
    inside = letter.copy()
    inside[1:-1] |= (kind == 2) & letter[:-2] & letter[2:]
    begin, end = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    ends = np.cumsum(kind == 3)[begin]
    nth = np.arange(len(begin)) - np.searchsorted(ends, ends)
    rows = np.cumsum([0, *(len(t or "") + 1 for t in texts)])[:-1]
    return Words(joined, points, np.searchsorted(rows, begin, "right") - 1, nth % LONGEST, begin, end, np.flatnonzero(nth % LONGEST == 0))


SHAPES = ("A", "Aa", "1", "a")


def _shape(w: str) -> str:
    return "A" if w.isupper() else "Aa" if w[0].isupper() else "1" if w.isdigit() else "a"


def features(words: list[str]) -> np.ndarray:
    """Slots of every word's features, a row for each word."""
    low = ["", *(w.lower() for w in words), ""]
    out = []
    for i, w in enumerate(words, 1):
        shape = _shape(w)
        told = (low[i], low[i][:3], low[i][-3:], low[i][-5:], shape, low[i - 1], low[i + 1], f"{shape}{i == 1}", low[i - 1] + " " + low[i])
        out.append([zlib.crc32(f"{k}={x}".encode()) % SLOTS for k, x in enumerate(told)])
    return np.array(out, np.int64).reshape(len(words), -1)


def viterbi(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best sequence of tags: emit is words by tags, move is (tags + 1) by tags,
    its last row for the first word. A tie goes to the smaller tag."""
    n, k = emit.shape
    score = emit[0] + move[k]
    back = np.zeros((n, k), np.int64)
    for i in range(1, n):
        each = score[:, None] + move[:k]
        back[i] = each.argmax(0)
        score = each.max(0) + emit[i]
    path = np.zeros(n, np.int64)
    path[-1] = score.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def decoded(emit: np.ndarray, head: np.ndarray, move: np.ndarray) -> np.ndarray:
    """viterbi() of many sentences side by side, which begin at head."""
    n, k = emit.shape
    size = np.diff(head, append=n)
    order = np.argsort(-size, kind="stable")
    head, size = head[order], size[order]
    longer = lambda i: np.searchsorted(-size, -i)  # noqa: E731  # so many have a word at i
    back, path = np.zeros((n, k), np.int16), np.zeros(n, np.int64)
    score = emit[head] + move[k]
    for i in range(1, int(size.max(initial=0))):
        m = longer(i)
        best, of = score[:m, :1] + move[0], np.zeros((m, k), np.int16)
        for j in range(1, k):
            each = score[:m, j : j + 1] + move[j]
            more = each > best
            best, of[more] = np.where(more, each, best), j
        back[head[:m] + i] = of
        score[:m] = best + emit[head[:m] + i]
    path[head + size - 1] = score.argmax(1)
    for i in range(int(size.max(initial=0)) - 1, 0, -1):
        at = head[: longer(i)] + i
        path[at - 1] = back[at, path[at]]
    return path


_STARTS = [zlib.crc32(f"{k}=".encode()) for k in range(9)]  # checksums go on from those of the features' numbers


class _Weights:
    """What words weigh, by their number: a word's own features are added up once, and
    so are those that it lends to its neighbours. Words are forgotten when they are KEPT."""

    def __init__(self, weights: np.ndarray):
        self.w = weights[:SLOTS]
        self.shapes = self.w[[[zlib.crc32(f"7={s}{first}".encode()) % SLOTS for first in (False, True)] for s in SHAPES]]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.low: list[bytes] = []  # in lower case
        self.before: list[int] = []  # the checksum of a pair so far, as its first word
        k = self.w.shape[1]
        self.own, self.last, self.next, self.shape = np.zeros((0, k), self.w.dtype), np.zeros((0, k), self.w.dtype), np.zeros((0, k), self.w.dtype), np.zeros(0, np.int64)
        self._learn([""])

    def _learn(self, words: list[str]) -> None:
        slots, shapes, sum_ = [], [], zlib.crc32
        for w in words:
            low = w.lower()
            b, shape = low.encode(), SHAPES.index(_shape(w)) if w else 0
            parts = (low[:3].encode(), low[-3:].encode(), low[-5:].encode()) if len(b) > len(low) else (b[:3], b[-3:], b[-5:])
            slots.append([sum_(x, start) for x, start in zip((b, *parts, SHAPES[shape].encode(), b, b), _STARTS)])
            shapes.append(shape)
            self.number[w] = len(self.low)
            self.low.append(b)
            self.before.append(sum_(b" ", sum_(b, _STARTS[8])))
        each = self.w[np.array(slots, np.int64) % SLOTS]
        self.own, self.last, self.next = np.concatenate([self.own, _added(each[:, :5])]), np.concatenate([self.last, each[:, 5]]), np.concatenate([self.next, each[:, 6]])
        self.shape = np.append(self.shape, shapes)

    def of(self, words: list[str], first: np.ndarray) -> np.ndarray:
        """The weights of all words' features() by tag, added up in their order; first
        tells which words begin a sentence."""
        if len(self.low) > KEPT:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            self._learn(new)
        at = np.array([self.number[w] for w in words], np.int64)
        before, after = np.append(0, at[:-1]), np.append(at[1:], 0)
        before[first], after[np.append(first[1:], True)] = 0, 0
        pairs = np.array([zlib.crc32(self.low[i], self.before[j]) for i, j in zip(at.tolist(), before.tolist())], np.int64) % SLOTS
        return _added(np.stack([self.own[at], self.last[before], self.next[after], self.shapes[self.shape[at], first.astype(np.int64)], self.w[pairs]], 1))


def _added(each: np.ndarray) -> np.ndarray:
    """Sums over the second axis, from the first on: 32-bit floats in another order are others."""
    out = each[:, 0].copy()
    for i in range(1, each.shape[1]):
        out += each[:, i]
    return out


@dataclass(frozen=True)
class Tagger:
    labels: tuple[str, ...]
    weights: np.ndarray  # SLOTS by tags, then the moves

    @functools.cached_property
    def _weights(self) -> _Weights:
        return _Weights(self.weights)

    def tags(self, words: list[str], head: np.ndarray) -> np.ndarray:
        """Of the words of sentences that begin at head."""
        first = np.zeros(len(words), bool)
        first[head] = True
        k = 1 + 2 * len(self.labels)
        return decoded(self._weights.of(words, first), head, self.weights[SLOTS:][: k + 1])

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, last word and number of the label of each entity."""
        t = self.tags(words.said(), words.head) if len(words.row) else np.zeros(0, np.int64)
        before = np.append(0, t[:-1]) if len(t) else t
        goes_on = (t > 0) & (t % 2 == 0) & (before > 0) & ((before - 1) // 2 == (t - 1) // 2) & (words.place > 0)
        last = np.append(~goes_on[1:], True) if len(t) else goes_on
        at = np.flatnonzero((t > 0) & ~goes_on)
        return at, np.flatnonzero((t > 0) & last), (t[at] - 1) // 2

    def spans(self, text: str | None) -> Iterator[tuple[int, int, str]]:
        """Begin, end and label of the entities of a text."""
        words = words_of([text])
        first, last, label = self.found(words)
        yield from zip(words.begin[first].tolist(), words.end[last].tolist(), [self.labels[i] for i in label.tolist()])


def empty(labels: tuple[str, ...]) -> np.ndarray:
    k = 1 + 2 * len(labels)
    return np.zeros((SLOTS + k + 1, k), np.float32)


def _spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Some rows of a batch at a time, and their words."""
    for whole in batches:
        size = np.cumsum(pc.fill_null(pc.utf8_length(whole.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < whole.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + AT_ONCE, "right")))
            b = whole.slice(lo, hi - lo)
            words = words_of(b.column("text").to_pylist())
            if len(words.row):
                yield b, words
            lo = hi


def _said(spoken: str) -> int:
    """Tells sentences of rows that repeat an item apart."""
    return int.from_bytes(hashlib.blake2b(spoken.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _hashed(points: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    text, out = rolling.Rolling(points), np.zeros(len(sizes), np.uint64)
    order = np.argsort(sizes, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(at):
            out[at] = text.spans(start[at], int(sizes[at[0]]), 0)
    return out


def _hashes(words: list[str]) -> np.ndarray:
    sizes = np.array([len(w) for w in words], np.int64)
    return _hashed(rolling.points("".join(words)), np.cumsum(sizes) - sizes, sizes)


def _maybe(known: rolling.Filter, words: Words) -> np.ndarray:
    """Which words may be names. Other letters than ASCII's always may: what they are in
    lower case is for the join to say."""
    low = np.where((words.points >= ord("A")) & (words.points <= ord("Z")), words.points + 32, words.points)
    other = np.append(0, np.cumsum(words.points > 127))
    out = other[words.end] > other[words.begin]
    out[known.holds(_hashed(low, words.begin, words.end - words.begin))] = True
    return out


def _known(names: DataFrame, labels: tuple[str, ...]) -> tuple[DataFrame, tuple[int, np.ndarray]]:
    """match and tag of the names, and the filter that tells tasks of them."""
    code = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    tags = names.groupBy("match").agg(F.min("label").alias("label")).withColumn("tag", (code * 2 - 1).cast("int")).where("tag > 0").select("match", "tag")
    known = materialize(tags, "names")
    return known, rolling.filter_of(known.where("match is not null"), known.count(), lambda b: _hashes(b.column("match").to_pylist()))


def _texts(words: Words, sentences: np.ndarray) -> list[str]:
    """The words of these sentences, a space between two; no word has one."""
    begin, end = words.begin.tolist(), words.end.tolist()
    return [" ".join([words.joined[begin[i] : end[i]] for i in range(a, z)]) for a, z in zip(words.head[sentences].tolist(), words.tail[sentences].tolist())]


def _met(items: DataFrame, known: DataFrame, sent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = rolling.Filter(*sent.value)
        for b, words in _spoken(batches):
            at = np.flatnonzero(_maybe(filter_, words))
            if len(at):
                of = np.searchsorted(words.head, at, "right") - 1
                each, of_each = np.unique(of, return_inverse=True)
                said = np.array([_said(t) for t in _texts(words, each)], np.int64)
                names = [words.joined[a:z] for a, z in zip(words.begin[at].tolist(), words.end[at].tolist())]
                columns = [b.column("item").take(pa.array(words.row[at])), pa.array(words.sentence[of], pa.int32()), pa.array(said[of_each]), pa.array(words.place[at], pa.int32()), pa.array(names, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["item", "sentence", "said", "place", "word"])

    each = items.select(F.col("item").cast("string").alias("item"), "text").mapInArrow(run, "item string, sentence int, said long, place int, word string")
    return each.join(known, F.lower("word") == F.col("match")).select("item", "sentence", "said", "place", "word", "tag")


def named(items: DataFrame, names: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """(item, sentence, place, word, tag) of the words of items (item, text) that are a
    name (match, lower case, one word; label). A Bloom filter of bounded size tells
    tasks which words may be, and only those are sent to meet the names by a join."""
    ship(items.sparkSession)
    known, told = _known(names, labels)
    return _met(items, known, items.sparkSession.sparkContext.broadcast(told)).drop("said")


def labelled(items: DataFrame, names: DataFrame, labels: tuple[str, ...], all_: bool = True) -> DataFrame:
    """Sentences (item, sentence, words, tags) of items (item, text) in which each word
    that is a name is tagged with its label; if not all_, only those with a name. A
    sentence goes as one string to meet the tags of its names (named())."""
    ship(items.sparkSession)
    known, told = _known(names, labels)
    sent = items.sparkSession.sparkContext.broadcast(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = rolling.Filter(*sent.value)
        for b, words in _spoken(batches):
            at = np.arange(len(words.head))
            if not all_:
                at = np.flatnonzero(np.add.reduceat(_maybe(filter_, words), words.head, dtype=np.int64))
            if len(at):
                texts = _texts(words, at)
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(words.row[words.head[at]])), pa.array(words.sentence[at], pa.int32()), pa.array([_said(t) for t in texts], pa.int64()), pa.array(texts, pa.string())], ["item", "sentence", "said", "spoken"])

    each = items.select(F.col("item").cast("string").alias("item"), "text").mapInArrow(run, "item string, sentence int, said long, spoken string")
    tags = _met(items, known, sent).groupBy("item", "sentence", "said").agg(F.map_from_entries(F.collect_set(F.struct("place", "tag"))).alias("_t"))
    words = each.join(tags, ["item", "sentence", "said"], "left" if all_ else "inner").withColumn("words", F.split("spoken", " "))
    tag = lambda _, i: F.coalesce(F.element_at("_t", i), F.lit(0))
    return words.select("item", "sentence", "words", F.transform("words", tag).alias("tags"))


def sample(sentences_: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most so many sentences, the same ones on every run."""
    return sentences_.orderBy(F.xxhash64("item", "sentence"), "item", "sentence").limit(most)


def _learnt(sent, labels: tuple[str, ...], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(np.float64)
        summed, steps = np.zeros_like(w), 0
        late: dict[int, int] = {}  # row: the step up to which its sum is kept

        def settle(row: int) -> None:
            summed[row] += w[row] * (steps - late.get(row, 0))
            late[row] = steps

        rows = [(words, np.array(tags)) for b in batches for words, tags in zip(b.column("words").to_pylist(), b.column("tags").to_pylist()) if words]
        for i in np.random.default_rng(seed).permutation(len(rows)).tolist():
            words, gold = rows[i]
            f = features(words)
            k = w.shape[1]
            guess = viterbi(w[:SLOTS][f].sum(1), w[SLOTS:])
            steps += 1
            if (guess == gold).all():
                continue
            for p in np.flatnonzero(guess != gold).tolist():
                for row in f[p].tolist():
                    settle(row)
                    w[row, gold[p]] += 1
                    w[row, guess[p]] -= 1
            for tags, step in ((gold, 1), (guess, -1)):
                before = np.append(k, tags[:-1])
                for a, b in zip(before.tolist(), tags.tolist()):
                    settle(SLOTS + a)
                    w[SLOTS + a, b] += step
        steps += 1
        for row in list(late):
            settle(row)
        at = np.array(sorted(late), np.int64)
        # what the mean over this share's steps differs by from where the round began
        change = summed[at] / steps - sent.value[at] if len(at) else np.zeros((0, w.shape[1]))
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array([*change.astype(np.float64).tolist(), [float(len(rows))] * w.shape[1]], pa.list_(pa.float64()))], ["row", "change"])

    return run


def fit(sentences_: DataFrame, labels: tuple[str, ...], rounds: int = ROUNDS, shares: int = 4) -> Tagger:
    """A tagger of sentences (words, tags), which are dealt to so many shares; what
    comes to the driver after each round is one set of weights."""
    spark = sentences_.sparkSession
    ship(spark)
    # read in every round, so found once, and in the same order on every run
    dealt = materialize(sentences_.select("words", "tags"), "sentences").repartition(shares, F.xxhash64("words")).sortWithinPartitions("words", "tags")
    weights = empty(labels)
    n = weights.shape[1]
    for round_ in range(rounds):
        sent = spark.sparkContext.broadcast(weights)
        changes = dealt.mapInArrow(_learnt(sent, labels, round_), "row long, change array<double>")
        # shares weigh as much as they have sentences: all have about as many
        summed = changes.groupBy("row").agg(F.count("*").alias("n"), *[F.sum(F.get("change", F.lit(i))).alias(f"c{i}") for i in range(n)]).toArrow()
        row = summed.column("row").to_numpy()
        total = np.stack([summed.column(f"c{i}").to_numpy() for i in range(n)], 1) if len(row) else np.zeros((0, n))
        parts = summed.column("n").to_numpy()[row == -1]
        weights = weights.copy()
        weights[row[row >= 0]] += (total[row >= 0] / max(int(parts.sum()), 1)).astype(np.float32)
    return Tagger(labels, weights)


def tagged(items: DataFrame, tagger: Tagger) -> DataFrame:
    """(item, text, label): the entities of items (item, text)."""
    spark = items.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast((tagger.labels, tagger.weights))
    schema = T.StructType([items.schema["item"], T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Tagger(*sent.value)
        for b, words in _spoken(batches):
            first, last, label = model.found(words)
            if len(first):
                told = [words.joined[a:z] for a, z in zip(words.begin[first].tolist(), words.end[last].tolist())]
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(words.row[first])), pa.array(told, pa.string()), pa.array([model.labels[i] for i in label.tolist()], pa.string())], ["item", "text", "label"])

    return items.select("item", "text").mapInArrow(run, schema)


def agreement(found: DataFrame, known: DataFrame) -> DataFrame:
    """label, n_found, n_known, n_both, precision and recall of found against known
    (item, text, label), counted as a bag."""
    both = found.withColumn("_f", F.lit(1)).unionByName(known.withColumn("_f", F.lit(0))).groupBy("item", "text", "label").agg(F.sum("_f").alias("f"), F.sum(1 - F.col("_f")).alias("k"))
    sums = both.groupBy("label").agg(F.sum("f").alias("n_found"), F.sum("k").alias("n_known"), F.sum(F.least("f", "k")).alias("n_both"))
    return sums.withColumns({"precision": F.try_divide("n_both", "n_found"), "recall": F.try_divide("n_both", "n_known")})
