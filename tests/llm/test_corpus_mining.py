"""Hard negatives, decontamination and phrases against brute force, and on odd input."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emberlane.llm import collocations, decontaminate, negatives
from emberlane.llm.common import utf8
from emberlane.llm.textarrays import suffix_order

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"
VECTORS = "vec_id long, embedding array<float>, label int"
ODD = [None, "", " \t\n", "one", "a b c d", "x" * 5000, "of the " * 900, "é" * 300, "A.b;C d\te", "tie " * 60, "tie " * 60, "😀 日本語 \x00 ▁ end"]


def prose(rng, k, words=300):
    return " ".join(rng.choice(["", "W", "é"]) + f"w{int(rng.paretovariate(0.7)) % words}" + rng.choice(["", "", "", ".", ", x"]) for _ in range(k))


def clashing(df, *names):
    return df.select("*", *[F.lit(1).alias(c) for c in names])


def test_suffix_order():
    rng = random.Random(1)
    for n, alphabet, depth in ((0, 1, 4), (1, 1, 4), (200, 3, 64), (300, 2, 4), (120, 1, 128)):
        ids = np.array([rng.randrange(alphabet) for _ in range(n)], np.int64)
        ends = sorted({n, *(rng.randrange(1, n + 1) for _ in range(n // 40))}) if n else []
        end = np.array([next(e for e in ends if e > i) for i in range(n)], np.int64)
        order = suffix_order(ids, end, depth)
        keys = [tuple(ids[i : min(end[i], i + depth)]) for i in order]
        assert sorted(order) == list(range(n)) and keys == sorted(keys)


# decontamination


def lower_words(t):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def contaminated(texts, items):
    windows = defaultdict(set)
    for name, t in items:
        w = lower_words(t)
        k = min(len(w), decontaminate.WINDOW)
        for i in range(len(w) - k + 1) if w else ():
            windows[tuple(w[i : i + k])].add("" if name is None else str(name))
    kinds, suffixes = sorted({len(g) for g in windows}), []
    for w in (lower_words(t) for _, t in items):
        k = min(len(w), decontaminate.WINDOW)
        suffixes += [(w[i:], k) for i in range(len(w) - k + 1) if w]
    out = []
    for t in texts:
        w, hit, got, most = lower_words(t), set(), set(), 0
        for k in kinds:
            for i in range(len(w) - k + 1):
                if mine := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    got |= mine
                    for s, least in suffixes:
                        n = 0
                        while n < len(s) and i + n < len(w) and s[n] == w[i + n]:
                            n += 1
                        most = max(most, n if n >= least else 0)
        out.append((len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit), most))
    return out


def benchmark(rng):
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 40]))) for i in range(25)]
    return [*items, (3, items[4][1]), (100, items[5][1] + " tail " + items[6][1]), (None, prose(rng, 12)), (101, None), (102, " .. "), (103, "a a a a a a a a a a a a a a"), (104, "tie tie tie")]


def training(rng, items):
    texts = [prose(rng, rng.choice([5, 60, 200])) for _ in range(30)]
    for _, t in items:
        if t:
            texts += [prose(rng, 20) + " " + t.upper() + " " + prose(rng, 5), t, " ".join(lower_words(t)[2:13])]
    return [*texts, *ODD, "a " * 40, texts[0]]


@pytest.mark.parametrize("most", [decontaminate.PART, 600])
def test_decontamination_against_all_windows(spark, most):
    """Also with the benchmark in several parts."""
    rng = random.Random(7)
    items = benchmark(rng)
    texts = training(rng, items)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).repartition(3)
    bench = spark.createDataFrame(items, ITEMS)
    assert (len(decontaminate.parts(bench, most)) > 1) == (most == 600)
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench, most=most).collect()}
    want = contaminated(texts, items)
    for i, w in enumerate(want):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == w[:5]
        assert r["longest"] == w[5] and sum(r["runs"][1::2]) - sum(r["runs"][::2]) == r["n_hit"]
    left = decontaminate.decontaminated(clashing(docs, "_row_", "_found", "items", "runs", "item"), bench, most=most)
    assert {r["doc_id"] for r in left.collect()} == {i for i, w in enumerate(want) if not w[4]}
    assert {"_found", "items", "text", "lang"} <= set(left.columns)


def test_decontamination_of_nothing(spark):
    bench, none = spark.createDataFrame([(1, "a b c")], ITEMS), spark.createDataFrame([], DOCS)
    assert decontaminate.contamination(none, bench).count() == 0 and decontaminate.decontaminated(none, bench).count() == 0
    docs = spark.createDataFrame([(None, "x a b c", None, None, None), (None, "x a b c", None, None, None), (1, None, None, None, None)], DOCS)
    assert [r["n_hit"] for r in decontaminate.contamination(docs, bench).orderBy("n_hit").collect()] == [0, 3, 3]
    assert {r["n_items"] for r in decontaminate.contamination(docs, bench.limit(0)).collect()} == {0}


# phrases


def phrase_rows(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = set()
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        around = Counter()
        for g, a in cand.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    around[g[i : i + k]] = max(around[g[i : i + k]], a)
        found = []
        for g, a in cand.items():
            if g in around and 100 * around[g] >= 80 * a:
                continue
            score, k = min((2000000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (s, a, g, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, g.decode(), -a, l, r, n[lang], -s))
    return out


def mined(df, **more):
    return {tuple(r) for r in collocations.collocations(df, **more).collect()}


def test_phrases_against_counting(spark):
    rng = random.Random(3)
    rows = [(prose(rng, rng.choice([4, 80, 300]), 40), rng.choice(["en", "de", None, "und"])) for _ in range(120)]
    rows += [(t, "en") for t in ODD] + [("New  York\tCity is big. new york city", None)] * 9
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    for least, top in ((5, 2000), (2, 17)):
        assert mined(clashing(docs, "n", "phrase", "lh", "c", "size"), least=least, top=top) == phrase_rows(rows, least, top)


def test_phrases_do_not_depend_on_the_filter(spark, monkeypatch):
    """A filter that is far too small lets all through."""
    rng = random.Random(4)
    rows = [(prose(rng, 200, 30), "en") for _ in range(20)]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS)
    monkeypatch.setattr(collocations, "MOST_BITS", 10)
    assert mined(docs, least=3) == phrase_rows(rows, 3, 2000)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_words_that_share_a_hash_are_told_apart():
    data, offsets = utf8(pa.array(["ab cd ab ef cd"]))
    w = collocations.words_of(data, offsets, collocations.OUTSIDE)
    assert collocations._numbered(data, w, np.zeros(5, np.uint64)).tolist() == [0, 1, 0, 2, 1]


def test_scores_past_64_bits(spark):
    big = 10**14
    freq = spark.createDataFrame([("en", 0, "", 10**15), ("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big), ("en", 2, "a b", big)], "lang string, n int, phrase string, c long")
    (r,) = collocations.scored(freq).collect()
    assert r["score"] == 2000000 * big // (5 * big) and (r["a"], r["l"], r["r"]) == (big, 3 * big, 2 * big)


# hard negatives


def negative_rows(rows):
    use = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for i, a, label in use:
        if i % 100:
            continue
        s = [(-sum(x * y for x, y in zip(a, b)), j, k) for j, b, k in use if j != i and len(b) == len(a)]
        for p, j, _ in sorted(x for x in s if x[2] == label)[:5]:
            fit = sorted(x for x in s if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p)[:10]
            for rank, (n, m, _) in enumerate(fit, 1):
                out[i, j, rank, m, -p, -n] += 1
    return out


def vector_rows(rng):
    base = rng.standard_normal((6, 12))
    rows = [(i, [float(x) for x in base[i % 6] + rng.standard_normal(12) * rng.choice([0.0, 0.3, 1.5])], int(rng.integers(0, 4))) for i in range(420)]
    rows += [(500 + k, None, 1) for k in range(2)] + [(600, rows[0][1], None), (None, rows[0][1], 1), (700, [float("nan")] * 12, 1), (800, [None] * 12, 2), (900, [1.0, 2.0], 1), (901, [2.0, 1.0], 1), (902, [1.0, 1.0], 2), (903, [], 1), (1000, [], 1)]
    return rows + [(1100, [-x for x in rows[1][1]], 3), (1200, [0.0] * 12, 2), (1300, [1000.5, -3e4] + [0.1] * 10, 1), (1301, [900.25, -2e4] + [0.1] * 10, 1), (1302, [800.0, -1e4] + [-0.1] * 10, 2)]


def shown(df):
    return Counter(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("most", [negatives.GROUP, 400])
def test_hard_negatives_against_all_pairs(spark, most):
    """Also with the anchors in several groups."""
    rows = vector_rows(np.random.default_rng(5))
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert shown(negatives.hard_negatives(clashing(df, "key", "q", "dim", "score", "rank"), most=most)) == negative_rows(rows)


def test_hard_negatives_of_ties_and_one_label(spark):
    same = [(i, [0.5, 0.25], i % 2) for i in range(300)]
    df = spark.createDataFrame(same, VECTORS)
    assert shown(negatives.hard_negatives(df)) == negative_rows(same)
    near = [(i, [0.5 + i % 3 / 10, 0.25], 1 if i % 50 else 2) for i in range(300)]
    assert shown(negatives.hard_negatives(spark.createDataFrame(near, VECTORS))) == negative_rows(near)
    assert negatives.hard_negatives(df.limit(0)).count() == 0
    huge = [(0, [3e38, 1.0], 1), (1, [1e-45, 3e38], 1), (2, [0.5, 0.5], 2)]
    assert negatives.hard_negatives(spark.createDataFrame(huge, VECTORS)).count() == 0


def test_planes_close_in_on_the_product():
    rng = np.random.default_rng(2)
    a, q = rng.integers(-300, 300, (40, 9)), rng.integers(-(2**20), 2**20, (70, 9))
    whole = a @ q.T
    able = rng.random((40, 70)) < 0.9
    least, most = np.percentile(whole, 60, axis=1).astype(np.int64), np.percentile(whole, 80, axis=1).astype(np.int64)
    i, j, s = negatives.scores(a, q, able, least, most)
    want = able & (whole >= least[:, None]) & (whole <= most[:, None])
    assert (s == whole[i, j]).all() and set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(want))))
    for weight, rest, bits in negatives.planes(q, 22):  # two's complement, whole
        q = q - weight * bits.astype(np.int64)
        assert (0 <= q).all() and (q <= rest).all()
