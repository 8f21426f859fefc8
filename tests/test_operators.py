"""Hand-worked cases and brute force for the incident operators."""

import datetime as dt
import json
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlane.functions import geo
from emberlane.functions import text as X
from emberlane.operators import clusters, correlation, entities, gazetteer, merge, resolve, rolling, sessions, share, tagging


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def spelled(spark, f, name):
    return set(spark.createDataFrame([(name,)], "n string").select(F.explode(f(F.col("n"))).alias("v")).where("v <> ''").toPandas().v)


@pytest.mark.parametrize(
    ("name", "want"),
    [("Carson (LA) Refinery", {"carson"}), ("El Paso Refinery", {"el paso", "elpaso"}), ("Port Arthur North Plant Refinery", {"port arthur north plant"}), ("Refinery", set())],
)
def test_name_variants(spark, name, want):
    assert spelled(spark, X.name_variants, name) == want


@pytest.mark.parametrize(
    ("city", "want"),
    [
        ("Lima", {"Lima"}),
        ("Stratford-upon Avon", {"Stratford upon Avon", "StratforduponAvon", "Stratfordupon", "Stratford-uponAvon", "Stratford-upon Avon"}),
        ("Baytown, Houston", {"Baytown", "Houston", "BaytownHouston", "Baytown, Houston"}),
    ],
)
def test_city_variants(spark, city, want):
    assert spelled(spark, X.city_variants, city) == want


def test_word_borders(spark):
    cases = [("A fire.", "fire", True), ("wildfire", "fire", False), ("éfire", "fire", True), ("un año más", "año", True), ("ÉCOLE", "école", False), ("xécole y", "école", True)]
    df = spark.createDataFrame(cases, "t string, k string, want boolean")
    assert df.where(X.whole_word(F.col("t"), F.col("k")) != F.col("want")).count() == 0
    assert df.where("k = 'école' and t = 'ÉCOLE'").where(X.substring(F.col("t"), F.col("k"))).count() == 1


def test_names_are_taken_literally(spark):
    items = spark.createDataFrame([(1, "a (b) c+ d."), (2, "abc")], "item long, text string")
    names = spark.createDataFrame([("c+",), ("(b)",), ("a (b",), ("abc",)], "match string")
    assert values(tagging.whole_words(items, names, ["text"]), "item", "match") == [(1, "a (b"), (2, "abc")]


def test_many_names_give_the_same_tags(spark, monkeypatch):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["the fire at el paso", "smoke", "el  paso", None, ""])], "item long, text string")
    names = spark.createDataFrame([("fire",), ("el paso",), ("smoke",), ("über",)], "match string")
    want = values(tagging.refname_tags(items, names, ["text"]), "item", "match")
    monkeypatch.setattr(tagging, "CHUNK", 1)
    assert values(tagging.refname_tags(items, names, ["text"]), "item", "match") == want == [(0, "el paso"), (0, "fire"), (1, "smoke")]


def test_names_against_patterns(spark, monkeypatch):
    """All ways to look for names, against a pattern or a containment for each pair."""
    rng = random.Random(2)
    letters = ["a", "B", "é", "_", " ", ".", "ß", "Z", "1"]
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, some(rng.choice([0, 3, 12, 30]))) for i in range(120)] + [(200, None)]
    names = sorted({(some(rng.choice([1, 2, 3])), w) for _ in range(80) for w in ("word", "exact", "part", "phrase")}) + [("", "part"), (None, "word")]
    border = "(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
    bare = lambda s: "".join(c for c in unicodedata.normalize("NFD", s.casefold()) if unicodedata.category(c) != "Mn")

    def holds(t, name, way):
        if not t or not name:
            return False
        if way == "phrase":
            return bare(name) in bare(t)
        p = re.escape(name) if way == "part" else border + re.escape(name) + border
        return bool(re.search(p, t, 0 if way == "exact" else re.IGNORECASE))

    want = sorted((i, n, w) for i, t in items for n, w in names if holds(t, n, w))
    texts, known = spark.createDataFrame(items, "item long, text string"), spark.createDataFrame(names, "match string, way string")
    for chunk, bits in ((1 << 20, 28), (40, 10)):  # also few texts at a time, and a filter that lets all through
        monkeypatch.setattr(tagging, "CHUNK", chunk)
        monkeypatch.setattr(rolling, "MOST_BITS", bits)
        assert values(tagging.found(texts, known, ["text"], F.array("way")), "item", "match", "way") == want
    assert len(want) > 300


def test_owner_overlap(spark):
    tag = "array<struct<id:bigint,initial:string,match:string,type:string>>"
    df = spark.createDataFrame([([(7, "Total", "total", "ownername"), (9, "SAT", "saudi aramco total", "ownername")],), ([(7, "Total", "total", "ownername")],)], f"t {tag}")
    assert [[x["id"] for x in r[0]] for r in df.select(tagging.without_overlaps(F.col("t"))).collect()] == [[9], [7]]


EVER = (None, None)


@pytest.mark.parametrize(
    ("ref", "city", "owner", "expired", "want"),
    [
        ([1, 2], [2], [], (), ([2], 1.0)),
        ([1, 2, 3], [], [], (), ([1, 2, 3], 0.33)),
        ([1, 2, 3], [], [2, 3], (), ([2, 3], 0.5)),
        ([1], [2], [], (), ([1], 1.0)),
        ([1, 2], [3], [4], (), ([4], 1.0)),
        ([1, 2], [3], [4], (4,), ([1, 2], 0.5)),
        ([], [], [1, 2, 3, 4], (4,), ([1, 2, 3], 0.33)),
        ([], [5], [], (), None),
    ],
)
def test_resolution(spark, ref, city, owner, expired, want):
    ts = dt.datetime(2020, 1, 1)
    assets = spark.createDataFrame([(i, f"a{i}", None, dt.datetime(2019, 1, 1) if i in expired else None) for i in range(1, 5)], "id long, name string, begin timestamp_ntz, end timestamp_ntz")
    tags = [(1, i, t) for ids, t in ((ref, "refname"), (city, "cityname"), (owner, "ownername")) for i in ids]
    items = spark.createDataFrame([(1, ts)], "item long, ts timestamp_ntz")
    got = resolve.resolve(items, spark.createDataFrame(tags, "item long, id long, type string"), assets, None, "2021-01-01").collect()
    assert [([x["GeoAssetID"] for x in r["ref_match"]], r["ref_match"][0]["confidence"]) for r in got] == ([want] if want else [])


def cascade(ref, city, owner, places):
    """The stages in their order, with early exits."""
    geo_types = [s for s in (ref, city) if s]
    comb = set.intersection(*geo_types) if geo_types else set()
    kept = []
    for stage in (ref, comb, (comb & owner if comb else owner) if owner else set()):
        if len(stage) == 1:
            return stage
        kept.append(stage)
    bases = ([set(range(1, 8))] if not ref and not owner else []) + [ref, owner, ref & owner]
    for base in bases:
        for p in places:
            if len(base & p) == 1:
                return base & p
            kept.append(base & p)
    kept = [k for k in kept if k]
    return min(kept, key=len) if kept else None


def test_resolution_against_a_cascade(spark):
    rng = random.Random(5)
    some = lambda: set(rng.sample(range(1, 8), rng.choice([0, 0, 1, 2, 3])))
    at = {i: (i + 0.5, 0.5) for i in range(1, 8)}  # a box from a to b holds assets a..b-1
    cases, tags, boxes = {}, [], []
    for item in range(150):
        ref, city, owner = some(), some(), some()
        spans = sorted({tuple(sorted(rng.sample(range(1, 9), 2))) for _ in range(rng.choice([0, 1, 2]))}, key=lambda s: (s[0] - s[1], s))
        cases[item] = cascade(ref, city, owner, [set(range(a, b)) for a, b in spans])
        tags += [(item, i, t) for ids, t in ((ref, "refname"), (city, "cityname"), (owner, "ownername")) for i in ids]
        boxes += [(item, n, [[[float(a), 0.0], [float(b), 0.0], [float(b), 1.0], [float(a), 1.0], [float(a), 0.0]]]) for n, (a, b) in enumerate(spans)]
    items = spark.createDataFrame([(i, dt.datetime(2020, 1, 1)) for i in cases], "item long, ts timestamp_ntz")
    assets = spark.createDataFrame([(i, f"a{i}", None, None, *at[i]) for i in at], "id long, name string, begin timestamp_ntz, end timestamp_ntz, lon double, lat double")
    places = spark.createDataFrame(boxes, "item long, place int, rings array<array<array<double>>>")
    got = {r["item"]: {x["GeoAssetID"] for x in r["ref_match"]} for r in resolve.resolve(items, spark.createDataFrame(tags, "item long, id long, type string"), assets, places, "2021-01-01").collect()}
    assert got == {k: v for k, v in cases.items() if v}


def test_shares_and_confidence(spark):
    rows = [(1, "US"), (1, "US"), (1, "CA")] + [(2, "US")] * 7 + [(2, "CA")]
    got = {r[0]: [tuple(x) for x in r[1]] for r in share.country_shares(spark.createDataFrame(rows, "item long, country string")).collect()}
    assert got[1] == [("US", 0.67), ("CA", 0.33)] and got[2][1] == ("CA", 0.12)
    n = spark.range(1, 2000).select("id", X.confidence(F.col("id")).alias("c")).collect()
    assert all(r["c"] == round(1 / r["id"], 2) for r in n)


def test_merge_and_first_write_wins(spark):
    posts = spark.createDataFrame([("1", "t", "x")], "id string, created_at string, text string")
    heads = spark.createDataFrame([("h", "t", "x", None), ("g", "t", "y", "z")], "id string, created_at string, text string, snippet string")
    out = merge.merged(posts, heads)
    assert values(out, "id", "text") == [("1", "x"), ("g", "y")] and len(out.columns) == 18
    target = spark.createDataFrame([("g", "old")], "id string, text string")
    assert values(merge.insert_if_absent(out.select("id", "text"), target), "id") == [("1",)]


def test_correlation(spark):
    rows = [("A", "fire", d, n) for d, n in enumerate([1, 2, 3])] + [("A", "blaze", d, n) for d, n in enumerate([1, 2, 2])] + [("B", "fire", d, n) for d, n in enumerate([1, 2])] + [("B", "blaze", d, n) for d, n in enumerate([2, 1])]
    daily = spark.createDataFrame([(c, dt.date(2020, 1, d + 1), e, n) for c, e, d, n in rows] + [("A", dt.date(2020, 1, d), "cut", 1) for d in (1, 2, 3)], "country string, day date, event string, n long")
    mean = {(r["event_a"], r["event_b"]): r["corr"] for r in correlation.positive_mean(correlation.correlations(daily)).collect()}
    assert round(mean["fire", "blaze"], 6) == 0.866025 == round(mean["blaze", "fire"], 6)
    assert mean["cut", "cut"] == 0 == mean["cut", "fire"] and round(mean["fire", "fire"], 9) == 1
    long = correlation.unpivoted(correlation.pivoted(correlation.positive_mean(correlation.correlations(daily)), ["fire", "blaze", "cut"]), "event_a")
    assert {(r["event_a"], r["event_b"]): r["corr"] for r in long.collect()} == mean


def test_sessions_split_at_the_exact_gap(spark):
    days = [0, 6.9, 13.8, 20.8, 27.9]
    df = spark.createDataFrame([(1, i, dt.datetime(2020, 1, 1) + dt.timedelta(days=d)) for i, d in enumerate(days)], "c long, item long, ts timestamp_ntz")
    assert [r["session"] for r in sessions.time_sessions(df, "c", "ts", "item", "7 days").orderBy("item").collect()] == [1, 1, 1, 2, 3]


def test_zero_covariance_is_zero(spark):
    """Counts whose covariance is 0 as integers, though sums of floats leave a trace."""
    rng = random.Random(4)
    x = [3, 0, 0, 1, 7, 2, 2, 5, 1, 0, 6, 3]
    rows, found = [], 0
    for c in range(400):
        y = [rng.randrange(0, 8) for _ in x]
        if len(x) * sum(a * b for a, b in zip(x, y)) == sum(x) * sum(y) and len(set(y)) > 1:
            found += 1
            rows += [(c, dt.date(2020, 1, d + 1), e, v[d]) for d in range(len(x)) for e, v in (("a", x), ("b", y))]
    daily = spark.createDataFrame(rows, "country int, day date, event string, n long")
    assert found > 3 and correlation.correlations(daily.repartition(7)).where("event_a <> event_b and corr <> 0").count() == 0


def test_sessions_of_a_country_with_all_rows(spark):
    """Against a walk over the times: gaps inside an hour, over hours, over days, ties and nulls."""
    rng = random.Random(7)
    at = [rng.choice([0, 3600, 86400, 5 * 86400]) * rng.randrange(3) + rng.randrange(0, 9000) for _ in range(400)] + [3600, 3600, None, None]
    rows = [(c, i, None if t is None else dt.datetime(2020, 1, 1) + dt.timedelta(seconds=t)) for c in (1, None) for i, t in enumerate(at)]
    got = {(r["c"], r["item"]): r["session"] for r in sessions.time_sessions(spark.createDataFrame(rows, "c long, item long, ts timestamp_ntz"), "c", "ts", "item", "20 minutes").collect()}
    last, n = None, 0
    for t, i in sorted((-1 if t is None else t, i) for i, t in enumerate(at)):
        n += last is None or last < 0 or t - last >= 1200
        last = t
        assert got[1, i] == got[None, i] == n


def test_similarity(spark):
    corr = spark.createDataFrame([("fire", "blaze", 0.5), ("blaze", "fire", 0.5), ("fire", "cut", 0.1), ("cut", "fire", 0.1), ("blaze", "cut", 0.06), ("cut", "blaze", 0.06)], "event_a string, event_b string, corr double")
    pairs = spark.createDataFrame([(1, ["fire", "blaze"], 2, ["fire"]), (3, ["fire"], 4, ["cut"]), (5, ["fire", "blaze"], 6, ["cut"]), (7, [], 8, ["cut"])], "a long, ea array<string>, b long, eb array<string>")
    assert {r["a"]: round(r["sim"], 4) for r in clusters.similarity(pairs, corr).collect()} == {1: 0.75, 3: 0.1, 5: 0.08, 7: 0.0}


def greedy(n, edges):
    """Brute force: groups as sets, edge by edge."""
    around = [{i} | {b for a, b in edges if a == i} | {a for a, b in edges if b == i} for i in range(n)]
    member, groups = [set() for _ in range(n)], 0
    for i in range(n):
        if not member[i]:
            met = set().union(*(member[j] for j in around[i]))
            g = min(met) if met else groups
            groups += not met
            for j in around[i]:
                member[j].add(g)
    return [max(m) for m in member], groups


@pytest.mark.parametrize(
    ("n", "edges", "want"),
    [(3, {(0, 2)}, [0, 1, 0]), (3, {(0, 2), (1, 2)}, [0, 0, 0]), (4, {(0, 2), (1, 3), (2, 3)}, [0, 1, 0, 1]), (5, {(0, 1), (1, 3), (2, 4), (3, 4)}, [0, 0, 1, 0, 1])],
)
def test_greedy_groups(n, edges, want):
    like = np.zeros((n, n), bool)
    for a, b in edges:
        like[a, b] = like[b, a] = True
    got, groups = clusters.grouped(np.arange(n) * 10, np.arange(n), like, 5)
    assert (got.tolist(), groups) == (want, max(want) + 1) == greedy(n, edges)


def parted(rows, corr, threshold, close):
    """Brute force of a session's split: all pairs of (seconds, item, events)."""
    rows = sorted(rows)
    edges = set()
    for j, (t, _, ej) in enumerate(rows):
        for i, (s, _, ei) in enumerate(rows[:j]):
            sim = sum(corr.get((a, b), float(a == b)) for a in ej for b in ei) / max(len(ei) * len(ej), 1)
            if t - s < close or sim > threshold:
                edges.add((i, j))
    sub, n = greedy(len(rows), edges)
    return {r[1]: (g, n) for r, g in zip(rows, sub)}


def test_subsplit_against_all_pairs(spark):
    rng = random.Random(3)
    words = ["fire", "blaze", "cut", "new"]
    corr = {}
    for a, b in [("fire", "blaze"), ("fire", "cut"), ("cut", "new")]:
        corr[a, b] = corr[b, a] = rng.choice([0.3, 0.5, 0.7])
    rows, want = [], {}
    for s in range(12):
        mine = [(rng.randrange(0, 4000), 100 * s + k, sorted(rng.sample(words, rng.choice([0, 1, 1, 2, 3])))) for k in range(rng.choice([1, 5, 40]))]
        mine += [(t, i + 50, e) for t, i, e in mine[:3]]  # one time, the same events
        rows += [(s, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=t), i, e or None) for t, i, e in mine]
        want |= {(s, i): v for i, v in parted(mine, corr, 0.4, 60).items()}
    df = spark.createDataFrame(rows, "s int, ts timestamp_ntz, item long, events array<string>")
    got = {(r["s"], r["item"]): (r["sub"], r["subs"]) for r in clusters.subsplit(df, ["s"], "ts", "item", "events", corr, 0.4, 60.0).collect()}
    assert got == want and len({v for v in want.values()}) > 5


def test_clusters_against_a_walk(spark):
    """Countries, sessions, agreement and splits, one item after another."""
    rng = random.Random(11)
    corr, words, gap, close, threshold, least = {("fire", "cut"): 0.9, ("cut", "fire"): 0.9}, ["fire", "cut", "new"], 1000, 60, 0.4, 6
    rows = [(i, rng.choice(["A", "B"]), rng.randrange(0, 60_000), sorted(rng.sample(range(5), rng.choice([1, 1, 2, 3]))), [rng.choice(words)]) for i in range(300)]
    want = {}
    for c in ("A", "B"):
        sessions_, number = [], 0
        for r in sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[0])):
            if sessions_ and r[2] - sessions_[-1][-1][2] < gap:
                sessions_[-1].append(r)
            else:
                sessions_.append([r])
        for s in sessions_:
            if len(s) == 1 or all(r[3] == s[0][3] for r in s):
                groups = [(s, None, False)]
            else:
                lone = [r[3][0] for r in s if len(r[3]) == 1]
                order = sorted(set(lone), key=lambda x: (-lone.count(x), x))
                groups = [([r for r in s if next((x for x in order if x in r[3]), None) == ref], ref, True) for ref in order] if lone else [(s, None, True)]
                if lone:
                    want |= {r[0]: (None, None) for r in s if not set(r[3]) & set(order)}
            for g, ref, mixed in groups:
                split = parted([(r[2], r[0], r[4]) for r in g], corr, threshold, close) if mixed and (ref is None or len(g) >= least) else {r[0]: (0, 1) for r in g}
                want |= {r[0]: (f"{c}-{number + split[r[0]][0]}", r[3] if ref is None else [ref]) for r in g}
                number += max((n for _, n in split.values()), default=0)
    df = spark.createDataFrame([(i, c, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=t), ids, e) for i, c, t, ids, e in rows], "item long, country string, ts timestamp_ntz, ids array<long>, events array<string>")
    got = {r["item"]: (r["cluster_id"], r["ref_match_cl"]) for r in clusters.clustered(df, corr, f"{gap} seconds", float(close), threshold, least).collect()}
    assert got == want


def test_mixed_session(spark):
    ids = {"a": [1], "b": [1, 2], "c": [2], "d": [2], "e": [1, 3], "f": [3, 4]}
    at = dt.datetime(2020, 1, 1)
    items = spark.createDataFrame([(k, "X", at + dt.timedelta(hours=i), v, ["fire"]) for i, (k, v) in enumerate(ids.items())], "item string, country string, ts timestamp_ntz, ids array<long>, events array<string>")
    got = {r["item"]: (r["cluster_id"], r["ref_match_cl"]) for r in clusters.clustered(items, {}, "7 days", 2 * 86400.0, 0.4, 50).collect()}
    assert got == {"b": ("X-0", [2]), "c": ("X-0", [2]), "d": ("X-0", [2]), "a": ("X-1", [1]), "e": ("X-1", [1]), "f": (None, None)}


def test_point_in_polygon(spark):
    hole = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]
    df = spark.createDataFrame([([[[float(v) for v in p] for p in r] for r in hole], x, y) for x, y in ((0.5, 0.5), (2.0, 2.0), (5.0, 1.0))], "rings array<array<array<double>>>, x double, y double")
    assert [r[0] for r in df.select(geo.in_polygon(F.col("rings"), F.col("x"), F.col("y"))).collect()] == [True, False, False]
    area = df.select(geo.polygon_area(F.col("rings"))).first()[0]
    assert 1.4e11 < area < 1.5e11  # twelve square degrees at the equator


@pytest.mark.parametrize("stored", ["multipolygon", "flattened", "string", "array<array<array<string>>>", "array<string>"])
def test_place_of_several_parts(spark, stored):
    """A small part, a large one with a hole and an island in it, and a Polygon of another name."""
    ring = lambda x, y, n: [[float(a), float(b)] for a, b in ((x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y))]
    several = [[ring(0, 0, 1)], [ring(10, 0, 6), ring(11, 1, 4)], [ring(12, 2, 1)]]
    single = [ring(30, 0, 5)]
    flat = [r for p in several for r in p]
    deep, shallow = "array<array<array<array<double>>>>", "array<array<array<double>>>"
    as_text = lambda v, depth: json.dumps(v) if not depth else [as_text(x, depth - 1) for x in v]
    of, one, kind = {"multipolygon": (several, [single], deep), "flattened": (flat, single, shallow)}.get(stored) or (*(as_text(v, stored.count("array")) for v in (several, single)), stored)
    gpes = spark.createDataFrame([(["Coast"], 1, 0.5, ("MultiPolygon", of)), (["Inland"], 2, 0.4, ("Polygon", one))], f"GPEs array<string>, place_id long, importance double, boundaries struct<type:string, coordinates:{kind}>")
    places = resolve.known_places(spark.createDataFrame([(1, "Coast"), (1, "Inland"), (2, "Inland")], "item long, name string"), gpes)
    at = {1: (0.5, 0.5), 2: (10.5, 3.0), 3: (11.5, 1.5), 4: (12.5, 2.5), 5: (31.0, 1.0), 6: (8.0, 0.5)}
    assets = spark.createDataFrame([(i, f"a{i}", None, None, *p) for i, p in at.items()], "id long, name string, begin timestamp_ntz, end timestamp_ntz, lon double, lat double")
    # item 1: 1 + 20 + 1 square degrees of Coast come after 25 of Inland
    assert {tuple(r) for r in resolve.in_places(places, assets, resolve.known_shapes(gpes)).select("item", "poly", "id").collect()} == {(1, 1, 5), (1, 2, 1), (1, 2, 2), (1, 2, 4), (2, 1, 5)}
    items = spark.createDataFrame([(i, dt.datetime(2020, 1, 1)) for i in (1, 2)], "item long, ts timestamp_ntz")
    tags = spark.createDataFrame([(1, i, "ownername") for i in (2, 3, 6)] + [(2, 5, "ownername")], "item long, id long, type string")
    got = {r["item"]: [x["GeoAssetID"] for x in r["ref_match"]] for r in resolve.resolve(items, tags, assets, places, "2021-01-01", resolve.known_shapes(gpes)).collect()}
    assert got == {1: [2], 2: [5]}


def test_entities(spark):
    found = spark.createDataFrame([(1, "Dutch", "NORP"), (1, "Dutch", "GPE"), (2, "French", "NORP"), (3, "http://x", "GPE"), (4, "Roman", "NORP")], "item long, text string, label string")
    peoples = spark.createDataFrame([("Dutch", "Netherlands"), ("French", "France")], "NORP string, GPE string")
    assert values(entities.places(found, peoples), "item", "match") == [(1, "Dutch"), (2, "France"), (4, "Roman")]


def test_extractor_can_be_replaced(spark):
    items = spark.createDataFrame([(1, "to Lima"), (2, None)], "item long, text string")

    def model(frames):
        for df in frames:
            yield df[df["text"].str.contains("Lima", na=False)].assign(text="Lima", label="GPE")

    assert values(entities.by_model(items, model), "item", "text") == [(1, "Lima")]


def test_names_are_credited_once(spark):
    a = spark.createDataFrame([(2, "Carson Refinery"), (1, "Carson Refinery"), (3, None)], "GeoAssetID long, GeoAssetName string")
    assert values(gazetteer.asset_names(a), "id", "match") == [(1, "carson")]


def _body(*ids):
    return json.dumps({"globalObjects": {"tweets": {str(i): {"id": i, "full_text": f"t{i}"} for i in ids}}})


def test_pages_and_stream(spark, tmp_path):
    from emberlane.sources import search
    from emberlane.streaming import sink
    from emberlane.streaming.ingest import ingest

    saved = tmp_path / "saved.jsonl"
    saved.write_text("\n".join(json.dumps({"search": "s", "page": p, "body": b}) for p, b in enumerate([_body(1, 2), _body(2, 3), _body(3)])))
    spark.dataSource.register(search.PostSource)
    pages = spark.read.format("saved_posts").options(path=str(saved), searches=json.dumps(["s", "none"])).load()
    assert pages.count() == 3
    landing, target = tmp_path / "landing", f"file://{tmp_path}/posts"
    for _ in range(2):  # what is written once stays as it is
        pages.write.mode("append").json(str(landing))
        (landing / "broken.json").write_text(json.dumps({"search": "s", "page": 9, "body": "{broken"}))
        ingest(spark, str(landing), target, str(tmp_path / "state")).awaitTermination()
        assert values(sink.table(spark, target), "id") == [(1,), (2,), (3,)]


FAULTS = [
    ("a", 0, [None, "{broken", "{}", _body(1, 2)]), ("a", 1, [_body(3)]), ("a", 2, ["{}", "{}", _body(4)]),
    ("b", 0, ["[1]", "nonsense", None, _body(5)]), ("b", 1, [_body(1, 6)]),
]


def test_faults_are_played_through(tmp_path):
    """Every branch of the pager: scroll again, reload, reload clean, give up."""
    from emberlane.sources import search

    path = tmp_path / "faults.jsonl"
    path.write_text("\n".join(json.dumps({"search": s, "page": p, "bodies": b}) for s, p, b in FAULTS))
    calls = []

    class Watched(search.SavedPages):
        def reload(self, search, clean):
            calls.append((search, clean))
            super().reload(search, clean)

    run = lambda s, **more: [(p, n) for p, n, _ in search.paged(Watched(str(path)), s, **more)]
    assert run("a") == [(0, 4), (1, 1), (2, 3)] and calls == [("a", False), ("a", True), ("a", True), ("a", True)]
    assert run("b", start=1) == [(1, 1)] and run("b", max_pages=1) == [(0, 4)] and run("none") == []
    with pytest.raises(search.PageFailed):
        run("a", max_retry_page=1)
    assert run("b", max_retry_scroll=1) == []  # the one empty view ends it

    class Deaf(search.SavedPages):  # a reload of the wrong kind does not help
        def reload(self, search, clean):
            super().reload(search, not clean)

    with pytest.raises(search.PageFailed):
        list(search.paged(Deaf(str(path)), "a"))


def test_searches_as_a_stream(spark, tmp_path):
    """Pages that come later are read from where the last run ended, each once."""
    from emberlane.progress import RunLog
    from emberlane.sources import search
    from emberlane.streaming import sink
    from emberlane.streaming.ingest import ingest_searches

    log = RunLog(spark, f"file://{tmp_path}/log")
    spark.streams.addListener(log)
    spark.dataSource.register(search.PostSource)
    path, target, seen = tmp_path / "faults.jsonl", f"file://{tmp_path}/posts", []
    options = {"path": str(path), "searches": json.dumps(["a", "b", "none"])}
    for upto in (3, 3, 5):
        path.write_text("\n".join(json.dumps({"search": s, "page": p, "bodies": b}) for s, p, b in FAULTS[:upto]))
        rows = spark.readStream.format("saved_posts").options(**options).load()
        rows.writeStream.foreachBatch(lambda df, n: seen.extend((r["search"], r["page"], r["tries"]) for r in df.collect())).option("checkpointLocation", str(tmp_path / "seen")).trigger(availableNow=True).start().awaitTermination()
        ingest_searches(spark, options, target, str(tmp_path / "state")).awaitTermination()
    assert seen == [("a", 0, 4), ("a", 1, 1), ("a", 2, 3), ("b", 0, 4), ("b", 1, 1)]
    assert values(sink.table(spark, target), "id") == [(i,) for i in range(1, 7)]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    spark.streams.removeListener(log)
    log.flush()
    rows = log.table().where("kind = 'batch'").collect()
    assert sum(r["rows_in"] for r in rows) == 2 * len(FAULTS) and all(r["seconds"] > 0 for r in rows)


def test_every_key_once(spark, tmp_path, monkeypatch):
    """A batch that fails midway and is replayed, one that is repeated, and two writers."""
    from emberlane.sources import versions
    from emberlane.streaming import sink

    path = f"file://{tmp_path}/t"
    frame = lambda rows: spark.createDataFrame(rows, "id long, v string")
    held = lambda: values(sink.table(spark, path, "id long, v string"), "id", "v")
    assert held() == [] and sink.table(spark, path) is None
    assert sink.write(frame([(1, "b"), (1, "a"), (2, "c"), (None, "n")]), path, "id", "w", 0)
    assert held() == [(1, "a"), (2, "c")]
    assert not sink.write(frame([(9, "x")]), path, "id", "w", 0)  # that batch is in
    publish = versions.publish

    def fails(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "publish", fails)
    with pytest.raises(RuntimeError):
        sink.write(frame([(3, "d"), (1, "z")]), path, "id", "w", 1)
    assert held() == [(1, "a"), (2, "c")]

    def second(s, p, version, state):  # the other writer publishes first, the same key among others
        monkeypatch.setattr(versions, "publish", publish)
        assert sink.write(frame([(3, "other"), (4, "other")]), path, "id", "v", 7)
        publish(s, p, version, state)

    monkeypatch.setattr(versions, "publish", second)
    assert sink.write(frame([(3, "d"), (1, "z"), (5, "e")]), path, "id", "w", 1)
    assert held() == [(1, "a"), (2, "c"), (3, "other"), (4, "other"), (5, "e")]
    assert sink.write(frame([]), path, "id", "w", 2) and sink.write(frame([(5, "y"), (6, "f")]), path, "id", "w", 3)
    before = held()
    sink.compacted(spark, path, "id")
    assert held() == before == [(1, "a"), (2, "c"), (3, "other"), (4, "other"), (5, "e"), (6, "f")]
    assert len(versions.latest(spark, path)[1]["parts"]) == 1 and sink.write(frame([(6, "q"), (7, "g")]), path, "id", "w", 4)
    assert held() == [*before, (7, "g")] and not sink.write(frame([(8, "h")]), path, "id", "v", 7)


def test_peoples_file(spark, tmp_path):
    from emberlane.sources.files import read_peoples

    (tmp_path / "p.csv").write_bytes("NORP,GPE\nEspañol,España\n".encode("cp1252"))
    assert values(read_peoples(spark, str(tmp_path / "p.csv")), "NORP", "GPE") == [("Español", "España")]
    with pytest.raises(FileNotFoundError):
        read_peoples(spark, str(tmp_path / "none.csv"))


def test_geocoder(spark):
    from emberlane.sources import geocoding

    class Down:
        def search(self, name, one=False):
            raise OSError

    class Flaky:
        n = 0

        def search(self, name, one=False):
            self.n += 1
            if self.n < 3:
                raise OSError
            return [{"place_id": 1, "display_name": f"{name}, Land"}]

    assert geocoding.asked(Flaky(), "X", 5, 0, 0)[0]["place_id"] == 1
    with pytest.raises(OSError):
        geocoding.asked(Down(), "X", 2, 0, 0)


class Script:
    """A provider that goes by a script: what comes of each request, in turn."""

    def __init__(self, *script):
        self.script, self.seen = list(script), []

    def search(self, name, one=False):
        self.seen.append((name, one))
        told = self.script.pop(0)
        if isinstance(told, Exception):
            raise told
        return told


def test_every_branch_of_asking():
    from emberlane.sources.geocoding import Bucket, ServiceError, asked

    waits = []
    ask = lambda *script, n=3: (s := Script(*script), asked(s, "X", n, 5.0, 0.5, Bucket(0.5, lambda: 0.0, waits.append)))
    place = [{"place_id": 1}]
    s, got = ask(OSError(), place)
    assert got == place and s.seen == [("X", False)] * 2 and 5.0 in waits
    s, got = ask(ServiceError(), place)  # refused all matches: the best alone
    assert got == place and s.seen == [("X", False), ("X", True)]
    s, got = ask(ServiceError(), ServiceError(), ServiceError(), OSError(), place)
    assert got == place and s.seen == [("X", False), ("X", True)] * 2 + [("X", False)]
    s, got = ask(OSError(), OSError(), OSError(), place)  # the probe is found, the name is not
    assert got == [] and s.seen[-1] == ("Paris", True)
    assert ask(*[OSError()] * 3, ServiceError())[1] == []
    with pytest.raises(ConnectionError):
        ask(*[OSError()] * 3, [])
    with pytest.raises(OSError):
        ask(*[OSError()] * 4)


def test_requests_stay_under_the_rate():
    from emberlane.sources.geocoding import Bucket

    clock, times = [0.0], []
    sleep = lambda s: clock.__setitem__(0, clock[0] + s)
    b = Bucket(0.25, lambda: clock[0], sleep)
    for i in range(200):
        b.take()
        times.append(clock[0])
        sleep(random.Random(i).choice([0.0, 0.1, 2.0]))  # an idle time is not made up for
    assert all(times[i + 4] - times[i] >= 1 - 1e-9 for i in range(len(times) - 4))


def test_answers_are_kept_as_they_come(spark, tmp_path):
    from emberlane.sources import geocoding
    from emberlane.streaming import sink

    log = tmp_path / "asked.txt"

    class Coder:
        def search(self, name, one=False):
            with log.open("a") as f:
                f.write(name + "\n")
            if name == "down" and not (tmp_path / "up").exists() or (name == "Paris" and not (tmp_path / "up").exists()):
                raise OSError
            return [{"place_id": len(name), "display_name": name, "importance": 0.5, "geojson": "{}"}] if name != "none" else []

    names = spark.createDataFrame([(n,) for n in ("a", "bb", "none", "down", "bb", None)], "name string")
    path, more = f"file://{tmp_path}/answers", {"make": Coder, "batch": 2, "rate": 1000.0, "lanes": 2, "max_attempts": 1, "wait_error": 0.0}
    with pytest.raises(Exception, match="down|OSError|answer"):
        geocoding.appended_places(names, path, **more)
    assert values(sink.table(spark, path), "GPE") == [("a",), ("bb",)]
    (tmp_path / "up").touch()
    log.unlink()
    geocoding.appended_places(names, path, **more)
    got = {r["GPE"]: [x["place_id"] for x in r["answers"]] for r in sink.table(spark, path).collect()}
    assert got == {"a": [1], "bb": [2], "none": [], "down": [4]} and sorted(log.read_text().split()) == ["down", "none"]


def test_running_correlation(spark, tmp_path):
    from emberlane.operators.running import Running

    rng = random.Random(3)
    items = [(rng.choice("AB"), dt.datetime(2020, 1, 1) + dt.timedelta(hours=rng.randrange(240)), rng.choice(["x", "y", "z", None])) for _ in range(300)]
    frame = lambda rows: spark.createDataFrame(rows, "country string, ts timestamp_ntz, event string")
    words = spark.createDataFrame([(e,) for e in "wxyz"], "event string")
    r = Running(spark, f"file://{tmp_path}/running", tuple("wxyz"))
    assert r.correlations().count() == 0
    for n, part in enumerate((items[:100], items[100:250], [], items[250:])):
        assert r.add(frame(part), "w", n) and not r.add(frame(items), "w", n)
    daily = correlation.daily_counts(frame(items), words)
    assert values(r.correlations(), "country", "event_a", "event_b", "corr") == values(correlation.correlations(daily), "country", "event_a", "event_b", "corr")
    assert values(r.counts(), "country", "day", "event", "n") == values(daily, "country", "day", "event", "n")


def test_whole_pipeline(spark, tmp_path):
    from emberlane.config import Config
    from emberlane.plans import pipeline
    from emberlane.progress import RunLog

    t = "Wed Jan 0{} 10:00:00 +0000 2020"
    raw = spark.createDataFrame(
        [(1, "1", t.format(1), "Fire at the Carson plant", None, 5, "5"), (2, "2", t.format(2), "smoke over Carson", ([("CarsonTown",)],), 5, "5"), (3, "3", t.format(3), "nothing", None, 6, "6")],
        "id long, id_str string, created_at string, full_text string, entities struct<hashtags:array<struct<text:string>>>, user_id long, user_id_str string",
    )
    assets = spark.createDataFrame([(10, "Carson Refinery", "Lima", 33.8, -118.2, None, None), (11, "El Paso Refinery", "El Paso", 31.7, -106.4, None, None)], "GeoAssetID long, GeoAssetName string, City string, Latitude double, Longitude double, FromDate timestamp_ntz, ToDate timestamp_ntz")
    owners = spark.createDataFrame([(10, "Unknown"), (11, "Acme")], "GeoAssetID long, CompanyName string")
    names = spark.createDataFrame([("Lima", "GPE")], "match string, label string")
    peoples = spark.createDataFrame([], "NORP string, GPE string")
    countries = spark.createDataFrame([(10, "US"), (11, "US")], "GeoAssetID long, country string")
    heads = spark.createDataFrame([("h", "2020-01-02T09:00:00.000000Z", "Blaze near Carson", None, "src", None)], "storyId string, firstCreated string, text string, snippet string, sourceName string, cluster_id string")
    tables = {"posts": raw, "headlines": heads, "assets": assets, "owners": owners, "names": names, "peoples": peoples, "countries": countries}
    log = RunLog(spark, f"file://{tmp_path}/log")
    out = pipeline.run(tables, Config(as_of="2021-01-01", event_words=("fire", "smoke", "blaze"), event_hashtags=("fire",)), f"file://{tmp_path}", log=log)
    got = {r["id"]: (r["cluster_id"], [x["GeoAssetID"] for x in r["ref_match"]], r["events_tags"]) for r in out.collect()}
    assert got == {"1": ("US-0", [10], ["fire"]), "2": ("US-0", [10], ["smoke"]), "h": ("US-0", [10], ["blaze"])}
    assert {r["stage"]: r["rows_out"] for r in log.table().collect()} == {"tagged-posts": 3, "matched-posts": 3, "tagged-headlines": 1, "matched-headlines": 1, "merged": 3}
    with pytest.raises(ValueError), log.stage("bad"):
        raise ValueError
    assert [r["status"] for r in log.table().where("stage = 'bad'").collect()] == ["failed"]


def test_entry_without_corpus_operators(tmp_path):
    """In a copy without the corpus operators and their pipeline, the rest imports and is whole."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    assert not (copy / "emberlane/llm").exists() and (copy / "emberlane/operators").exists()
    told = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert 'event_tags' in q and set(o) <= set(q); print(len(q), sum(k.startswith('op') for k in q), e.__file__)"
    out = subprocess.run([sys.executable, "-c", told], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, corpus, file = out.stdout.split()
    assert int(n) > 60 and corpus == "0" and file == str(copy / "__spark_entry__.py")


def test_what_a_task_holds_does_not_grow_with_its_batch():
    """A task gives what it found as it goes, whole rows each time, and nothing twice."""
    import pyarrow as pa

    from emberlane.operators import rolling, tagging

    class Sent:
        value = (10, np.full(16, ~np.uint64(0)), {"part": np.ones(2 * tagging.STARTS, bool)})  # all may be names

    texts = [["ab" * 40_000, f"x{i % 10}ab"] for i in range(300)]
    read = []

    def batches():
        read.append(1)
        yield pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["item", "text"])

    told, most = {}, 0
    for out in tagging._candidates(Sent, {"part": [2]})(batches()):
        most = max(most, out.num_rows)
        for i, form in zip(out.column("item").to_pylist(), out.column("_form").to_pylist()):
            told.setdefault(i, []).append(form)
    assert all(sorted(told[i]) == sorted({"ab", "ba", f"x{i % 10}", f"{i % 10}a"}) for i in range(300)) and most <= 4 * tagging.AT_ONCE
    assert max(len(t) for _, t, _ in tagging._chunks(batches())) <= 2 * (tagging.CHUNK // 80_000 + 2) and isinstance(rolling.MOST_BITS, int)
