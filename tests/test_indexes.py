"""The text index and dictionary matching against plain searches."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from emberlane.functions import stems
from emberlane.operators import fulltext, tagging
from emberlane.sources import versions

STEMS = [
    ("en", "caresses", "caress"), ("en", "ponies", "poni"), ("en", "ties", "tie"), ("en", "cats", "cat"), ("en", "gas", "gas"), ("en", "agreed", "agre"), ("en", "feed", "feed"),
    ("en", "hopping", "hop"), ("en", "hoping", "hope"), ("en", "falling", "fall"), ("en", "filing", "file"), ("en", "plastered", "plaster"), ("en", "conflated", "conflat"),
    ("en", "happy", "happi"), ("en", "cry", "cri"), ("en", "by", "by"), ("en", "relational", "relat"), ("en", "conditional", "condit"), ("en", "hopeful", "hope"), ("en", "goodness", "good"),
    ("en", "refineries", "refineri"), ("en", "refinery", "refineri"), ("en", "explosions", "explos"), ("en", "explosion", "explos"), ("en", "shutdowns", "shutdown"), ("en", "adjustment", "adjust"),
    ("de", "feuern", "feu"), ("de", "brande", "brand"), ("de", "brand", "brand"), ("de", "explosionen", "explosion"), ("fr", "chevaux", "cheval"), ("fr", "raffineries", "raffineri"), ("fr", "raffinerie", "raffineri"),
    ("es", "refinerias", "refineri"), ("es", "refineria", "refineri"), ("es", "luces", "luz"), ("xx", "things", "things"), (None, "things", "things"), ("en", "as", "as"),
]


def test_stems():
    assert [(lang, w, stems.stem(w, lang)) for lang, w, _ in STEMS] == STEMS


def test_stems_in_sql(spark):
    import duckdb

    rng = random.Random(1)
    ends = [s for steps in stems.STEMMERS.values() for step in steps for x in step for s in x[0].split() if "+" not in s]
    words = sorted({"".join(rng.choice("abcdeilnorsty") for _ in range(rng.randint(0, 6))) + rng.choice(ends) + rng.choice(["", "", "s", "ed"]) for _ in range(3000)})
    rows = [(lang, w) for lang in stems.STEMMERS for w in words]
    told = stems.with_stems(spark.createDataFrame(rows, "lang string, token string"), "token").toPandas()
    t = told[["lang", "token"]]  # noqa: F841
    got = sorted(told[["lang", "token", "stem"]].itertuples(index=False, name=None))
    assert got == sorted(duckdb.sql(f"select lang, token, {stems.stem_sql('token', 'lang')} from t").fetchall())


def folded(t):
    return "".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn")


def toks(t):
    return re.findall(r"\w+", folded(t or ""))


def corpus(n=120, seed=4):
    rng = random.Random(seed)
    words = ["fire", "Fire", "fires", "FEU", "école", "ecole", "the", "of", "plant", "plants", "über", "a", "x_1", "42"]
    return [(i, rng.choice(["en", "fr", None]), " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(rng.choice([0, 3, 20])))) for i in range(n)] + [(n, "en", None)]


def brute(docs, phrase):
    p = toks(phrase)
    out = {}
    for i, t in docs.items():
        w = toks(t)
        at = [k for k in range(len(w) - len(p) + 1) if p and w[k : k + len(p)] == p]
        if at:
            out[i] = at
    return out


def found(index, phrases, **more):
    q = index.spark.createDataFrame(list(enumerate(phrases)), "query int, phrase string").withColumn("lang", F.lit("en"))
    out = {}
    for r in fulltext.phrases(index, q, **more).collect():
        out.setdefault(phrases[r["query"]], {})[int(r["doc"])] = r["starts"]
    return out


def test_phrases_through_increments(spark, tmp_path):
    rows = corpus()
    frame = lambda rs: spark.createDataFrame(rs, "doc_id long, lang string, text string")
    index = fulltext.Index(spark, f"file://{tmp_path}/index", 4)
    phrases = ["fire", "ECOLE", "the fire", "fire of the plant", "plants uber", "a a", "42 x_1", "nowhere at all", "", "...", "the"]
    assert found(index, phrases) == {}
    fulltext.add(index, frame(rows[:50]), ["text"])
    fulltext.add(index, frame(rows[50:] + [(None, "en", "fire")]), ["text"])
    docs = {i: t for i, _, t in rows}
    check = lambda: found(index, phrases) == {p: b for p in phrases if (b := brute(docs, p))}
    assert check()
    docs |= {3: "the fire of the plant", 60: "nothing", 500: "plants über the fire"}
    fulltext.add(index, frame([(i, "en", docs[i]) for i in (3, 60, 500)]), ["text"])
    fulltext.remove(index, frame([(7, None, None), (61, None, None)]))
    for i in (7, 61):
        del docs[i]
    assert check() and len(index.segments()) == 4
    assert {int(r["doc"]): r["n_tokens"] for r in index.docs().collect()} == {i: len(toks(t)) for i, t in docs.items()}
    fulltext.compacted(index)
    assert check() and len(index.segments()) == 1
    assert {r["term"]: r["cf"] for r in index.terms().groupBy("term").agg(F.sum("cf").alias("cf")).collect()} == {w: sum(toks(t).count(w) for t in docs.values()) for t0 in docs.values() for w in toks(t0)}


def test_columns_do_not_run_into_each_other(spark, tmp_path):
    index = fulltext.Index(spark, f"file://{tmp_path}/index", 4)
    fulltext.add(index, spark.createDataFrame([(1, "en", "a fire", "at noon"), (2, "en", None, "fire at noon")], "doc_id long, lang string, text string, snippet string"), ["text", "snippet"])
    assert found(index, ["fire at", "at noon"]) == {"fire at": {2: [1]}, "at noon": {1: [3], 2: [2]}}


def test_tags_from_the_index(spark, tmp_path):
    """Names of whole tokens have the tags that reading the texts gives them."""
    rows = [(i, "en", t) for i, t in enumerate(["The École at El Paso", "el paso, again", "elpaso", "ecole ecole", None])]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    names = spark.createDataFrame([(1, "el paso"), (2, "école"), (2, "Paso"), (3, "none")], "id long, match string")
    index = fulltext.add(fulltext.Index(spark, f"file://{tmp_path}/index", 4), frame, ["text"])
    told = sorted((int(r["item"]), r["id"], r["match"]) for r in fulltext.name_tags(index, names).collect())
    read = tagging.refname_tags(frame.select(F.col("doc_id").alias("item"), "text"), names, ["text"]).collect()
    whole = sorted((r["item"], r["id"], r["match"]) for r in read if r["item"] != 2)  # a phrase in a longer token is none for the index
    assert told == whole == [(0, 1, "el paso"), (0, 2, "Paso"), (0, 2, "école"), (1, 1, "el paso"), (1, 2, "Paso"), (3, 2, "école")]


def test_search_by_stem(spark, tmp_path):
    index = fulltext.Index(spark, f"file://{tmp_path}/index", 4)
    texts = [(1, "en", "Fires at the plants"), (2, "en", "a plant fired on, a plant"), (3, "fr", "fires plants"), (4, "en", "the of the"), (5, "en", "plant")]
    fulltext.add(index, spark.createDataFrame(texts, "doc_id long, lang string, text string"), ["text"])
    q = spark.createDataFrame([(1, "the fire of a plant", "en"), (2, "the of", "en"), (3, "plants missing", "en")], "query int, phrase string, lang string")
    told = lambda every: sorted((r["query"], int(r["doc"]), r["n_terms"], r["tf"]) for r in fulltext.search(index, q, every).collect())
    assert told(True) == [(1, 1, 2, 2), (1, 2, 2, 3)]
    assert told(False) == [(1, 1, 2, 2), (1, 2, 2, 3), (1, 5, 1, 1), (3, 1, 1, 1), (3, 2, 1, 2), (3, 5, 1, 1)]
    assert found(index, ["plants fire"], stemmed=True) == {"plants fire": {2: [1]}}


def test_a_writer_that_comes_second_starts_over(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert versions.latest(spark, path) == (0, {})
    seen = []

    def change(state):
        seen.append(state.get("n", 0))
        if len(seen) == 1:  # another writer is faster
            versions.publish(spark, path, 1, {"n": 10})
        return {"n": state.get("n", 0) + 1}

    assert versions.commit(spark, path, change) == {"n": 11} and seen == [0, 10] and versions.latest(spark, path) == (2, {"n": 11})
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, 2, {})
    assert versions.commit(spark, path, lambda s: None) == {"n": 11}


def test_many_names(spark):
    """Ten thousand names, among them one that every text holds, against a search for each."""
    rng = random.Random(8)
    syllables = ["ba", "ké", "lo", "mi", "Nu", "ra", "ß", "x", " "]
    word = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    names = sorted({word(rng.randint(1, 9)) for _ in range(10_000)} | {"ba", "the common one"})
    texts = [(i, f"the common one {word(rng.choice([2, 30, 80]))}") for i in range(60)]
    items, known = spark.createDataFrame(texts, "item long, text string").repartition(3), spark.createDataFrame([(n,) for n in names], "match string")
    got = sorted((r["item"], r["match"]) for r in tagging.contained(items, known, ["text"]).select("item", "match").collect())
    same = lambda s: "".join(tagging.past_case(s))
    assert got == sorted((i, n) for i, t in texts for n in names if same(n) in same(t)) and len(got) > 1000
    assert tagging.contained(items, known.limit(0), ["text"]).count() == 0 and tagging.contained(items.limit(0), known, ["text"]).count() == 0


def test_viterbi_against_all_paths():
    import itertools

    import numpy as np

    from emberlane.operators import tagger

    rng = np.random.default_rng(1)
    for n, k in ((1, 3), (2, 3), (5, 3), (4, 5)):
        for _ in range(20):
            emit, move = rng.integers(-5, 6, (n, k)).astype(float), rng.integers(-5, 6, (k + 1, k)).astype(float)
            worth = lambda p: emit[range(n), p].sum() + move[k, p[0]] + sum(move[a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
            assert worth(tagger.viterbi(emit, move)) == max(worth(np.array(p)) for p in itertools.product(range(k), repeat=n))


def test_a_tagger_learns_from_names_and_finds_others(spark):
    """Names end alike and follow the same words; half of them are held back."""
    from emberlane.operators import entities, tagger

    rng = random.Random(2)
    name = lambda: "".join(rng.choice(["ba", "ro", "ni", "tel"]) for _ in range(3))
    towns, tribes = sorted({name() + "burg" for _ in range(40)}), sorted({name() + "ians" for _ in range(40)})
    say = lambda: rng.choice([f"A fire in {rng.choice(towns).title()} today", f"The {rng.choice(tribes)} said so", "nothing of note", f"they left {rng.choice(towns).title()}."])
    texts = [(i, " ".join(say() + "." for _ in range(4))) for i in range(120)] + [(900, None), (901, "")]
    items = spark.createDataFrame(texts, "item long, text string").repartition(3)
    known = spark.createDataFrame([(t, "GPE") for t in towns[::2]] + [(t, "NORP") for t in tribes[::2]], "match string, label string")
    every = spark.createDataFrame([(t, "GPE") for t in towns] + [(t, "NORP") for t in tribes], "match string, label string")
    labels = ("GPE", "NORP")
    told = tagger.labelled(items, known, labels)
    assert {(w.lower(), t) for r in told.collect() for w, t in zip(r["words"], r["tags"]) if t} <= {(w, 1) for w in towns[::2]} | {(w, 3) for w in tribes[::2]}
    # sentences with a name that is not known would teach that it is none
    sure = told.where(F.exists("tags", lambda t: t > 0))
    model = tagger.fit(tagger.sample(sure, 200), labels, shares=2)
    found = entities.by_tagger(items, model)
    gold = spark.createDataFrame([(i, m[0], "GPE" if m[0].lower().endswith("burg") else "NORP") for i, t in texts for m in re.finditer(r"\w+(burg|ians)\b", t or "")], "item long, text string, label string").distinct()
    scores = {r["label"]: (r["precision"], r["recall"]) for r in tagger.agreement(found, gold).collect()}
    assert set(scores) == set(labels) and all(p > 0.9 and r > 0.9 for p, r in scores.values())
    assert every.count() > known.count() and tagger.fit(told.limit(0), labels).weights.any() == False  # noqa: E712
    assert entities.by_tagger(items, tagger.Tagger(labels, tagger.empty(labels))).count() == 0


def test_a_tagger_looks_at_each_word_once(monkeypatch):
    """Many sentences side by side, against the best path of each by itself; a word that comes again is not looked at anew."""
    from types import SimpleNamespace

    import numpy as np

    from emberlane.operators import tagger

    rng, labels = np.random.default_rng(4), ("GPE", "NORP")
    model = tagger.Tagger(labels, rng.normal(size=tagger.empty(labels).shape).astype(np.float32))
    signs = random.Random(4)
    texts = ["".join(signs.choice(["ab", "Cé", "İ", "NY", "7", "_", "'", "’", "-", ".", "!", "\n", " ", " ", "\U0001d7d8"]) for _ in range(n)) for n in (1, 9, 80, 900)] + ["Ab " * 450 + ". ab", "", None]
    word, told = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*|[.!?\n]"), 0
    for text in texts:
        whole = [[]]
        for m in word.finditer(text or ""):
            if m[0] in ".!?\n" or len(whole[-1]) == tagger.LONGEST:
                whole.append([])
            if m[0] not in ".!?\n":
                whole[-1].append(m)
        expected = []
        for at in filter(None, whole):
            held = None
            for m, t in zip(at, tagger.viterbi(model.weights[: tagger.SLOTS][tagger.features([m[0] for m in at])].sum(1), model.weights[tagger.SLOTS :]).tolist()):
                if held and t == 2 * held[2] + 2:
                    expected[-1] = (held[0], m.end(), labels[held[2]])
                    continue
                held = (m.start(), m.end(), (t - 1) // 2) if t else None
                if held:
                    expected.append((*held[:2], labels[held[2]]))
        assert list(model.spans(text)) == expected
        told += len(expected)
    assert told > 100
    sums, crc32 = [], tagger.zlib.crc32
    monkeypatch.setattr(tagger, "zlib", SimpleNamespace(crc32=lambda *a: sums.append(1) or crc32(*a)))
    assert len(list(model.spans("one Word more. " * 500))) > 0 and len(sums) < 2 * 1500


def test_names_alone_meet_by_a_join(spark):
    """Words that cannot be names are not sent; rows that repeat an item stay apart."""
    from emberlane.operators import tagger

    items = spark.createDataFrame([(1, "Élan in Rome. None here! rome, Élan"), (1, "Oslo in Rome. None here!"), (2, None), (3, "")], "item long, text string")
    names = spark.createDataFrame([("rome", "GPE"), ("élan", "NORP"), ("oslo", "GPE"), (None, "GPE"), ("paris", "X")], "match string, label string")
    labels = ("GPE", "NORP")
    told = sorted((r["item"], r["sentence"], r["place"], r["word"], r["tag"]) for r in tagger.named(items, names, labels).collect())
    assert told == [("1", 0, 0, "Oslo", 1), ("1", 0, 0, "Élan", 3), ("1", 0, 2, "Rome", 1), ("1", 0, 2, "Rome", 1), ("1", 2, 0, "rome", 1), ("1", 2, 1, "Élan", 3)]
    whole = [(["Oslo", "in", "Rome"], [1, 0, 1]), (["Élan", "in", "Rome"], [3, 0, 1]), (["rome", "Élan"], [1, 3])]
    of = lambda d: sorted((r["words"], r["tags"]) for r in d.collect())
    assert of(tagger.labelled(items, names, labels, False)) == sorted(whole)
    assert of(tagger.labelled(items, names, labels)) == sorted([*whole, (["None", "here"], [0, 0]), (["None", "here"], [0, 0])])


def test_an_index_is_written_without_shuffling_tokens(spark, tmp_path):
    """A row's postings are found in the row; only rows that repeat a key are merged."""
    import pyarrow as pa

    from emberlane.operators import fulltext

    rows = pa.RecordBatch.from_arrays([pa.array(["1", "2", "3"]), pa.array(["en", "", "de"]), pa.array([["a", "b", "", "a"], [], ["b"]])], ["doc", "lang", "_tokens"])
    told = [r for b in fulltext._posted(iter([rows, rows.slice(1, 1)])) for r in b.to_pylist()]
    assert sorted((r["term"], r["lang"], r["doc"], r["positions"]) for r in told) == [("a", "en", "1", [0, 3]), ("b", "de", "3", [0]), ("b", "en", "1", [1])]
    borders = ["b", "d", "f"]
    terms = spark.createDataFrame([(t,) for t in "abcdefg"], "term string")
    assert [r[0] for r in terms.orderBy("term").select(fulltext.bucket_of(F.col("term"), borders)).collect()] == [0, 1, 1, 2, 2, 3, 3]
    index = fulltext.add(fulltext.Index(spark, f"file://{tmp_path}/index", 4), spark.createDataFrame([(1, "en", "fire at noon"), (1, "en", "a fire"), (2, "en", None), (3, "en", "noon")], "doc_id long, lang string, text string"), ["text"])
    assert sorted(tuple(r) for r in index.docs().select("doc", "n_tokens").collect()) == [("1", 5), ("2", 0), ("3", 1)]
    read = spark.read.parquet(f"{index.path}/{index.segments()[0]['name']}/postings")
    assert sorted((r["term"], r["doc"], r["positions"]) for r in read.where("term = 'fire' or term = 'noon'").collect()) == [("fire", "1", [0, 1]), ("noon", "1", [2]), ("noon", "3", [0])]
