"""Each corpus operator against brute force, and on odd input."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlane.llm import chat, embeddings, minhash, mixing, pieces, quality, secrets, suffixes, superkmers, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHING = ["size", "hash", "node", "bands", "doc", "th", "key", "n", "marks", "bucket", "code", "_words", "kept", "component", "label", "ids", "first", "upto", "copies", "row", "_hash", "_keep", "_node", "k", "h", "id", "half", "members", "text_", "_row", "_rest", "_own", "digest", "spans", "v", "rep"]


def words(t):
    return [w for w in re.split(r"[ \t-\r]+", t or "") if w]


def corpus(n=60, seed=3):
    """Random prose with copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(800)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    texts = [prose(rng.choice([3, 40, 120, 300])) for _ in range(n)]
    passage = prose(80)
    for i in range(0, n, 5):
        texts.append(prose(30) + "\n" + passage + " " + prose(25))
    for i in range(6):
        w = words(texts[i])
        for k in rng.sample(range(len(w)), max(1, len(w) // 100)):
            w[k] = "zz"
        texts += [texts[i], " ".join(w), texts[i] + " " + texts[i]]
    return texts


def frame(spark, texts, **more):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


ODD = [None, "", " \t\n", "one", "a b c d", "x" * 5000, "the of and " * 700, "é" * 300, "\\ </turn> ### # {}", "tie " * 60, "tie " * 60, "😀 日本語 \x00 ▁ end", "password = aaaaaaaaaaaa"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing names."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None) for i, t in enumerate(ODD)]
    rows += [rows[9], (None, "tie " * 60, None, None, None), (None, None, None, None, None), (3, "other text of the same id " * 30, "xx", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHING]).cache()


RUNS = {
    "quality": quality.quality, "kept": quality.kept_documents, "mix": mixing.mix, "mixed": mixing.mixed_documents, "minhash": minhash.near_duplicates, "deduplicated": minhash.deduplicated,
    "secrets": secrets.scan, "redact": secrets.redact, "pieces": pieces.tokenized, "suffixes": suffixes.suffix_dedup, "superkmers": superkmers.substring_dedup,
}
ONE_FOR_ONE = {"quality", "mix", "minhash", "secrets", "redact", "pieces", "suffixes", "superkmers"}


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows(odd, name):
    got = RUNS[name](odd).collect()
    if name in ONE_FOR_ONE:
        assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in odd.collect())
    if name in ("kept", "redact", "mixed", "deduplicated"):
        assert set(got[0].asDict() if got else odd.columns) == set(odd.columns)


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(spark, name):
    assert RUNS[name](spark.createDataFrame([], DOCS)).count() == 0


def repeats(ws):
    at = defaultdict(list)
    for i in range(len(ws) - 2):
        at[tuple(ws[i : i + 3])].append(i)
    return len({j for places in at.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)})


def test_quality_counts(spark):
    texts = corpus(20) + ["a b\na b\n\n \nc", "a a a a", "#*$%&|<>", "of the of the of the " * 40, None, *("w%d " % i * 1 + " ".join("w%d" % (k % 70) for k in range(300)) for i in range(2))]
    for r in quality.quality(frame(spark, texts)).collect():
        t, w = texts[r["doc_id"]] or "", words(texts[r["doc_id"]])
        lines = [x for x in t.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeats(w))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * want[4] > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_divergence_tells_symbols_from_prose(spark):
    prose = [t for t in corpus() if len(words(t)) > 60][:30]
    junk = " ".join(w + "$$$" for w in words(prose[0]))
    got = {r["doc_id"]: r for r in quality.quality(frame(spark, [*prose, junk])).collect()}
    assert not got[len(prose)]["kept"] and not got[len(prose)]["base_failed"]
    assert all(got[i]["kept"] or got[i]["base_failed"] for i in range(len(prose)))


def test_mix_near_targets(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, "w " * rng.randint(1, 30), "en", rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(2000)], DOCS)
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
    weight, cap = dict(zip(["a", "b", "c", None], [5, 2, 1, 5])), {s: 3 * n for s, n in sizes.items()}
    left, free, want = sum(sizes.values()), set(weight), {}
    while free:  # reshare until none is above
        per = left / sum(weight[s] for s in free)
        over = {s for s in free if per * weight[s] > cap[s]}
        want |= {s: cap[s] if s in over else per * weight[s] for s in (over or free)}
        left -= sum(cap[s] for s in over)
        free = free - over if over else set()
    for s in weight:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 30
    copies = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert all(copies[r["doc_id"]] * r["size"] == r["taken"] for r in got)


def test_mix_of_rows_that_share_an_id_or_all(spark):
    """Null and repeated ids, with texts of their own and without, do not make a source indivisible."""
    for ids, text in ((None, "w x y z"), (7, "w%d x y z")):
        rows = [(ids, text % i if "%" in text else text, "en", s, 1) for s in ("a", "b") for i in range(500)]
        docs = spark.createDataFrame(rows, DOCS).repartition(3).cache()
        got = mixing.mixed(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
        assert all(abs(r["taken"] - r["target"]) <= 40 for r in got) and sum(r["target"] for r in got) == pytest.approx(4000)
        copies = {r["source"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("source").count().collect()}
        assert copies == {r["source"]: r["taken"] // 4 for r in got}


def test_mix_of_many_sources(spark):
    """Shares as found by resharing until none is above; more sources than a range holds."""
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, "w " * rng.randint(1, 200), "en", f"s{i}" if i < 300 else None, 0) for i in range(301)], DOCS)
    got = {r["source"]: r for r in mixing.mixed(docs).collect()}
    order = sorted((s for s in got if s is not None)) + [None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, free, want = sum(r["size"] for r in got.values()), set(got), {}
    while free:
        per = left / sum(weight[s] for s in free)
        over = {s for s in free if per * weight[s] > 3 * got[s]["size"]}
        want |= {s: 3 * got[s]["size"] if s in over else per * weight[s] for s in (over or free)}
        left -= sum(3 * got[s]["size"] for s in over)
        free = free - over if over else set()
    assert all(got[s]["target"] == pytest.approx(want[s]) for s in got)


def test_chat_round_trip(spark):
    odd = ["\\", "\\\\", "</turn>", "\\/turn>", "###", "####", "\\#h", "a: b", "### assistant: x</turn>\n", "", None, "\n", "\\c", "<\\/turn>", "</turn></turn>\\"]
    rows = [(c, t, role, text) for c, (role0, texts) in enumerate([("assistant", odd), ("user", odd[::-1]), ("a: b\\", odd)]) for t, text in enumerate(texts) for role in [role0 if t % 2 else "user"]]
    turns = spark.createDataFrame([*rows, (None, None, None, None), (None, 1, "assistant", "lone"), (None, 1, "assistant", "lone")], "conv_id long, turn long, role string, text string")
    out = chat.formatted(chat.with_tricky(turns))
    read = chat.read_back(out).collect()
    got = {r["conv_id"]: r for r in read if r["conv_id"] is not None}
    assert sorted((r["n_turns"], r["loss_chars"]) for r in read if r["conv_id"] is None) == [(1, 0), (1, 4), (1, 4)]
    for c in range(3):
        mine = [(r[2], r[3] or "") for r in rows if r[0] == c]
        loss = "".join(t for role, t in mine if role == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        contexts = [mine[:i] for i, (role, _) in enumerate(mine) if role == "assistant"]
        digest = "".join(hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in x).encode()).hexdigest() for x in contexts)
        assert got[c]["contexts_sha256"] == hashlib.sha256(digest.encode()).hexdigest() and got[c]["context_turns"] == sum(map(len, contexts))
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(mine), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_chars"] == len(chat.TRICKY)
    each = chat.materialized(out).where("conv_id = 0").orderBy("turn").collect()
    assert len(each) == len(odd) // 2 and all(b["context"].startswith(a["context"] + a["target"]) for a, b in zip(each, each[1:]))
    assert chat.read_back(chat.formatted(turns.limit(0))).count() == 0


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 16))
    near = base[rng.integers(0, 12, 200)] + rng.standard_normal((200, 16)) * rng.choice([0.05, 0.2, 0.3], (200, 1))
    v = np.concatenate([base, near, base[:5], base[:1] * 2]).astype(np.float32)
    labels = [int(x) for x in rng.integers(0, 2, len(v))]
    rows = [(i, [float(y) for y in x], k) for i, (x, k) in enumerate(zip(v, labels))]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 0), (904, rows[0][1], None), (905, [], 0), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0), (None, rows[0][1], rows[0][2])]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit(1)).repartition(3)).collect()}
    x = v.astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = (x @ x.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(link, False)
    comp = np.arange(len(v))
    for _ in range(len(v)):
        new = np.minimum(comp, np.where(link, comp, len(v)).min(1))
        if (new == comp).all():
            break
        comp = new
    extra = link[0].copy()  # the row without an id is one more copy of vector 0
    extra[0] = True
    for i in range(len(v)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (link[i].sum() + extra[i], comp[i], comp[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904, 905))
    assert got[907]["component_id"] == 906 and got[906]["n_links"] == 1
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_more_vectors_get_more_bits_and_tables(spark):
    assert embeddings.bits_for(0) == embeddings.bits_for(1 << 20) == 10 and embeddings.tables_for(10) == 32
    assert embeddings.bits_for(1 << 30) == 20 and embeddings.bits_for(1 << 50) == 31
    for bits in range(10, 32):
        assert (1 - embeddings.AGREE**bits) ** embeddings.tables_for(bits) <= embeddings.MISSED
    rng = np.random.default_rng(6)
    base = rng.standard_normal((300, 24))
    v = np.concatenate([base, base[rng.integers(0, 100, 700)] + rng.standard_normal((700, 24)) * rng.choice([0.1, 0.25, 0.35], (700, 1))])
    rows = spark.createDataFrame([(i, [float(y) for y in x], 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    x = v / np.linalg.norm(v, axis=1)[:, None]
    true = (x @ x.T >= 0.93).sum(1) - 1
    got = embeddings.near_duplicates(rows, bits=20).toPandas().set_index("vec_id").n_links.sort_index().to_numpy()
    assert true.sum() > 1000 and (got <= true).all() and got.sum() >= 0.999 * true.sum()


def test_big_buckets_are_dealt_in_blocks(spark):
    rng = np.random.default_rng(9)
    v = (np.ones(8) + rng.standard_normal((2600, 8)) * 0.02).astype(np.float32)
    got = embeddings.near_duplicates(spark.createDataFrame([(i, [float(y) for y in x], 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")).toPandas()
    assert len(v) > 2 * embeddings.BLOCK and (got.n_links == len(v) - 1).all() and (got.component_id == 0).all()


@pytest.fixture(scope="module")
def coder():
    return pieces.coder(pieces.vocabulary())


def test_pieces_equal_the_library(coder):
    import public_tokenizers
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t for t in [*corpus(), *ODD, "  two  spaces ", " " * 70 + "x", "abc" * 900] if t is not None and "▁" not in t and "\x00" not in t]
    for t, ids in zip(texts, coder.encode(texts, [0] * len(texts))):
        assert ids.tolist() == m.encode(t)


def test_dropout_is_keyed_lossless_and_the_same_by_heap(coder, monkeypatch):
    texts = [t or "" for t in [*corpus(), *ODD]]
    keys = [pieces.key_of(i, 1) for i in range(len(texts))]
    a = coder.encode(texts, keys, 0.2)
    assert all(coder.decode(x) == t for x, t in zip(a, texts))
    alone = [coder.encode([t], [k], 0.2)[0].tolist() for t, k in zip(texts, keys)]
    assert alone == [x.tolist() for x in a]
    other = coder.encode(texts, [pieces.key_of(i, 2) for i in range(len(texts))], 0.2)
    assert sum(len(x) for x in a) > sum(len(x) for x in coder.encode(texts, keys)) and any(x.tolist() != y.tolist() for x, y in zip(a, other))
    monkeypatch.setattr(pieces, "SHORT", 0)
    assert [x.tolist() for x in coder.encode(texts[:30], keys[:30], 0.2)] == alone[:30]


def test_warc_round_trip(spark):
    rng = random.Random(2)
    html = ["", None, "x" * 99, "x" * 100, "é" * 60, *("p%d " % (i % 7) * 60 for i in range(30)), "y" * 200000]
    rows = [(i, f"http://a/{i} b", h) for i, h in enumerate(html)]
    rng.shuffle(rows)
    rows += [(200, "u", "x" * 100), (200, None, "x" * 100), (None, "u", "x" * 100), (None, "u", "unlike any other " * 20)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    least = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            least[h] = min(i, least.get(h, i))
    want = Counter()
    for i, _, h in rows:
        h = (h or "").encode()
        first = least.get(h)
        revisit = first is not None and first != i
        want[i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter(tuple(r) for r in got) == want
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_salvage(spark, tmp_path):
    bodies = [b"a" * 50, b"b" * 3000, b"c" * 10, b"d" * 500, b"e" * 70]
    plain = [warc.record(i, "u", x, hashlib.sha256(x).hexdigest(), None) for i, x in enumerate(bodies)]
    parts = [warc.member(p) for p in plain]
    found = lambda data: [int(re.search(r"\d+", w[0]["warc-record-id"])[0]) for k, _, _, w in warc.salvage(data) if k == "record"]
    gaps = lambda data: [(a, z) for k, a, z, _ in warc.salvage(data) if k == "gap"]
    whole = b"".join(parts)
    assert found(whole) == [0, 1, 2, 3, 4] and not gaps(whole) and found(b"".join(plain)) == [0, 1, 2, 3, 4]
    at = len(parts[0])
    broken = bytearray(whole)
    broken[at + len(parts[1]) // 2] ^= 0xFF
    assert found(bytes(broken)) == [0, 2, 3, 4] and gaps(bytes(broken)) == [(at, at + len(parts[1]))]
    cut = whole[: at + 9] + b"".join(parts[2:])  # a member cut off
    assert found(cut) == [0, 2, 3, 4] and gaps(cut) == [(at, at + 9)]
    wrong = plain[1].replace(b"b", b"B", 1) if False else plain[1][:-10] + b"X" + plain[1][-9:]  # digest differs
    assert found(plain[0] + wrong + plain[2]) == [0, 2] and found(b"junk" + whole + b"tail") == [0, 1, 2, 3, 4]
    (tmp_path / "x.warc.gz").write_bytes(bytes(broken))
    content = warc.open_archives(spark, str(tmp_path))
    assert warc.records(content).count() == 4
    (gap,) = warc.quarantined(content).collect()
    assert (gap["start"], gap["end"]) == (at, at + len(parts[1])) and "gzip" in gap["reason"]
    rng = random.Random(5)
    for _ in range(60):  # no byte is lost: records and gaps cover all (both, where a member's checksum alone is wrong)
        data = bytearray(whole)
        for _ in range(3):
            data[rng.randrange(len(data))] ^= 1
        spans = [(a, z) for _, a, z, _ in warc.salvage(bytes(data))]
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(p[1] == q[0] or p == q for p, q in zip(spans, spans[1:]))


def test_secrets():
    f = lambda t: secrets.joined(secrets.find(t))
    assert f("password=b7db7aa4a5") == "assign:0:19" and f("PassWD : 'abcdefgh' x") == "assign:0:18"
    assert f("token=short") == "" and f("é api-key=abcdefgh") == "" and f("é apikey=abcdefgh12").startswith("assign:2:")
    assert f("AKIA" + "A" * 11) == "" and f("xAKIA" + "A" * 12) == "access:1:17" and f("0" * 31) == "" and f("g" + "0f" * 16) == "hex:1:33"
    assert f("secret=token=abc: password=longenough1") == "assign:0:16,assign:18:38"
    assert f("pwd: xK9$z!qW7") == "guess:5:14" and f("pwd: password") == "" and f("passcode: qwertyuiop") == ""
    assert secrets.find(None) == [] and secrets.redacted("a token=abcdefgh. b", secrets.find("a token=abcdefgh. b")).startswith("a <assign>")
    t = "pwd: xK9$z!qW7 and " + "0f" * 16
    assert secrets.find(secrets.redacted(t, secrets.find(t))) == []


def test_minhash_links_rows_without_an_id(spark):
    rng = random.Random(9)
    base = lambda: [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    said = lambda w, *at: " ".join("zz" if i in at else x for i, x in enumerate(w))
    a, b, c, d = base(), base(), base(), base()
    rows = [
        (None, said(a)), (None, said(a, 9)), (None, said(a, 9)),  # near copies and a copy, none with an id
        (5, said(b)), (None, said(b, 40)),  # near an id's text
        (7, said(c, 10, 30, 50)), (None, said(c)), (8, said(c, 110, 130, 150)),  # two ids that only meet through a text without one
        (None, said(d)), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    judged = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert judged[(5, 5, True)] == judged[(None, 5, False)] == 1
    assert judged[(7, 7, True)] == judged[(None, 7, False)] == judged[(8, 7, False)] == 1
    assert judged[(None, None, True)] + judged[(None, None, False)] == 5 and judged[(None, None, False)] in (1, 2)
    left = [(r["doc_id"], r["text"]) for r in minhash.deduplicated(docs).collect()]
    assert len(left) == 5 and sum(t in (said(a), said(a, 9)) for _, t in left) == 1
    assert {(5, said(b)), (7, said(c, 10, 30, 50)), (None, said(d)), (None, None)} < set(left)


def test_warc_salvage_inside_a_member():
    """One fault in a member of several records costs the record it is in."""
    rng = random.Random(2)
    bodies = [rng.randbytes(9000) for _ in range(5)]
    plain = [warc.record(i, "u", x, hashlib.sha256(x).hexdigest(), None) for i, x in enumerate(bodies)]
    ids = lambda data: [int(re.search(r"\d+", w[0]["warc-record-id"])[0]) for k, _, _, w in warc.salvage(data) if k == "record"]
    gaps = lambda data: [x[1:] for x in warc.salvage(data) if x[0] == "gap"]
    whole = warc.member(b"".join(plain))
    assert ids(whole) == [0, 1, 2, 3, 4] and not gaps(whole)
    bad = warc.member(b"".join([*plain[:2], plain[2][:-10] + b"X" + plain[2][-9:], *plain[3:]]))
    ((a, z, why),) = gaps(bad)
    assert ids(bad) == [0, 1, 3, 4] and (a, z) == (0, len(bad)) and f"bytes {len(plain[0]) * 2} to {len(plain[0]) * 3} of" in why
    after = warc.member(plain[0])
    for data in (whole[: len(whole) * 7 // 10], whole[: len(whole) * 7 // 10] + after):  # cut off, and with a member behind it
        assert ids(data) == [0, 1, 2] + [0] * data.endswith(after) and gaps(data)
    damaged = bytearray(whole)
    damaged[-6] ^= 0xFF  # the checksum
    assert ids(bytes(damaged) + after) == [0, 1, 2, 3, 4, 0] and any("gzip" in g[2] for g in gaps(bytes(damaged) + after))
    revisit = warc.member(warc.record(9, "u", bodies[0], hashlib.sha256(bodies[0]).hexdigest(), 0))
    assert ids(revisit) == [9] and ids(revisit[:-6] + bytes([revisit[-6] ^ 0xFF]) + revisit[-5:]) == []


def test_warc_no_record_out_of_a_payload(spark):
    """A damaged record that holds another in its payload gives none; a spare copy gives what was lost."""
    inner = warc.record(7, "u", b"x" * 30, hashlib.sha256(b"x" * 30).hexdigest(), None)
    rec = lambda i, body: warc.record(i, "u", body, hashlib.sha256(body).hexdigest(), None)
    ids = lambda told: sorted(int(re.search(r"\d+", w[0]["warc-record-id"])[0]) for k, _, _, w in told if k == "record")
    parts = [rec(0, b"a" * 200), rec(1, b"b" * 50 + inner + b"c" * 50), rec(2, b"d" * 90)]
    for at in (40, -2):  # in the payload, and in the end marks
        bad = bytearray(parts[1])
        bad[parts[1].index(b"bbbb") if at > 0 else at] ^= 1
        for pack in (lambda x: x, warc.member):
            data = pack(parts[0] + bytes(bad) + parts[2])
            assert ids(warc.salvage(data)) == [0, 2] and any(x[0] == "gap" for x in warc.salvage(data))
    whole = b"".join(map(warc.member, parts)) + warc.member(parts[0] + parts[2])
    rng = random.Random(3)
    for _ in range(60):
        broken = bytearray(whole)
        for _ in range(rng.choice([1, 3])):
            broken[rng.randrange(len(broken))] ^= 0xFF
        assert ids(warc.mended(bytes(broken), whole)) == [0, 0, 1, 2, 2]
    assert ids(warc.mended(whole, None)) == ids(warc.mended(whole, whole)) == [0, 0, 1, 2, 2]
    both = warc.salvaged(spark.createDataFrame([(whole[:-30], None), (None, None)], "content binary, spare binary")).collect()
    assert len([r for r in both if r["reason"]]) >= 1 and {r["page_id"] for r in both if not r["reason"]} >= {0, 1, 2}


def test_warc_bombs_are_bounded(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 10_000)
    body = b"z" * 100_000
    first = warc.record(1, "u", b"y" * 20, hashlib.sha256(b"y" * 20).hexdigest(), None)
    data = warc.member(first + warc.record(0, "u", body, hashlib.sha256(body).hexdigest(), None)) + warc.member(first)
    told = list(warc.salvage(data))
    assert [x[0] for x in told].count("record") == 2 and any(x[0] == "gap" and "too many" in x[3] for x in told)


def test_every_context_value_is_scored(spark):
    """A pattern's span over part of a value, or all of it, does not end its scoring."""
    t = "password: Tr0ub4dor&3xyz!kQ"
    assert secrets.joined(secrets.find(t)) == "assign:0:19,guess:10:27" and secrets.redacted(t, secrets.find(t)) == "<assign>"
    texts = [t, "password=b7db7aa4a5", "token=abcdefgh"]
    assert [r["spans"] for r in secrets.scan(frame(spark, texts)).orderBy("doc_id").collect()] == ["assign:0:19,guess:10:27", "assign:0:19,guess:9:19", "assign:0:14"]
    assert [r["text"] for r in secrets.redact(frame(spark, texts)).orderBy("doc_id").collect()] == ["<assign>"] * 3
    assert secrets.guess_cost("A" * 50_000) < secrets.MIN_COST  # in time that grows with the length


def test_joined_keys_are_contexts():
    """Every key that the base pattern takes is a context too; in prose the word stands alone."""
    for key in ("dbPassword=", "authToken: ", "clientSecret=", "my2api_key = '", '"userPasswd": "', "db_password="):
        t = key + "k$9!zQ#w2R"
        assert secrets.joined(secrets.find(t)) == f"guess:{len(key)}:{len(t)}" and secrets.redacted(t, secrets.find(t)) == key + "<guess>"
    assert secrets.joined(secrets.find("the secret is dbPassword: k$9!zQ#w2R")).endswith("guess:26:36")
    assert secrets.find("the token is k$9!zQ#w2R") and not secrets.find("the mytoken is k$9!zQ#w2R")


def cheap_spans(v, i, rank):
    """Every cheap span from i, found by looking at all its ends."""
    leet = dict(zip("@4301!$57", "aaeoiisst"))
    rows = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qazwsxedcrfvtgbyhnujm")
    beside = {x + y for r in rows for a, b in zip(r, r[1:]) for x, y in ((a, b), (b, a))}
    for j in range(i + 1, len(v) + 1):
        p = v[i:j]
        low = p.lower()
        if len(p) >= 3:
            for form, extra in ((low, 0.0), ("".join(leet.get(c, c) for c in low), 0.5)):
                if form in rank:
                    yield j, math.log10(rank[form] + 1) + extra + (0.5 if any(c.isalpha() for c in p) and not p.islower() else 0.0)
                    break
        for unit in range(1, len(p) // 2 + 1):
            k = len(p) // unit
            if k > 1 and p == p[:unit] * k and v[j : j + unit] != p[:unit]:
                yield j, unit * 1.5 + math.log10(k)
        if len(p) >= 3:
            steps = {ord(y) - ord(x) for x, y in zip(p, p[1:])}
            if steps in ({1}, {-1}) and not (j < len(v) and ord(v[j]) - ord(v[j - 1]) in steps):
                yield j, 1.2 + math.log10(len(p))
            if all(x + y in beside for x, y in zip(low, low[1:])) and not (j < len(v) and (v[j - 1] + v[j]).lower() in beside):
                yield j, 1.8 + math.log10(len(p))
    if m := secrets.DATE.match(v, i):
        yield m.end(), 4.5 if m.end() - i > 4 else 2.1


def test_guess_cost_is_the_least():
    """Against all segmentations of short values into spans found one by one."""
    rank = {}
    for w in secrets.dictionary():
        rank.setdefault(w, len(rank) + 1)
    rng = random.Random(4)
    parts = ["password", "P@ss", "qwe", "1234", "2024", "1999-12-31", "aaa", "abab", "xyz", "Q", "k$", "drag0n", "lkj", "987", "é"]
    assert len(rank) > 5000
    unit = "kV8$wq!Zt3@Lm9#Rb5%Xc7^Nd1&Hf0*Gj4(Ps6)Y"  # forty characters
    assert len(unit) == 40 and secrets.guess_cost(unit * 2) < 65 < secrets.guess_cost(unit)
    for v in [unit * 2, "a" + unit * 3, max(rank, key=len) + "1", "password1", "19991231x", "aaaabbbb", "qwe123!Z", "xK9$z!qW", "abcdxyz", "P@ssw0rd2024", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(80))]:
        best = [0.0] + [math.inf] * len(v)
        for i in range(len(v)):
            for j, c in [(i + 1, secrets.brute(v)), *((j, c + math.log10(2)) for j, c in cheap_spans(v, i, rank))]:
                best[j] = min(best[j], best[i] + c)
        assert secrets.guess_cost(v) == pytest.approx(best[-1]), v
        assert secrets.guesser().secret(v) == (len(v) >= secrets.MIN_VALUE and best[-1] >= secrets.MIN_COST), v
    assert secrets.guess_cost("password") < secrets.guess_cost("passw0rd") < secrets.guess_cost("xK9$z!qW")


def base_spans(t):
    """The three patterns, character by character."""
    word, low = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"), t.lower()

    def run(i, allowed):
        while i < len(t) and t[i] in allowed:
            i += 1
        return i

    def assign(i):
        for key in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if t[i : i + len(key)].isascii() and low[i : i + len(key)] == key:
                j = i + len(key)
                j += j < len(t) and t[j] in "\"'"
                j = run(j, " ")
                if j < len(t) and t[j] in ":=":
                    j = run(j + 1, " ")
                    j += j < len(t) and t[j] in "\"'"
                    if (z := run(j, word)) > j:
                        return z, z - j >= 8
        return i, False

    def access(i):
        z = run(i + 4, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")) if t[i : i + 4] == "AKIA" else i
        return (z, z - i >= 16) if z > i + 4 else (i, False)

    def hexes(i):
        z = run(i, set("0123456789abcdef"))
        return z, z - i >= 32

    out = []
    for kind, at in enumerate((assign, access, hexes)):
        i = 0
        while i < len(t):
            z, long = at(i)
            out += [(i, kind, z)] * long
            i = max(z, i + 1)
    return sorted(out)


def test_base_spans_character_by_character(spark):
    rng = random.Random(8)
    parts = ["password", "PassWD", "token", "api_key", "APIKEY", "secret", "=", ":", " ", "  ", "'", '"', "abcdefgh", "0f" * 16, "0f" * 15, "AKIA", "AKIA" + "A" * 12, "Z9", "é", "ſ", "K", ".", "\n", "deadbeef" * 5]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert sum(bool(base_spans(t)) for t in texts) > 500
    for t in texts:
        assert [s for s in secrets.found(t) if s[1] < 3] == base_spans(t), t
    docs = frame(spark, texts[:300])
    for r in secrets.scan(docs).collect():
        base = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(secrets.joined(base).encode()).hexdigest() and [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]


def test_long_values_and_many_spans():
    """In time that grows with the text."""
    began = time.time()
    noise = "".join(random.Random(1).choices("abcXYZ019$", k=10_000_000))
    assert secrets.find("pwd: " + noise) == [(5, 3, 5 + len(noise))]
    for long in ("z" * 10_000_000, "qw" * 2_000_000, "abc" * 3_000_000):
        secrets.find("pwd: " + long)
    many = "token=abcdefgh1 pwd: xK9$z!qW7\n" * 100_000
    assert len(secrets.find(many)) >= 200_000 and time.time() - began < 120


def without_long_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1, 1000])
def test_suffixes(spark, hot):
    texts = corpus() + ["ab" * 400, "ab" * 90, "abc" * 200 + "q" * 150, None, "", "x" * 200]
    want = without_long_repeats(texts)
    got = suffixes.suffix_dedup(frame(spark, texts), replace(suffixes.KIND, hot=hot)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == dict(enumerate(want)) and sum(w[1] for w in want) > 5000


def test_suffix_sort():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    data[1000:1500] = data[2000:2500]
    s = suffixes.Suffixes(data)
    start = np.arange(3000)
    group = np.repeat([0, 1, 2], [1, 1999, 1000])
    order = s.sort(start, group)
    raw = data.tobytes()
    for g in range(3):
        mine = order[group == g]
        assert [raw[i : i + 200] for i in mine] == sorted(raw[i : i + 200] for i in np.flatnonzero(group == g))
    x, y = rng.integers(0, 3000, (2, 500))
    common = [next((k for k in range(200) if raw[a + k] != raw[b + k]), 200) for a, b in zip(x, y)]
    assert s.extension(x, y).tolist() == common


def without_repeats(texts):
    least, all_words = {}, [words(t) for t in texts]
    for d, w in enumerate(all_words):
        for i in range(len(w) - 12):
            least.setdefault(tuple(w[i : i + 13]), d)
    out = []
    for d, w in enumerate(all_words):
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if least[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = [True] * 13
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1, 1000])
def test_superkmers(spark, hot):
    texts = corpus() + ["a b " * 30, "a b\n" * 20, "a\tb  " * 20, None, "", " ".join(map(str, range(13)))]
    got = superkmers.substring_dedup(frame(spark, texts), replace(superkmers.KIND, hot=hot)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == dict(enumerate(without_repeats(texts)))


def test_one_text_with_a_window_in_very_many_places(spark):
    """Such a window is one row for its text, in strings and one by one."""
    from emberlane.llm import windows

    once = " ".join(f"w{i}" for i in range(13))
    texts = [" ".join(f"{once} q{i}" for i in range(8000)), "x " + once + " y", "z " * 5 + once]
    want = dict(enumerate(without_repeats(texts)))
    for hot in (1000, 1 << 40):
        docs, kind = frame(spark, texts), replace(superkmers.KIND, hot=hot)
        assert {r["doc_id"]: tuple(r)[1:] for r in superkmers.substring_dedup(docs, kind).collect()} == want
    ids = np.zeros(1, np.int64)
    d = np.zeros(100_000, np.uint64)
    assert windows.settle_digests(d, d, d.astype(np.int64), np.arange(100_000) * 20, ids, ids, superkmers.KIND).num_rows == 1
    assert windows.settle(ids.repeat(9), ids.repeat(9), np.arange(9), ids.repeat(9) + 1, [b"a"] * 9, ids, ids, superkmers.KIND).num_rows == 1


def shingles(t):
    w = words(t)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_minhash_against_all_pairs(spark):
    texts = corpus(80) + ["a b c " * 100, "a b c " * 95 + "d e f " * 5, None, "", " ", "one", "one", "one two", *["same words here again and more"] * 3]
    rng = random.Random(8)
    centre = ["w%d" % i for i in range(200)]
    for k in [1, 2, 2, 3, 3, 4, 5, 6, 8]:  # copies that are near the centre and less near to each other
        w = list(centre)
        for i in rng.sample(range(200), k):
            w[i] = f"z{rng.random()}"
        texts.append(" ".join(w))
    sets = [shingles(t) for t in texts]
    comp = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and sum((a & sets[j]).values()) >= 0.8 * sum((a | sets[j]).values()):
                x, y = comp[i], comp[j]
                comp = [min(x, y) if c in (x, y) else c for c in comp]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert {i: got[i]["component_id"] for i in got} == dict(enumerate(comp))
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert sorted(r["doc_id"] for r in minhash.deduplicated(frame(spark, texts)).collect()) == sorted(set(comp))


def test_dedup_goes_by_id_and_text(spark):
    """Of rows that repeat an id each is judged by its own text; a hash of another text keeps it."""
    rng = random.Random(5)
    a, b = (" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(100)) for _ in range(2))
    docs = spark.createDataFrame([(3, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1)], DOCS)
    assert sorted((r["doc_id"], r["text"]) for r in minhash.deduplicated(docs).collect()) == [(3, a), (5, b)]
    clash = docs.withColumnsRenamed({"lang": "_hash", "source": "_keep"})
    assert set(minhash.deduplicated(clash).columns) == set(clash.columns)


def test_hot_bucket_class_and_component(spark, monkeypatch):
    """One group of copies and near copies with most rows: pivots, blocks and members are dealt."""
    monkeypatch.setattr(minhash, "MEMBERS", 8)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)] * 30
    for _ in range(60):
        w = list(base)
        w[rng.randrange(150)] = f"z{rng.random()}"
        texts.append(" ".join(w))
    texts += [" ".join(f"q{rng.random()}" for _ in range(40)) for _ in range(20)]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert all(got[i]["component_id"] == (0 if i < 90 else i) and got[i]["kept"] == (i == 0 or i >= 90) for i in got) and got[29]["class_id"] == 0


def test_signatures_estimate_weighted_similarity():
    from emberlane.llm.common import utf8
    import pyarrow as pa

    texts = ["a b c d e f g " * 30, "a b c d e f g " * 20 + "h i j k l m " * 10, " ".join(map(str, range(300))), " ".join(map(str, range(30, 330))), "one"]
    h, doc, count = minhash.weighted(*minhash.shingles(*utf8(pa.array(texts))))
    sig = minhash.signatures(h, doc, count, len(texts))
    assert (sig != 0).all()
    for a, b in ((0, 1), (2, 3), (0, 2)):
        x, y = shingles(texts[a]), shingles(texts[b])
        assert abs((sig[a] == sig[b]).mean() - sum((x & y).values()) / sum((x | y).values())) < 0.15


def test_components(spark):
    from emberlane.llm.graph import components

    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
