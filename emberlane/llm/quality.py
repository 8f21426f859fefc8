"""Quality rules by distribution divergence, in DataFrame functions alone.

A document's histogram of character classes and its histogram of common words
are held against references of its language by Jensen-Shannon distance (the
square root of the divergence to base 2, 0 to 1). The references are sums over
all documents of that language, so they are fitted on the whole corpus. A guard
by length keeps short texts, whose histograms are noise, out of the comparison.

Defined cases: a null or blank text has no words and fails the base rules; a
null lang, or one without a word list, is held by characters alone against the
sum of all languages; rows that repeat count as often as they occur; an empty
table gives an empty result; other columns are passed by or left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.llm.common import WHITE, fixed, let, words

# The languages with a reference, and frequent function words of each.
COMMON = {
    "de": ["der", "die", "und", "das", "ist", "nicht", "ein", "zu", "von", "den"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "as"],
    "es": ["el", "la", "de", "que", "y", "en", "los", "un", "del", "se"],
    "fr": ["le", "la", "de", "et", "les", "des", "que", "un", "en", "du"],
}
# What a text is stripped of to leave one character class.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "symbol": "[^#*$%&|<>]+", "point": "[^.,;:!?'\"()-]+"}
SYMBOLS = "symbol"

MIN_WORDS = 50  # base rule
MIN_CHARS_FOR_CLASSES = 200  # guards of the two distances
MIN_WORDS_FOR_COMMON = 100
MAX_CLASS_DISTANCE = 0.35
MAX_COMMON_DISTANCE = 0.6


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def char_counts(text: Column) -> Column:
    """White space, the classes in their order, bytes beyond ASCII, and all the
    rest (nearly all of it lower-case letters)."""
    known = F.array(
        (F.octet_length(text) - F.octet_length(without(text, WHITE))).cast("long"),
        *[F.length(F.regexp_replace(text, p, "")).cast("long") for p in CLASSES.values()],
        (F.octet_length(text) - F.length(text)).cast("long"),
    )
    return let(known, lambda k: F.concat(k, F.array(F.greatest(F.length(text).cast("long") - _sum(k), F.lit(0).cast("long")))))


def common_counts(text: Column, lang: Column) -> Column:
    """Counts of the language's common words, bare of punctuation, in their
    order, then of all other pieces between spaces and line ends. Every piece
    gets a space on either side of its own, so that taking one occurrence away
    never takes the space of the next. Null for other languages."""
    plain = F.replace(text, F.lit("\n"), F.lit(" "))
    spaced = F.concat(F.lit(" "), F.replace(plain, F.lit(" "), F.lit("  ")), F.lit(" "))

    def counted(s: Column, vocabulary: list[str]) -> Column:
        found = F.array(*[F.floor((F.octet_length(s) - F.octet_length(F.replace(s, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long") for w in vocabulary])
        pieces = (F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" "), F.lit("")))) / 2
        return let(found, lambda k: F.concat(k, F.array(pieces.cast("long") - _sum(k))))

    def chosen(s: Column) -> Column:
        out = F.lit(None).cast("array<bigint>")
        for code, vocabulary in COMMON.items():
            out = F.when(lang == code, counted(s, vocabulary)).otherwise(out)
        return out

    return F.when(lang.isin(*COMMON), let(spaced, chosen))


def few_places(h: Column, twice: Column) -> Column:
    """Places in h of the values in twice, a short array."""
    return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())


def many_places(h: Column) -> Column:
    """Places in h of values that occur twice or more, by sorting."""

    def at(s: Column, j: Column) -> Column:
        own = F.get(s, j)
        return F.when((own["h"] == F.get(s, j - 1)["h"]) | (own["h"] == F.get(s, j + 1)["h"]), own["i"])

    placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return let(placed, lambda s: F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: at(s, j)), lambda i: i.isNotNull()))


def with_repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words to rows with the array _words: words inside three-word
    windows that occur twice or more. Windows are sorted by hash and equal
    neighbours repeat. (A 64-bit hash stands for a window; within one text that
    is exact but for a chance of about n**2 / 2**65.)"""
    n = F.size("_words")
    w = F.col("_words")
    df = fixed(df, "_h", F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>")))
    df = fixed(df, "_sorted", F.sort_array("_h"))
    df = fixed(df, "_twice", F.filter("_sorted", lambda x, i: (x == F.get(F.col("_sorted"), i + 1)) & (F.coalesce(x != F.get(F.col("_sorted"), i - 1), F.lit(True)))))
    n_twice = F.size("_twice")
    df = fixed(df, "_places", F.when(n_twice == 0, F.array().cast("array<int>")).when(n_twice <= 64, few_places(F.col("_h"), F.col("_twice"))).otherwise(many_places(F.col("_h"))))
    return df.withColumn("n_repeat_words", F.size(F.array_distinct(F.flatten(F.transform("_places", lambda i: F.array(i, i + 1, i + 2))))).cast("long"))


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; null if either is empty."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def one(x: Column) -> Column:
        m = (x["p"] + x["q"]) / 2
        return (part(x["p"], m) + part(x["q"], m)) / 2

    def of(sums: Column) -> Column:
        shares = F.zip_with(p, q, lambda x, y: F.struct((x / sums["p"]).alias("p"), (y / sums["q"]).alias("q")))
        return F.sqrt(F.greatest(F.aggregate(F.transform(shares, one), F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))

    return let(F.struct(_sum(p).alias("p"), _sum(q).alias("q")), lambda sums: F.when((sums["p"] > 0) & (sums["q"] > 0), of(sums)))


def references(docs: DataFrame) -> DataFrame:
    """One row per language with a word list, and one for all languages (lang ''):
    at most len(COMMON) + 1 rows. Partial sums, a few per task, are shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n_chars, n_common = len(CLASSES) + 3, max(map(len, COMMON.values())) + 1
    one = docs.select(
        F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise(F.lit("")).alias("code"),
        char_counts(text).alias("c"),
        common_counts(text, F.col("lang")).alias("w"),
    )
    sums = one.groupBy("code").agg(
        *[F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(n_chars)],
        *[F.sum(F.coalesce(F.get("w", F.lit(i)), F.lit(0))).alias(f"w{i}") for i in range(n_common)],
    )
    narrow = sums.select("code", F.array(*[f"c{i}" for i in range(n_chars)]).alias("c"), F.array(*[f"w{i}" for i in range(n_common)]).alias("ref_common"))
    pooled = narrow.groupBy().agg(F.array(*[F.sum(F.get("c", F.lit(i))) for i in range(n_chars)]).alias("ref_chars"))
    own = narrow.where("code <> ''").select("code", F.col("c").alias("ref_chars"), "ref_common")
    return own.unionByName(pooled.select(F.lit("").alias("code"), "ref_chars", F.lit(None).cast("array<bigint>").alias("ref_common")))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep, the counts, the two distances and the verdicts.
    Two passes over the text, no shuffle of it: the references, five rows at
    most whatever the input, are broadcast."""
    docs = docs.select(*keep, *[c for c in ("text", "lang") if c not in keep])
    text = F.coalesce(F.col("text"), F.lit(""))
    refs = references(docs.select("text", "lang")).select("code", F.struct("ref_chars", "ref_common").alias("_ref"))
    code = F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise(F.lit(""))
    out = docs.withColumn("_code", code).join(F.broadcast(refs), F.col("_code") == F.col("code"), "left")
    out = fixed(out, "_chars", char_counts(text))
    out = fixed(out, "_common", common_counts(text, F.col("lang")))
    out = fixed(out, "_words", words(F.col("text")))
    out = with_repeat_words(out).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(text) - F.get("_chars", F.lit(0)),
        "n_symbols": F.get("_chars", F.lit(1 + list(CLASSES).index(SYMBOLS))),
        "n_dup_lines": dup_lines(text),
        "class_distance": distance(F.col("_chars"), F.col("_ref.ref_chars")),
        "common_distance": distance(F.col("_common"), F.col("_ref.ref_common")),
    })
    out = fixed(out, "_far", F.struct("class_distance", "common_distance"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.length(text) >= MIN_CHARS_FOR_CLASSES) & (F.coalesce(F.col("class_distance"), F.lit(0.0)) > MAX_CLASS_DISTANCE)) | (
        (F.col("n_words") >= MIN_WORDS_FOR_COMMON) & (F.coalesce(F.col("common_distance"), F.lit(0.0)) > MAX_COMMON_DISTANCE)
    )
    return out.select(
        *keep, *[c for c in ("text", "lang") if c not in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_far.class_distance", "_far.common_distance",
    ).withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & ~far)


def quality(docs: DataFrame) -> DataFrame:
    """Per document the counts, the distances and the verdicts."""
    return measured(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("common_distance", 6).alias("common_distance"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    cols = docs.columns
    rest = [c for c in cols if c not in ("doc_id", "text", "lang")]
    packed = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("_rest"))
    passed = measured(packed, ["doc_id", "text", "lang", "_rest"]).where("kept")
    return passed.select(*[F.col(f"_rest.`{c}`").alias(c) if c in rest else F.col(c) for c in cols])


def _sql() -> str:
    words_of = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    arrays = []
    for code, vocabulary in COMMON.items():
        counted = ", ".join(f"((strlen(s) - strlen(replace(s, ' {w} ', ''))) // {len(w) + 2})" for w in vocabulary)
        arrays.append(f"when lang = '{code}' then [{counted}]")
    classes = ", ".join(f"length(regexp_replace(t, '{p.replace(chr(39), chr(39) * 2)}', '', 'g'))" for p in CLASSES.values())
    index = list(CLASSES).index(SYMBOLS) + 2
    js = """case when list_sum({p}) > 0 and list_sum({q}) > 0 then sqrt(greatest(list_sum(list_transform(list_zip(list_transform({p}, lambda v: v / list_sum({p})), list_transform({q}, lambda v: v / list_sum({q}))),
      lambda z: ((case when z[1] > 0 then z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) else 0 end) + (case when z[2] > 0 then z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) else 0 end)) / 2)), 0)) end"""
    n_classes, n_common = len(CLASSES) + 3, max(map(len, COMMON.values())) + 1
    return f"""
with d as (select doc_id, lang, coalesce(text, '') t, {words_of} w, ' ' || replace(replace(coalesce(text, ''), chr(10), ' '), ' ', '  ') || ' ' s from documents),
f as (select doc_id, lang, t, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars, [length(t) - coalesce(list_sum(list_transform(w, lambda x: length(x))), 0), {classes}, strlen(t) - length(t)] k, case {' '.join(arrays)} end v,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) n_dup_lines, w, (strlen(s) - strlen(replace(s, ' ', ''))) // 2 n_pieces from d),
g as (select *, list_append(k, greatest(length(t) - list_sum(k), 0)) c, list_append(v, n_pieces - list_sum(v)) cw from f),
r as (select lang, [{', '.join(f'sum(c[{i + 1}])' for i in range(n_classes))}] rc, [{', '.join(f'sum(coalesce(cw[{i + 1}], 0))' for i in range(n_common))}] rw from g where lang in ({', '.join(map(repr, COMMON))}) group by lang),
p as (select [{', '.join(f'sum(c[{i + 1}])' for i in range(n_classes))}] rc from g),
n as (select doc_id, unnest(range(1, len(w) - 1)) i, w from f where len(w) >= 4),
n3 as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] x from n),
n2 as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, x) c from n3) where c > 1),
cov as (select doc_id, count(distinct j) n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) j from n2) group by doc_id),
m as (select g.doc_id, n_words, word_chars, k[{index}]::bigint n_symbols, n_dup_lines::bigint n_dup_lines, coalesce(n_repeat_words, 0)::bigint n_repeat_words, length(t) len,
  {js.format(p='c', q='coalesce(r.rc, p.rc)')} class_distance, {js.format(p='cw', q='r.rw')} common_distance
  from g cross join p left join r on g.lang = r.lang left join cov on cov.doc_id = g.doc_id),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (len >= {MIN_CHARS_FOR_CLASSES} and coalesce(class_distance, 0) > {MAX_CLASS_DISTANCE}) and not (n_words >= {MIN_WORDS_FOR_COMMON} and coalesce(common_distance, 0) > {MAX_COMMON_DISTANCE}) kept,
  round(class_distance, 6) class_distance, round(common_distance, 6) common_distance from b"""


SQL = _sql()
