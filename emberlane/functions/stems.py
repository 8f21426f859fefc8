"""Folding and tokens of texts, as column expressions, and stems and stop words of tokens.

A stemmer is a list of steps; a step is a list of (suffixes, replacement, condition).
The longest suffix of a step that a word ends with decides: if what stands before it
fulfils the condition (a pattern to be found in it), the suffix is replaced, else the
word stays. Steps go one after another. English follows Porter's second algorithm;
German, French and Spanish are light stemmers over words without accents.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlane.session import ship

TOKEN = r"[\p{L}\p{N}_]+"

# letters with accents, and what is left without: one for one
ACCENTED = {c: b[0] for c in map(chr, range(0xC0, 0x2000)) if len(b := [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]) == 1 and b[0] != c}

V, R1, R2 = "[aeiouy]", "[aeiouy][^aeiouy]", "[aeiouy][^aeiouy].*[aeiouy][^aeiouy]"
Step = list[tuple[str, str, str | None]]  # no condition: never
# Suffixes, what takes their place, and what must stand before them.
ENGLISH: list[Step] = [
    [("sses", "ss", ""), ("ied ies", "i", ".."), ("ied ies", "ie", ""), ("us ss", "", None), ("s", "", "[aeiouy].")],
    [("eed eedly", "ee", R1), ("ed edly ing ingly", "+", V)],
    [("at+", "ate", ""), ("bl+", "ble", ""), ("iz+", "ize", "")] + [(f"{c}{c}+", c, "") for c in "bdfgmnprt"],
    [("+", "e", "^[^aeiouy]+[aeiouy][^aeiouywx]$|^[aeiouy][^aeiouy]$"), ("+", "", "")],
    [("y", "i", ".[^aeiouy]$")],
    [("tional", "tion", R1), ("enci", "ence", R1), ("anci", "ance", R1), ("abli", "able", R1), ("entli", "ent", R1), ("izer ization", "ize", R1), ("ational ation ator", "ate", R1)]
    + [("alism aliti alli", "al", R1), ("fulness fulli", "ful", R1), ("ousli ousness", "ous", R1), ("iveness iviti", "ive", R1), ("biliti bli", "ble", R1), ("logi", "log", R1), ("lessli", "less", R1)]
    + [("li", "", "[aeiouy][^aeiouy].*[cdeghkmnrt]$|[aeiouy][cdghkmnrt]$")],
    [("ational", "ate", R1), ("tional", "tion", R1), ("alize", "al", R1), ("icate iciti ical", "ic", R1), ("ful ness", "", R1), ("ative", "", R2)],
    [("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize", "", R2), ("ion", "", "[aeiouy][^aeiouy].*[aeiouy]([^aeiouy].*)?[st]$")],
    [("ll", "l", R2), ("e", "", R2 + "|[aeiouy][^aeiouy].*[aeiouy]$|[aeiouy][^aeiouy]+[^aeiouy]$|[aeiouy][^aeiouy].*([aeiouy][aeiouy][^aeiouy]|[wx])$")],
]
_THREE = "^...+"
GERMAN: list[Step] = [
    [("ern em er en es e", "", _THREE), ("s", "", "...*[bdfghklmnrt]$")],
    [("est en er", "", _THREE), ("st", "", "...[bdfghklmnt]$")],
    [("end ung", "", R2), ("isch", "", R2 + ".*[^e]$"), ("ig ik", "", R2 + ".*[^e]$"), ("lich heit keit", "", R2)],
]
FRENCH: list[Step] = [
    [("eaux", "eau", ".."), ("aux", "al", ".."), ("s x", "", "...")],
    [("issement issements", "iss", R1), ("atrice ateur ation", "", R2), ("logie", "log", R2), ("ence", "ent", R2), ("ance ique isme able iste eux", "", R2), ("ement ment", "", R1), ("ite if ive", "", R2)],
    [("euse", "eux", R1), ("ee er ez", "", "..."), ("e", "", "..")],
]
SPANISH: list[Step] = [
    [("ces", "z", ".."), ("es os as", "", "..."), ("s", "", "...")],
    [("amente mente", "", R1), ("acion adora ador ante ancia", "", R2), ("logia", "log", R2), ("encia", "ente", R2), ("anza ico ica ismo able ible ista oso osa amiento imiento", "", R2), ("idad iva ivo", "", R2)],
    [("ando iendo aron ieron ado ido ada ida", "", "..."), ("a o e", "", "..")],
]
STEMMERS: dict[str, list[Step]] = {"en": ENGLISH, "de": GERMAN, "fr": FRENCH, "es": SPANISH}

# Words that carry no meaning of their own, without accents.
STOP_WORDS: dict[str, list[str]] = {
    "en": "a about above after again all am an and any are as at be because been before being below between both but by can did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its just me more most my no nor not now of off on once only or other our out over own same she so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split(),
    "de": "aber alle als also am an auch auf aus bei bin bis bist da damit dann das dass dein dem den denn der des dich die dies diese dir doch dort du durch ein eine einem einen einer eines er es euer fur hat hatte hier hinter ich ihm ihn ihr im in ist ja jede kein konnen man mein mich mit nach nicht noch nun nur ob oder ohne sehr sein sich sie sind so uber um und uns unter vom von vor war was weil wenn wer wie wir wird zu zum zur".split(),
    "fr": "a ai au aux avec ce ces cette dans de des du elle elles en est et etait ete etre eu il ils j je l la le les leur leurs lui m ma mais me mes moi mon n ne nos notre nous on ont ou par pas plus pour qu que qui s sa sans se ses si son sont sur t ta te tes toi ton tu un une vos votre vous y".split(),
    "es": "a al algo ante antes como con contra cual cuando de del desde donde dos e el ella ellos en entre era es esa ese eso esta este esto fue ha hasta hay la las le les lo los mas me mi mucho muy nada ni no nos o otra otro para pero poco por porque que quien se ser si sin sobre son su sus tambien te tiene todo tu un una uno unos y ya yo".split(),
}


def folded(text: Column) -> Column:
    """Past case and accents."""
    low = F.lower(text)
    bare = F.regexp_replace(F.translate(low, "".join(ACCENTED), "".join(ACCENTED.values())), r"\p{Mn}", "")
    return F.when(F.rlike(text, F.lit(r"[^\x00-\x7F]")), bare).otherwise(low)


def tokens(text: Column) -> Column:
    """Runs of letters, digits and _, folded; none for null."""
    return F.coalesce(F.regexp_extract_all(folded(text), F.lit(f"({TOKEN})"), F.lit(1)), F.array().cast("array<string>"))


def _ordered(step: Step) -> list[tuple[str, list[tuple[str, str]]]]:
    """Suffixes, the longest first, each with its replacements and their conditions."""
    by: dict[str, list[tuple[str, str]]] = {}
    for suffixes, new, condition in step:
        for s in suffixes.split():
            by.setdefault(s, []).extend([] if condition is None else [(new, condition)])
    return sorted(by.items(), key=lambda x: -len(x[0]))


_compiled = {lang: [[(suffix, [(new, re.compile(c).search) for new, c in ways]) for suffix, ways in _ordered(step)] for step in steps] for lang, steps in STEMMERS.items()}
_stops = {lang: frozenset(words) for lang, words in STOP_WORDS.items()}


@lru_cache(1 << 16)
def stem(token: str, lang: str | None) -> str:
    """The stem of a folded token; languages without a stemmer keep the token. Tokens
    of one or two letters stay."""
    if len(token) > 2:
        for step in _compiled.get(lang, ()):
            for suffix, ways in step:
                if token.endswith(suffix):
                    before = token[: -len(suffix)]
                    token = next((before + new for new, fits in ways if fits(before)), token)
                    break
    return token


def with_stems(words: DataFrame, token: str = "term", lang: str = "lang") -> DataFrame:
    """words with the columns stem and stop (whether it is a stop word). For
    dictionaries and queries: texts are never stemmed word by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = list(zip(b.column(token).to_pylist(), b.column(lang).to_pylist()))
            told = [pa.array([stem(*p) for p in pairs], pa.string()), pa.array([p[0] in _stops.get(p[1], ()) for p in pairs], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *told], [*b.schema.names, "stem", "stop"])

    ship(words.sparkSession)
    return words.mapInArrow(run, T.StructType([*words.schema.fields, T.StructField("stem", T.StringType()), T.StructField("stop", T.BooleanType())]))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stem_sql(token: str, lang: str) -> str:
    """stem() for DuckDB."""
    cases = []
    for name, steps in STEMMERS.items():
        w = token
        for step in steps:
            whens = []
            for suffix, ways in _ordered(step):
                before, then = f"x[:len(x) - {len(suffix)}]", "x"
                for new, condition in reversed(ways):
                    then = f"case when regexp_matches({before}, {_quoted(condition)}) then {before} || {_quoted(new)} else {then} end"
                whens.append(f"when ends_with(x, {_quoted(suffix)}) then {then}")
            w = f"list_transform([{w}], lambda x: case {' '.join(whens)} else x end)[1]"
        cases.append(f"when {lang} = {_quoted(name)} and len({token}) > 2 then {w}")
    return f"case {' '.join(cases)} else {token} end"


def stop_sql(token: str, lang: str) -> str:
    return "coalesce(case " + " ".join(f"when {lang} = {_quoted(k)} then {token} in ({', '.join(map(_quoted, v))})" for k, v in STOP_WORDS.items()) + " else false end, false)"
