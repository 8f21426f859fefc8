"""Text predicates and cleaners, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \b is Unicode-aware; word borders here are those of ASCII word characters.
BORDER = "(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def quoted(name: Column) -> Column:
    """A name as a literal pattern."""
    return F.regexp_replace(name, r"([\\.\[\]{}()*+?^$|])", r"\\$1")


def whole_word(text: Column, name: Column, case_sensitive: bool = False) -> Column:
    flags = "" if case_sensitive else "(?iu)"
    return F.rlike(text, F.concat(F.lit(flags + BORDER), quoted(name), F.lit(BORDER)))


def substring(text: Column, name: Column) -> Column:
    return F.rlike(text, F.concat(F.lit("(?iu)"), quoted(name)))


def phrase(text: Column, name: Column) -> Column:
    """Containment that looks past case and accents."""
    return F.contains(F.collate(text, "UNICODE_CI_AI"), F.collate(name, "UNICODE_CI_AI"))


def without_parentheses(s: Column) -> Column:
    return F.btrim(F.regexp_replace(s, "[(].*?[)]", ""))


def name_words(name: Column, drop_prefix: str | None) -> Column:
    """Lower-case words of a name, without those that begin with drop_prefix, bare of | ( )."""
    w = F.split(F.lower(without_parentheses(name)), " ")
    if drop_prefix:
        w = F.filter(w, lambda x: ~x.startswith(drop_prefix))
    return F.transform(w, lambda x: F.translate(x, "|()", ""))


def variants(w: Column) -> Column:
    """The full name and, of names of at most three words, the first three and the first two written together."""
    return F.when(F.size(w) <= 3, F.array(F.btrim(F.array_join(w, " ")), F.array_join(F.slice(w, 1, 3), ""), F.array_join(F.slice(w, 1, 2), ""))).otherwise(F.array(F.btrim(F.array_join(w, " "))))


def name_variants(name: Column) -> Column:
    return variants(name_words(name, "refin"))


def owner_variants(name: Column) -> Column:
    return variants(name_words(name, None))


def _spellings(s: Column) -> Column:
    """A spaced name, and names of at most three words written together; case stays."""
    w = F.transform(F.split(s, " "), lambda x: F.translate(F.btrim(x), "|(),", ""))
    return F.when(F.size(w) <= 3, F.array(s, F.array_join(F.slice(w, 1, 3), ""), F.array_join(F.slice(w, 1, 2), ""))).otherwise(F.array(s))


def city_variants(city: Column) -> Column:
    """Spellings of a city: with spaces for hyphens, of its parts between commas, and of the name itself."""
    none = F.array().cast("array<string>")
    plain = F.btrim(F.regexp_replace(F.replace(city, F.lit("-"), F.lit(" ")), " +", " "))
    parts = F.flatten(F.transform(F.split(city, ","), lambda p: _spellings(F.btrim(p))))
    return F.array_distinct(F.concat(F.when(F.contains(city, F.lit("-")), _spellings(plain)).otherwise(none), F.when(F.contains(city, F.lit(",")), parts).otherwise(none), _spellings(city)))


def cleaned(text: Column) -> Column:
    """A post's text for entity extraction: no #, no links, no punctuation."""
    kept = F.filter(F.split(F.replace(text, F.lit("#"), F.lit("")), " "), lambda x: ~F.contains(x, F.lit("http")))
    return F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, r"[^\p{L}\p{N}_\s]", "")), " ")


def camel_words(tag: Column) -> Column:
    """A hashtag in camel case, split and in upper case; null for others. A character
    counts as upper if it equals its upper case, digits too."""
    uppers = F.size(F.filter(F.split(tag, ""), lambda c: (c != "") & (c == F.upper(c))))
    camel = (F.substring(tag, 1, 1) == F.upper(F.substring(tag, 1, 1))) & (uppers != 1) & (tag != F.upper(tag)) & (F.length(tag) > 0)
    pieces = F.array_join(F.regexp_extract_all(tag, F.lit("([A-Z][^A-Z]*)"), 1), " ")
    # a name like Walnut1 has two characters that equal their upper case, and one piece
    return F.when(camel, F.upper(pieces))


def post_time(s: Column) -> Column:
    """'Wed Aug 27 13:08:45 +0000 2008', or ISO, as a timestamp without zone (an offset is dropped)."""
    raw = F.to_timestamp_ntz(F.concat_ws(" ", F.substring(s, 5, 15), F.substring(s, -4, 4)), F.lit("MMM dd HH:mm:ss yyyy"))
    iso = F.to_timestamp_ntz(F.regexp_replace(s, "Z$", ""))
    return F.when(F.rlike(s, F.lit(" +")), raw).otherwise(iso)


def confidence(n: Column) -> Column:
    """1/n to two places, as a float rounds: of all n only 8 is an exact tie."""
    return F.when(n == 8, 0.12).otherwise(F.round(1 / n, 2))


def share(part: Column, whole: Column) -> Column:
    """part/whole to two places, ties to even."""
    return F.rint(part / whole * 100) / 100
