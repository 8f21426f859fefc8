"""Chat formatting with prefix-target expansion, in DataFrame functions alone.

A conversation becomes one text of marked turns. Every assistant turn is an
example of its own: its context is all of the text before that turn's reply,
and only the reply is trainable. All examples of a conversation are prefixes of
the same text, so an example is stored as offsets into it (context_end, loss
span) and not as a copy: the output grows with the input, not with the square
of a conversation's length. materialized() cuts the copies for who wants them;
read_back() reads every example's context and reply, one after another.

Template, per turn: "### role: text</turn>" and a line end. Inside roles and
texts a backslash is doubled, "</turn>" is written "\\/turn>" and "###" is
written "\\#h", and in roles ": " is written "\\c"; no marker can occur in a
text, and unescaping gives back every text.

Defined cases: a null text or role is empty; turns are ordered by turn, role
and text (null turns first, repeated rows kept); a row of a null conv_id belongs
to no known conversation and is one of its own; a conversation without assistant
turns has no example, and loss_chars 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.llm.common import fixed, let

START, MIDDLE, END = "### ", ": ", "</turn>\n"
TRICKY = "\\### Assistant: </turn> ok"  # a text made of the template's own markers


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("\\/turn>"))
    return F.replace(text, F.lit("###"), F.lit("\\#h"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(MIDDLE), F.lit("\\c"))


def unescaped(text: Column) -> Column:
    """Doubled backslashes are cut out first, so what is left of a backslash begins an escape."""

    def piece(x: Column) -> Column:
        x = F.replace(x, F.lit("\\c"), F.lit(MIDDLE))
        x = F.replace(x, F.lit("\\#h"), F.lit("###"))
        return F.replace(x, F.lit("\\/turn>"), F.lit("</turn>"))

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order. part is null, but of a row without conv_id its number."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    part = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("part")
    return turns.select("conv_id", part, row.alias("row")).groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("row")).alias("turns"))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, part, formatted, and examples: array of turn, context_end, loss_start
    and loss_end, in characters (code points), end exclusive."""
    parts = F.transform(
        "turns",
        lambda t: F.struct((t["role"] == "assistant").alias("train"), F.concat(F.lit(START), escaped_role(t["role"]), F.lit(MIDDLE)).alias("head"), escaped(t["text"]).alias("body")),
    )
    df = fixed(conversations(turns), "parts", parts)
    sizes = F.transform("parts", lambda p: F.struct(p["train"].alias("train"), F.length(p["head"]).cast("long").alias("head"), F.length(p["body"]).cast("long").alias("body")))
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<turn:bigint,context_end:bigint,loss_start:bigint,loss_end:bigint>>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        begin = a["at"] + s["head"]
        example = F.array(F.struct(a["n"].alias("turn"), begin.alias("context_end"), begin.alias("loss_start"), (begin + s["body"]).alias("loss_end")))
        return F.struct((begin + s["body"] + len(END)).alias("at"), (a["n"] + 1).alias("n"), F.when(s["train"], F.concat(a["out"], example)).otherwise(a["out"]).alias("out"))

    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return df.select("conv_id", "part", text.alias("formatted"), F.aggregate(sizes, first, step, lambda a: a["out"]).alias("examples"))


def examples(output: DataFrame) -> DataFrame:
    """Prefix-target expansion: one row per assistant turn, as offsets into the
    conversation's formatted text."""
    return output.select("conv_id", F.inline("examples"))


def materialized(output: DataFrame) -> DataFrame:
    """The examples as texts: context and target, with the template's escapes."""
    each = output.select("conv_id", "formatted", F.explode("examples").alias("e"))
    cut = lambda a, b: F.substring("formatted", (a + 1).cast("int"), (b - a).cast("int"))
    return each.select("conv_id", "e.turn", cut(F.lit(0), F.col("e.context_end")).alias("context"), cut(F.col("e.loss_start"), F.col("e.loss_end")).alias("target"))


def read_back(output: DataFrame) -> DataFrame:
    """Digests of what the formatted texts say, and of the contexts and replies of
    their examples: each is exploded, its context is read back turn by turn, and the
    groups of a conversation lie where its text does, so nothing is shuffled again."""
    head = lambda s: F.substring_index(s, MIDDLE, 1)
    turn = lambda s: F.concat(unescaped(F.substr(head(s), F.lit(len(START) + 1))), F.lit("\n"), unescaped(F.substr(s, F.length(head(s)) + len(MIDDLE) + 1)), F.lit("\n"))
    complete = lambda text: let(F.split(text, END), lambda a: F.slice(a, 1, F.size(a) - 1))
    said = lambda pieces: F.array_join(F.transform(pieces, turn), "")
    df = fixed(output, "_pieces", complete(F.col("formatted")))
    df = df.select(
        "conv_id", "part", F.size("_pieces").cast("long").alias("n_turns"), F.sha2(said("_pieces"), 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "formatted", "examples",
    )
    whole = ("n_turns", "turns_sha256", "formatted_chars")
    each = df.select("conv_id", "part", *whole, "formatted", F.explode_outer("examples").alias("e"))
    cut = lambda a, b: F.substr(F.col("formatted"), (a + 1).cast("int"), (b - a).cast("int"))
    each = fixed(each, "_context", complete(cut(F.lit(0), F.col("e.context_end"))))
    one = F.struct(F.col("e.turn").alias("turn"), unescaped(cut(F.col("e.loss_start"), F.col("e.loss_end"))).alias("target"), F.sha2(said("_context"), 256).alias("context"), F.size("_context").cast("long").alias("before"))
    each = each.select("conv_id", "part", *whole, F.when(F.col("e").isNotNull(), one).alias("one"))
    got = each.groupBy("conv_id", "part").agg(*[F.first(c).alias(c) for c in whole], F.sort_array(F.collect_list("one")).alias("_each"))
    got = fixed(got, "_loss", F.array_join(F.col("_each.target"), ""))
    return got.select(
        "conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars",
        F.size("_each").cast("long").alias("n_examples"), F.aggregate("_each.before", F.lit(0).cast("long"), lambda a, x: a + x).alias("context_turns"),
        F.sha2(F.array_join("_each.context", ""), 256).alias("contexts_sha256"),
    )


def with_tricky(turns: DataFrame) -> DataFrame:
    """The turns, and conversation -7 whose texts are made of markers."""
    extra = turns.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


_esc = "replace(replace(replace({}, chr(92), chr(92) || chr(92)), '</turn>', chr(92) || '/turn>'), '###', chr(92) || '#h')"
SQL = f"""
with t as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') t from conversations
  union all select -7, 0, 'user', chr(92) || '### Assistant: </turn> ok' union all select -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'),
k as (select *, case when conv_id is null then row_number() over () end part from t),
c as (select *, row_number() over w - 1 before, sha256(coalesce(string_agg(role || chr(10) || t || chr(10), '') over (w rows between unbounded preceding and 1 preceding), '')) context
  from k window w as (partition by conv_id, part order by turn nulls first, role, t))
select conv_id, count(*)::bigint n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' order by before)) turns_sha256,
  coalesce(sum(length(t)) filter (role = 'assistant'), 0)::bigint loss_chars, sha256(coalesce(string_agg(t, '' order by before) filter (role = 'assistant'), '')) loss_sha256,
  sum({len(START) + len(MIDDLE) + len(END)} + length(replace({_esc.format('role')}, ': ', chr(92) || 'c')) + length({_esc.format('t')}))::bigint formatted_chars,
  count(*) filter (role = 'assistant')::bigint n_examples, coalesce(sum(before) filter (role = 'assistant'), 0)::bigint context_turns,
  sha256(coalesce(string_agg(context, '' order by before) filter (role = 'assistant'), '')) contexts_sha256
from c group by conv_id, part"""
