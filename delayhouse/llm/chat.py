"""Chat formatting, proven by reading the result back.

A turn is rendered as  start role separator text end.  The parser cuts at end marks, wants a start mark, exactly
one separator and no other control string in a turn, and then takes one backslash out of every guarded control string. A turn
whose reading differs from its source is rendered again with its text, then also its role, escaped: one backslash
goes behind the first character of every control string, also of one that already has backslashes there, which makes the escape
a bijection. The first rendering that reads back identically is used; the finished conversation is parsed once more as a
whole and the job fails if any turn differs.

Defined cases: turns are ordered by turn (null first), role, text; a null role or text is empty; rows with a null
conversation form one conversation; repeated rows are repeated turns; an empty table gives an empty result; other columns are
ignored. A conversation becomes one string, so it must fit into one row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that no text may contain unescaped: the template's own marks and those of other common templates.
CONTROL = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
TRAINED_ROLE = "assistant"


def _guarded(control: Sequence[str], backslashes: str) -> str:
    """A pattern of three groups: first character, backslashes, rest of a control string."""
    heads = "".join(sorted({re.escape(c[0]) for c in control}))
    tails = "|".join(re.escape(c[1:]) for c in control)
    return f"([{heads}])({backslashes})({tails})"


_ANY = _guarded(CONTROL, r"\\*")
_PLAIN = _guarded(CONTROL, "")
_ESCAPED = _guarded(CONTROL, r"\\+")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ANY), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    one_less = _ESCAPED.replace(r"(\\+)", r"\\(\\*)")
    return F.regexp_replace(text, F.lit(one_less), F.lit("$1$2$3"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(SEPARATOR), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Turns as array<struct<role, text>>; a null element for what is no turn."""

    def turn(part: Column) -> Column:
        fields = F.split(F.substr(part, F.lit(len(START) + 1)), re.escape(SEPARATOR), -1)
        clean = F.forall(fields, lambda f: ~F.rlike(f, F.lit(_PLAIN)))
        read = F.struct(unescape(fields[0]).alias("role"), unescape(F.get(fields, F.lit(1))).alias("text"))
        return F.when(F.startswith(part, F.lit(START)) & (F.size(fields) == 2) & clean, read)

    parts = F.split(formatted, re.escape(END), -1)
    turns = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)
    rest = F.element_at(parts, -1)
    return F.when(rest == "", turns).otherwise(F.concat(turns, F.array(F.lit(None).cast("struct<role:string,text:string>"))))


def rendered(role: Column, text: Column) -> Column:
    """The first rendering of a turn that reads back as the turn."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    tries = (render(role, text), render(role, escape(text)), render(escape(role), escape(text)))
    chosen = F.raise_error(F.lit("a turn does not read back")).cast("string")
    for attempt in reversed(tries):
        chosen = F.when(parse(attempt).eqNullSafe(source), attempt).otherwise(chosen)
    return chosen


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, turns (read back), loss_spans (start, length; code points).

    The loss spans cover the rendered texts of the trained role in ``formatted``.
    """
    order = ("turn", "role", "text")
    turns = conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # Shuffled once, as they are; everything behind works on sorted rows of a conversation.
    place = W.partitionBy("conv_id").orderBy(*order)
    turns = turns.withColumn("place", F.row_number().over(place)).withColumn("piece", rendered(F.col("role"), F.col("text")))
    ends = F.sum(F.length("piece")).over(W.partitionBy("conv_id").orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    body = F.length("piece") - F.length(F.substring_index("piece", SEPARATOR, 1)) - len(SEPARATOR) - len(END)
    span = F.struct((F.col("end") - len(END) - F.col("body")).alias("start"), F.col("body").alias("length"))
    rows = F.array_sort(F.collect_list(F.struct("place", "role", "text", "piece", "span")))
    grouped = (
        turns.withColumns({"end": ends, "body": body})
        .withColumn("span", F.when(F.col("role") == TRAINED_ROLE, span))
        .groupBy("conv_id").agg(rows.alias("rows"))
        .select(
            "conv_id", F.size("rows").cast("long").alias("n_turns"),
            F.array_join(F.col("rows.piece"), "").alias("formatted"),
            F.arrays_zip(F.col("rows.role").alias("role"), F.col("rows.text").alias("text")).alias("source"),
            F.filter(F.col("rows.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        )
        .withColumn("turns", parse(F.col("formatted")))
    )
    proven = F.when(F.col("turns").eqNullSafe(F.col("source")), F.col("turns")).otherwise(
        F.raise_error(F.lit("a conversation does not read back")).cast("array<struct<role:string,text:string>>")
    )
    return grouped.withColumn("turns", proven).drop("source")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them: turns by the parser, trained texts by cutting at the loss mask."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    cut = lambda s: F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(cut(s))), "")
    return formatted.select(
        "conv_id", "n_turns", F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The conversation that the contract adds.
ADDED = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of the added one."""
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(given.unionByName(added)))


_SQL_ANY = _ANY.replace("'", "''")
ORACLE = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), ''))
    as loss_sha256,
  sum({len(START) + len(SEPARATOR) + len(END)} + length(regexp_replace(role, '{_SQL_ANY}', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '{_SQL_ANY}', '\1\\\2\3', 'g')))::bigint as formatted_chars
from turns group by conv_id
"""
