"""Chat formatting with a grammar round trip.

A conversation is rendered as one string::

    user         [INST] text [/INST]
    assistant    text</s>
    other role   [ROLE] role [TEXT] text [/ROLE]

A text that holds a control string would read back as something else. Every rendered conversation is
therefore parsed again and compared with its source; where they differ, the control strings inside
its texts get a backslash after their first character (and one more if they have some), which the
parser takes off again, and the result is parsed and compared once more. A conversation that still
differed would be refused; none does, as the escape can be undone for any text.

Defined cases: a null text or role counts as empty; turns are ordered by turn, then role and text,
nulls first, so ties have one order; repeated rows are turns of their own; a null conv_id is one
conversation; an empty table gives none. Code points in the mask are those of assistant texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTROL = r"([\[<])(\\*)(INST\]|/INST\]|ROLE\]|TEXT\]|/ROLE\]|/s>)"
_ESCAPED = r"([\[<])\\(\\*)(INST\]|/INST\]|ROLE\]|TEXT\]|/ROLE\]|/s>)"
#: One turn; the text of each runs to its own closing string.
_TURN = (
    r"(?s)\[INST\] (?:.*?) \[/INST\]|\[ROLE\] (?:.*?) \[TEXT\] (?:.*?) \[/ROLE\]"
    r"|(?!\[INST\] |\[ROLE\] )(?:.*?)</s>"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _rendered(turn: Column) -> Column:
    return (
        F.when(turn.role == "user", F.concat(F.lit("[INST] "), turn.text, F.lit(" [/INST]")))
        .when(turn.role == "assistant", F.concat(turn.text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("[ROLE] "), turn.role, F.lit(" [TEXT] "), turn.text, F.lit(" [/ROLE]")))
    )


def render(turns: Column, escaped: bool) -> Column:
    def one(turn: Column) -> Column:
        if escaped:
            turn = F.struct(escape(turn.role).alias("role"), escape(turn.text).alias("text"))
        return _rendered(turn)

    return F.array_join(F.transform(turns, one), "")


def _cut(text: Column, head: int, tail: int) -> Column:
    return F.substring(text, F.lit(head + 1), F.char_length(text) - head - tail)


def segments(formatted: Column) -> Column:
    """The string's turns as written: role, text and the strings before and after it."""

    def part(turn: Column) -> Column:
        inner = _cut(turn, 7, 8)
        role = F.substring_index(inner, " [TEXT] ", 1)
        return (
            F.when(turn.startswith("[INST] "), F.struct(
                F.lit("user").alias("role"), F.lit("[INST] ").alias("head"),
                _cut(turn, 7, 8).alias("text"), F.lit(" [/INST]").alias("tail")))
            .when(turn.startswith("[ROLE] "), F.struct(
                role.alias("role"), F.concat(F.lit("[ROLE] "), role, F.lit(" [TEXT] ")).alias("head"),
                F.substring(inner, F.char_length(role) + 9, F.char_length(inner)).alias("text"),
                F.lit(" [/ROLE]").alias("tail")))
            .otherwise(F.struct(
                F.lit("assistant").alias("role"), F.lit("").alias("head"),
                _cut(turn, 0, 4).alias("text"), F.lit("</s>").alias("tail")))
        )

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), part)


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered string."""
    return F.transform(
        segments(formatted),
        lambda s: F.struct(unescape(s.role).alias("role"), unescape(s.text).alias("text")),
    )


def conversations(rows: DataFrame) -> DataFrame:
    """One row a conversation: conv_id and its ordered turns (role, text)."""
    given = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(given)).alias("given")).select(
        "conv_id", F.transform("given", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns")
    )


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, escaped, and ``segments`` (role, head, text, tail) read back from it.

    The heads, texts and tails of the segments make up ``formatted``; the loss mask is the
    texts whose role is assistant.
    """
    same = "transform(turns, t -> struct(t.role as role, t.text as text))"
    plain = conversations(rows).withColumn("formatted", render(F.col("turns"), False))
    judged = plain.withColumn("escaped", parse(F.col("formatted")) != F.expr(same))
    mended = judged.withColumn(
        "formatted", F.when(F.col("escaped"), render(F.col("turns"), True)).otherwise(F.col("formatted"))
    )
    wrong = F.col("escaped") & (parse(F.col("formatted")) != F.expr(same))
    checked = F.when(wrong, F.raise_error(F.lit("a conversation does not read back"))).otherwise(F.col("formatted"))
    return mended.select("conv_id", checked.alias("formatted"), "escaped").withColumn(
        "segments", segments(F.col("formatted"))
    )
