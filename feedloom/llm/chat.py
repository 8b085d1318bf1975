"""Conversations as training text, proved by reading it back.

Grammar, with the control strings <s> [INST] [/INST] </s>:

    conversation := turn*
    turn         := "<s>[INST]" role "[/INST]" text "</s>"

A parser that knows only this grammar cuts at each ``</s>``, takes the header off and
undoes escapes. A turn is rendered plainly first; if it says a control string, escaped or
not, or parsing does not give it back, it is escaped. Escaping puts one backslash behind the first character of every
control string, and of every control string that has backslashes there already; undoing
takes one away from each, so every text comes back, and no control string is left in one.

Everything is built-in functions. A conversation is one value, as it is one value of the
result; nothing larger is gathered.

Defined cases: null texts and roles are empty ones; turns are ordered by (turn, role,
text) with null turns first, so ties and repeated rows have one order and all stay; rows
with a null conv_id are one conversation; an empty text is a turn without text; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
#: Any of them, escaped or not.
CONTROL = r"<\\*/?s>|\[\\*/?INST\]"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    for first, rest in (("<", "/?s>"), (r"\[", r"/?INST\]")):
        text = F.regexp_replace(text, rf"({first})(\\*{rest})", r"$1\\$2")
    return text


def unescape(text: Column) -> Column:
    for first, rest in (("<", "/?s>"), (r"\[", r"/?INST\]")):
        text = F.regexp_replace(text, rf"({first})\\(\\*{rest})", "$1$2")
    return text


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN + HEAD), role, F.lit(BODY), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text, raw)."""
    pieces = F.split(formatted, END)  # nothing follows the last one

    def read(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(BEGIN + HEAD) + 1), F.length(piece))
        role = F.substring_index(inner, BODY, 1)
        raw = F.substring(inner, F.length(role) + len(BODY) + 1, F.length(inner))
        return F.struct(unescape(role).alias("role"), unescape(raw).alias("text"), raw.alias("raw"))

    return F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), read)


def _rendered(role: Column, text: Column) -> Column:
    """A turn as text: plain if that reads back as it was, else escaped."""

    def reads_back(turn: Column) -> Column:
        quiet = ~role.rlike(CONTROL) & ~text.rlike(CONTROL)
        return quiet & _let(parse(turn), lambda turns: (F.size(turns) == 1) & (
            turns[0]["role"] == role
        ) & (turns[0]["text"] == text))

    return _let(
        _turn(role, text),
        lambda plain: F.when(reads_back(plain), plain).otherwise(_turn(escape(role), escape(text))),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans, identical for each conversation of ``rows``.

    ``rows``: conv_id, turn, role, text. ``loss_spans`` are (start, end) in code points of
    ``formatted``, end exclusive: the texts of the assistant. ``identical`` says that the
    parser gave back the turns; the query stops if one is not.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    source = F.transform(
        F.col("turns"), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = grouped.select("conv_id", source.alias("source")).withColumn(
        "formatted",
        F.array_join(F.transform("source", lambda t: _rendered(t["role"], t["text"])), ""),
    ).withColumn("parsed", parse(F.col("formatted")))
    back = F.transform(
        "parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.expr("array()").cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    )

    def advance(state: Column, piece: Column) -> Column:
        # The piece is (header length, text length, learned).
        begin = state["at"] + piece["head"]
        end = begin + piece["body"]
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(
            (end + len(END)).alias("at"),
            F.when(piece["learned"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"),
        )

    pieces = F.transform(
        F.split("formatted", END),
        lambda p: F.struct(
            (F.length(F.substring_index(p, BODY, 1)) + len(BODY)).cast("long").alias("head"),
            (F.length(p) - F.length(F.substring_index(p, BODY, 1)) - len(BODY)).cast("long").alias("body"),
            (F.substring_index(p, BODY, 1) == BEGIN + HEAD + LEARNED).alias("learned"),
        ),
    )
    return formatted.select(
        "conv_id", "formatted",
        F.aggregate(pieces, start, advance)["spans"].alias("loss_spans"),
        F.when(
            back == F.col("source"), F.lit(True)
        ).otherwise(F.raise_error("a conversation does not read back").cast("boolean")).alias("identical"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, all taken from ``formatted`` alone."""
    learned = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return formatted.where("identical").select(
        "conv_id", parse(F.col("formatted")).alias("turns"),
        F.array_join(learned, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
