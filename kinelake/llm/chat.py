"""Chat formatting with typed content parts, in DataFrame functions only.

A turn has an array of parts, each of a type: ``text``, ``image``, ``audio`` or ``document``. The visitor below turns
each part into text: text is escaped, any other part becomes a numbered placeholder, its reference goes to the
attachments and its expanded token count is noted. Turns are marked by control strings; inside texts and roles these
are escaped reversibly, so that ``read_back`` recovers every turn.

Defined results: null text, role or parts are empty; turns are ordered by turn (null first), then role, then content, so
ties and repeated rows give the same result on each run; a null conversation id is a conversation of its own; very long
texts are taken whole; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"

PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def expanded_tokens(part: Column, patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 256) -> Column:
    """Tokens that a part takes once its placeholder is expanded; 1 where its measures are missing, 0 for text."""
    image = F.ceil(part["width"] / F.lit(float(patch))) * F.ceil(part["height"] / F.lit(float(patch)))
    audio = F.ceil(part["seconds"] * F.lit(audio_rate))
    known = (
        F.when(part["type"] == "text", F.lit(0))
        .when(part["type"] == "image", image)
        .when(part["type"] == "audio", audio)
        .when(part["type"] == "document", part["pages"] * F.lit(page_tokens))
    )
    return F.coalesce(known.cast("long"), F.lit(1).cast("long"))


def visited(parts: Column) -> Column:
    """Per part: its text in the output, its type, reference and token count. A part of no known type is an attachment."""

    def visit(part: Column, i: Column) -> Column:
        kind = F.coalesce(part["type"], F.lit("text"))
        held = F.concat(F.lit("<|"), F.regexp_replace(kind, "[^a-z]", ""), F.lit(":"), i.cast("string"), F.lit("|>"))
        return F.struct(
            F.when(kind == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(held).alias("out"),
            kind.alias("type"),
            part["uri"].alias("uri"),
            i.alias("part"),
            F.when(kind == "text", F.lit(0).cast("long")).otherwise(expanded_tokens(part)).alias("tokens"),
        )

    return F.transform(F.coalesce(parts, F.expr(f"cast(array() as array<{PART}>)")), visit)


def text_parts(text: Column) -> Column:
    """One text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")))))


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn: str = "assistant") -> DataFrame:
    """One row per conversation: its formatted text, the spans under the loss mask, attachments and expanded tokens.

    Spans are code points [start, start + length) of the learned role's contents.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        visited(F.col(parts)).alias("seen"),
    )
    rows = rows.withColumn("body", F.array_join(F.transform("seen", lambda x: x["out"]), ""))
    rows = rows.withColumn("head", F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("segment", F.concat("head", "body", F.lit(END + "\n")))
    rows = rows.withColumn("at", F.row_number().over(order)).withColumn("offset", F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0).cast("long")))
    held = F.filter("seen", lambda x: x["type"] != "text")
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "at",
                    "segment",
                    F.when(F.col("role") == learn, F.struct((F.col("offset") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))).alias("learned"),
                    F.transform(held, lambda x: F.struct(F.col("turn").alias("turn"), x["part"].alias("part"), x["type"].alias("type"), x["uri"].alias("uri"), x["tokens"].alias("tokens"))).alias("held"),
                )
            )
        ).alias("t")
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda x: x["learned"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.flatten(F.transform("t", lambda x: x["held"])).alias("attachments"),
        F.aggregate(F.flatten(F.transform("t", lambda x: x["held"])), F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text as (role, text), unescaped."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece))
        return F.struct(unescaped_role(F.substring(role, F.lit(len(START) + 1), F.length(role))).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
