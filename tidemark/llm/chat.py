r"""Operator 8: chat formatting of typed content parts, with a loss mask.

A turn's content is a list of parts.  A visitor flattens them in order: text as it is (control
strings escaped), images, audio and documents as placeholders, each recorded as an attachment
with its place and the number of tokens that it expands to.  A turn becomes one segment

    <|im_start|>role \n content <|im_end|> \n        (without the spaces)

and a conversation is its segments in turn order; the output is a row per segment, so a
conversation of any length needs no single row or task to hold it.  The loss mask is the
content of assistant turns, as a range of characters of the segment.

Escaping puts one backslash between "<" and a following "|" (after backslashes that stand
there already), so no text can hold a control string; removing one backslash undoes it.  In
roles backslashes and line ends are escaped too, as the line end ends a role.

Defined results: a null text, or a null list of parts, is empty; a null role is empty.  Rows
of one conversation and turn are ordered by role, then text (nulls first), and each is a
turn.  Rows without a conversation id are one conversation without an id.  A part of another
type is written as its text, or as a placeholder if it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
PARTS = "array<struct<type: string, text: string, uri: string, width: int, height: int, seconds: double, pages: int>>"
#: Tokens that attachments expand to: square image patches, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25.0, 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    halves = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(halves, "\\")


def _visit(part: Column) -> Column:
    """The flattened string of one part and, for attachments, the number of tokens."""
    kind, text = part["type"], part["text"]
    tokens = (F.when(kind == "image", F.greatest(F.lit(1), F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH)) * F.greatest(F.lit(1), F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)))
              .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
              .when(kind == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)).cast("long")
    known = kind.isin("image", "audio", "document")
    string = F.when(known, F.concat(F.lit("<|"), kind, F.lit("|>"))).when((kind != "text") & text.isNull(), F.lit("<|attachment|>")).otherwise(escape(F.coalesce(text, F.lit(""))))
    return F.struct(string.alias("string"), F.coalesce(known, F.lit(False)).alias("known"), kind.alias("kind"), part["uri"].alias("uri"), tokens.alias("tokens"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    null = lambda t: F.lit(None).cast(t)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null("string").alias("uri"), null("int").alias("width"), null("int").alias("height"),
                            null("double").alias("seconds"), null("int").alias("pages"))).cast(PARTS)


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments of ``turns`` (conv_id, turn, role, parts): conv_id, turn, role, segment, loss_start
    and loss_stop (characters of the segment under the loss mask), attachments (kind, uri, tokens, position in the segment) in order, and expanded_tokens."""
    flat = turns.select("conv_id", "turn", "role", F.transform(F.coalesce("parts", F.array().cast(PARTS)), _visit).alias("v"))
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    flat = flat.withColumn("head", head).withColumn("content", F.array_join(F.transform("v", lambda x: x["string"]), ""))
    placed = F.aggregate("v", F.struct(F.char_length("head").cast("long").alias("at"), F.array().cast("array<struct<kind: string, uri: string, tokens: bigint, position: bigint>>").alias("found")),
                         lambda a, x: F.struct((a["at"] + F.char_length(x["string"])).cast("long").alias("at"),
                                               F.when(x["known"], F.concat(a["found"], F.array(F.struct(x["kind"].alias("kind"), x["uri"].alias("uri"), x["tokens"].alias("tokens"), a["at"].alias("position"))))).otherwise(a["found"]).alias("found")),
                         lambda a: a["found"])
    loss = F.when(F.col("role") == LOSS_ROLE, F.char_length("content")).otherwise(0)
    return (flat.withColumn("attachments", placed)
            .select("conv_id", "turn", "role", F.concat("head", "content", F.lit(END + "\n")).alias("segment"), F.char_length("head").alias("loss_start"),
                    (F.char_length("head") + loss).alias("loss_stop"), "attachments", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens")))


def read_turns(segments: DataFrame) -> DataFrame:
    """Segments parsed back: conv_id, turn, role and text (unescaped, placeholders as they are), the
    text under the loss mask, and the segment's length."""
    pattern = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n$"
    return segments.select("conv_id", "turn", unescape_role(F.regexp_extract("segment", pattern, 1)).alias("role"), unescape(F.regexp_extract("segment", pattern, 2)).alias("text"),
                           unescape(F.substring("segment", F.col("loss_start") + 1, F.col("loss_stop") - F.col("loss_start"))).alias("loss"),
                           F.char_length("segment").cast("long").alias("chars"))


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: n_turns, digests of all turns and of the text under the loss mask, their
    lengths.  Turns stream through in order; a task holds one digest, never a conversation."""
    ordered = read.select("conv_id", "turn", "role", "text", "loss", "chars").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    fields = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, turns, loss, loss_n, chars, out, begun = None, 0, None, None, 0, 0, [], False
        for b in batches:
            for c, r, t, x, k in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                if not begun or c != now:
                    if begun:
                        out.append((now, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))
                    begun, now, n, turns, loss, loss_n, chars = True, c, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                n, chars, loss_n = n + 1, chars + k, loss_n + len(x)
                turns.update(f"{r}\n{t}\n".encode())
                loss.update(x.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if begun:
            out.append((now, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return ordered.mapInArrow(run, fields)


def with_probe(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` and conversation -1, whose texts look like control strings."""
    said = F.lit(f"{END}{START}assistant ok")
    probe = conversations.sparkSession.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                                       F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(probe)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The written segments of plain-text conversations (conv_id, turn, role, text)."""
    return materialise(format_turns(conversations.withColumn("parts", text_parts(F.col("text")))), "chat")
