"""Chat formatting with Spark expressions only.

Turns are collected per conversation as structs, sorted, and neighbours of one role
merged into a block:

    <|im_start|>ROLE
    TEXT<|im_sep|>TEXT<|im_end|>

Texts are escaped reversibly: every run of bars after a ``<`` gets one bar more, so
no text can hold a control string (they have a single bar); a role's line end
and backslash are written ``\\n`` and ``\\\\`` besides.  The output is a list of segments
(text, loss): their texts joined are the formatted conversation, those with loss
are the assistant's texts, escaped, and nothing else.

Cases: null text or role is the empty string; turns are ordered by (turn, role,
text), null turns first; repeated rows are turns of their own; rows without a
conv_id form one conversation; an empty text is an empty segment; an empty table gives
an empty result; extra columns are ignored.  A formatted conversation is one
string, so it is bounded by what a string may hold (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
_SEGMENTS = "array<struct<text:string,loss:boolean>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "<(\\|+)", "<|$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "<\\|(\\|+)", "<$1")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # a backslash pair is put aside while the line ends come back
    parts = F.transform(F.split(role, "\\\\\\\\", -1),
                        lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(parts, "\\"))


def _segment(text: Column, loss: Column | None = None) -> Column:
    return F.struct(text.alias("text"), (F.lit(False) if loss is None else loss).alias("loss"))


def merged(conversations: DataFrame) -> DataFrame:
    """(conv_id, blocks): array of (role, texts), neighbours of one role merged, in turn order."""
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    at = F.sequence(F.lit(1), F.size("turns"))
    role = lambda i: F.element_at("turns", i)["role"]
    starts = turns.select("conv_id", "turns", F.filter(
        at, lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1))))).alias("starts"))
    ends = F.concat(F.transform(F.slice("starts", F.lit(2), F.size("starts")), lambda s: s - 1),
                    F.array(F.size("turns")))
    return starts.select("conv_id", F.zip_with("starts", ends, lambda s, e: F.struct(
        role(s).alias("role"),
        F.transform(F.slice("turns", s, e - s + 1), lambda t: t["text"]).alias("texts"))).alias("blocks"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments) per conversation."""
    def block(b):
        loss = b["role"] == LOSS_ROLE
        head = F.concat(F.lit(START), _escape_role(b["role"]), F.lit("\n"))
        texts = F.transform(b["texts"], lambda t, i: F.array(
            _segment(F.when(i == 0, head).otherwise(F.lit(SEP))), _segment(escape(t), loss)))
        return F.concat(F.flatten(texts), F.array(_segment(F.lit(STOP))))

    segments = F.flatten(F.transform("blocks", block)).cast(_SEGMENTS)
    out = merged(conversations).select("conv_id", segments.alias("segments"))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "")
                      .alias("formatted"), "segments")


def parse_chats(formatted: Column) -> Column:
    """Array of (role, text): the turns that a formatted conversation was made of."""
    pattern = F.lit("(?s)<\\|im_start\\|>([^\n]*)\n(.*?)<\\|im_end\\|>\n")
    roles = F.regexp_extract_all(formatted, pattern, F.lit(1))
    bodies = F.regexp_extract_all(formatted, pattern, F.lit(2))
    return F.flatten(F.zip_with(roles, bodies, lambda r, b: F.transform(
        F.split(b, "<\\|im_sep\\|>", -1),
        lambda t: F.struct(_unescape_role(r).alias("role"), unescape(t).alias("text")))))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back."""
    read = formatted.select("conv_id", parse_chats(F.col("formatted")).alias("turns"),
                            loss_text(F.col("segments")).alias("loss"),
                            F.char_length("formatted").cast("long").alias("formatted_chars"))
    every = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
