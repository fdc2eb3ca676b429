"""Chat formatting by prefix-target expansion.

Every turn becomes one piece of formatted text and every assistant turn closes
a training example: its context is all formatted text before it in the
conversation, and its own text is the only trainable part.
:func:`format_turns` places the turns and the loss spans, :func:`example_texts`
writes every example out, context and target, which is quadratic in a
conversation's length, and :func:`digest` reads all results back from these.

The template is ``<s>role NEWLINE text</s>``, with the text of turns that are
not the assistant's between ``[INST] `` and `` [/INST]``.  Inside roles and
texts a backslash is doubled and every control string gets a backslash after
its first character; :func:`unescape` reverses both exactly.

Turns are ordered by turn, then role and text (nulls first), so repeated turns
have a defined order; null roles and texts count as empty; rows without a
conv_id form one conversation; a role is the assistant's if it is exactly
``assistant``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, table

by_value(__name__)

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
OPEN, CLOSE = "[INST] ", " [/INST]"
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: Column) -> Column:
    """As a text, and a line feed becomes backslash n."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and text, read back from a formatted turn."""
    head, body = piece[len("<s>") : -len("</s>")].split("\n", 1)
    if body.startswith(OPEN) and body.endswith(CLOSE):
        body = body[len(OPEN) : -len(CLOSE)]
    return unescape_role(head), unescape(body)


def parse_pieces(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of every formatted turn in a run of them; inside roles and
    texts the control strings that mark turns are escaped."""
    for piece in text.split("<s>")[1:]:
        yield parse_piece("<s>" + piece)


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, seq, example, formatted, char_start, loss_start, loss_end.

    ``example`` counts from 0: the example that a turn closes (assistant) or
    is context of first.  Spans are code points of the conversation's
    formatted text; the loss span is null unless the turn is trainable.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    reply = role == "assistant"
    head = F.concat(F.lit("<s>"), escape_role(role), F.lit("\n"))
    body = escape(text)
    turns = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        reply.alias("reply"),
        F.concat(head, F.when(reply, body).otherwise(F.concat(F.lit(OPEN), body, F.lit(CLOSE))), F.lit("</s>")).alias("formatted"),
        F.length(head).alias("head"),
        F.length(body).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("formatted").cast("long")).over(before), F.lit(0).cast("long"))
    placed = turns.select(
        "*",
        (F.row_number().over(order) - 1).cast("long").alias("seq"),
        F.coalesce(F.sum(F.col("reply").cast("long")).over(before), F.lit(0).cast("long")).alias("example"),
        start.alias("char_start"),
    )
    loss = F.when(F.col("reply"), F.col("char_start") + F.col("head"))
    return placed.select("conv_id", "seq", "example", "formatted", "char_start", loss.alias("loss_start"), (loss + F.col("body")).alias("loss_end"))


#: characters of examples that leave a task at a time
EMIT_CHARS = 1 << 21


def example_texts(formatted: DataFrame, rest: bool = False) -> DataFrame:
    """conv_id, example, text (context and reply), loss_start, loss_end: one row
    an assistant turn, written out.  With ``rest`` the turns after the last one
    come as an example without a target (a null loss span).

    Rows of a task stand by conversation and example.  A task holds one
    conversation's formatted text, which is as long as its longest example."""
    conv_type = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "example", "text", "loss_start", "loss_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, waiting = False, False
        key, example, prefix, size = None, 0, "", 0
        rows: list[tuple] = []

        def flush():
            nonlocal size
            types = (key_type, pa.int64(), pa.string(), pa.int64(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
            rows.clear()
            size = 0
            return out

        for batch in batches:
            key_type = batch.column(batch.schema.get_field_index("conv_id")).type
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "example", "formatted", "loss_start", "loss_end")]
            for conv, nth, piece, a, b in zip(*columns, strict=True):
                if not begun or conv != key:
                    if rest and waiting:
                        rows.append((key, example, prefix, None, None))
                        size += len(prefix)
                    begun, key, prefix = True, conv, ""
                prefix += piece
                example, waiting = nth, a is None
                if a is not None:
                    rows.append((key, example, prefix, a, b))
                    size += len(prefix)
                if size >= EMIT_CHARS:
                    yield flush()
        if rest and waiting:
            rows.append((key, example, prefix, None, None))
        if rows:
            yield flush()

    sorted_rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return sorted_rows.mapInArrow(run, f"conv_id {conv_type}, example long, text string, loss_start long, loss_end long")


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(formatted: DataFrame) -> DataFrame:
    """What the written-out examples of each conversation read back to: the
    turns from what each example adds to the one before it, the loss from each
    example's own span.  An example whose context isn't the whole example before
    it is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        rows: list[tuple] = []
        key, turns, before = None, None, ""

        def close():
            rows.append((key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), len(before)))

        def flush():
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))
            rows.clear()
            return out

        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                conv, _, text, a, b = (v.as_py() for v in values)
                if turns is None or conv != key:
                    if turns is not None:
                        close()
                    key, n, turns, loss_chars, loss, before = conv, 0, hashlib.sha256(), 0, hashlib.sha256(), ""
                if not text.startswith(before):
                    raise ValueError(f"conversation {conv}: an example doesn't go on from the one before it")
                for role, said in parse_pieces(text[len(before) :]):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                if a is not None:
                    trained = unescape(text[a:b])
                    loss_chars += len(trained)
                    loss.update(trained.encode())
                before = text
            if rows:
                yield flush()
        if turns is not None:
            close()
            yield flush()

    return example_texts(formatted, rest=True).mapInArrow(run, DIGEST)


def op7_chat_examples(spark, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 with control strings in it."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role"), F.col("text")
    )
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digest(format_turns(rows.unionByName(probe)))
