"""Chat formatting with prefix-target expansion (operator 4).

A turn is written as ``<|role|>`` + line break + text + ``<|end|>`` + line break.
Every assistant turn becomes an example of its own: all preceding turns are its
context and only that reply's text is under the loss mask (``loss_start`` to
``loss_stop``, code points of the formatted text). A conversation that does not
end with a reply also gets an example of all its turns without a loss.

Control strings inside texts and roles are escaped: a backslash is doubled and
one is put behind the first character of every control string, so none occurs in
an escaped text, and taking the backslashes out again restores it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import prepare_python, shared_path

# fixed control strings of the template and of common tokenizers
CONTROL = ("<|", "|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
END = "<|end|>\n"
TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.S)
EMIT_CHARS = 4_000_000


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROL:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its escaped text lies in it."""
    head, body = f"<|{escape(role)}|>\n", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def examples(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", reply: str = "assistant") -> DataFrame:
    """One row per example: ``conv_id``, ``example`` (0, 1, ...), ``n_turns``,
    ``target`` (its turn number, null without a loss), ``text``, ``loss_start``,
    ``loss_stop``, ``last`` (it holds the whole conversation).

    Turns are ordered by number, then role, then text; repeated turns are turns;
    null texts and roles are empty; rows of a null conversation id are one
    conversation; other columns are ignored. Conversations are dealt by id and a
    task streams its sorted turns, so it holds one conversation's text at a time.
    """
    prepare_python(conversations.sparkSession)
    read = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = read.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "example", "n_turns", "target", "text", "loss_start", "loss_stop", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        id_type = None

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal out
            types = [id_type, pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
            rows, out = out, []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        # one example behind: only the next row tells whether it was the last
        prefix, count, made, held, conv, chars, begun = "", 0, 0, None, None, 0, False

        def close() -> None:
            nonlocal held
            if held and held[2] == count:
                out.append((*held, True))
            else:
                if held:
                    out.append((*held, False))
                out.append((conv, made, count, None, prefix, 0, 0, True))
            held = None

        for b in batches:
            id_type = b.schema.field("conv_id").type
            for c, turn, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if begun and c != conv:
                    close()
                    prefix, count, made = "", 0, 0
                conv, begun = c, True
                piece, start, stop = format_turn(role, text)
                start, stop = start + len(prefix), stop + len(prefix)
                prefix += piece
                count += 1
                if role == reply:
                    if held:
                        out.append((*held, False))
                    held = (conv, made, count, turn, prefix, start, stop)
                    made += 1
                    chars += len(prefix)
                if chars >= EMIT_CHARS:
                    yield from emit()
                    chars = 0
        if begun:
            close()
        yield from emit()

    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {kind}, example int, n_turns int, target long, text string, "
                                   "loss_start int, loss_stop int, last boolean")


def write_examples(conversations: DataFrame, path: str | None = None, **how) -> str:
    path = path or shared_path(conversations.sparkSession, "chat")
    examples(conversations, **how).write.option("compression", "zstd").parquet(path)
    return path


def digest(written_examples: DataFrame) -> DataFrame:
    """One row per conversation, from the written examples alone: turns and text
    hash of the example that holds them all, the unescaped text under the masks
    in order, and the formatted code points of all its examples."""
    prepare_python(written_examples.sparkSession)
    loss = F.when(F.col("target").isNotNull(), F.substring("text", F.col("loss_start") + 1, F.col("loss_stop") - F.col("loss_start")))
    read = written_examples.select("conv_id", "example", loss.alias("loss"),
                                   F.when(F.col("last"), F.col("text")).alias("whole"),
                                   F.length("text").cast("long").alias("chars"))
    kind = read.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, id_type = None, False, None
        turns, whole, masked, n_masked, chars = 0, hashlib.sha256(), hashlib.sha256(), 0, 0
        for b in batches:
            id_type, rows = b.schema.field("conv_id").type, []
            for c, _, loss, text, n in zip(*(x.to_pylist() for x in b.columns)):
                if begun and c != conv:
                    rows.append((conv, turns, whole.hexdigest(), n_masked, masked.hexdigest(), chars))
                    turns, whole, masked, n_masked, chars = 0, hashlib.sha256(), hashlib.sha256(), 0, 0
                conv, begun = c, True
                if loss is not None:
                    plain = unescape(loss)
                    n_masked += len(plain)
                    masked.update(plain.encode())
                if text is not None:
                    for role, said in parse(text):
                        turns += 1
                        whole.update(f"{role}\n{said}\n".encode())
                chars += n
            if rows:
                yield batch(rows, id_type)
        if begun:
            yield batch([(conv, turns, whole.hexdigest(), n_masked, masked.hexdigest(), chars)], id_type)

    def batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)

    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")
