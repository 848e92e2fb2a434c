"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and its reply alone is
trainable. The examples of a conversation share their prefixes, whose copies would grow with the square of the
turns. The output therefore stores each formatted turn once, with its place in the conversation; an example is a
row with a number, its context the formatted text before ``begin``, and its loss mask the span of the reply.
:func:`examples` lists them so, and :func:`render` writes them out.

Texts may hold the template's own control strings: a backslash is doubled and ``<|`` becomes ``<\\|``, which
:func:`read_turn` takes back.

Scale: one shuffle by conversation. Turns are read in order and nothing of an earlier turn is kept but its length,
so a conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.base import in_chunks, rows_of, ship_by_value

START, END = "<|im_start|>", "<|im_end|>"
ANSWERING = "assistant"
SEGMENTS = (
    "conv_id long, turn_index long, example long, formatted string, begin long, loss_begin long, loss_end long"
)
TURNS_READ = "conv_id long, n_turns long, turns_sha256 string, formatted_chars long"
EXAMPLES_READ = "conv_id long, n_examples long, loss_chars long, loss_sha256 string"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the span of its text. A line break in a role is written as ``\\n``."""
    head = f"{START}{escape(role)}".replace("\n", "\\n") + "\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    head, body = formatted.removeprefix(START).removesuffix(f"{END}\n").split("\n", 1)
    return unescape(head), unescape(body)


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted turns from (conv_id, turn, role, text), in order within their partition; see the module.

    ``example`` numbers the assistant turns of a conversation from 0 and is null for other turns; begin is the
    turn's place in the conversation's formatted text; loss_begin and loss_end, null for other turns, are the
    reply's span within ``formatted``. Null roles and texts count as empty, a null conv_id is one conversation,
    turns of equal number are ordered by role and text, null turns first. An empty table gives no row.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            first, current, index, begin, example = True, None, 0, 0, 0
            for conv_id, role, text in rows_of(batches, "conv_id", "role", "text"):
                if first or conv_id != current:
                    first, current, index, begin, example = False, conv_id, 0, 0, 0
                formatted, start, stop = format_turn(role, text)
                if role == ANSWERING:
                    yield conv_id, index, example, formatted, begin, start, stop
                    example += 1
                else:
                    yield conv_id, index, None, formatted, begin, None, None
                index, begin = index + 1, begin + len(formatted)

        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 3
        names = ["conv_id", "turn_index", "example", "formatted", "begin", "loss_begin", "loss_end"]
        yield from in_chunks(made(), lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names), 500)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, SEGMENTS)


def examples(segments: DataFrame) -> DataFrame:
    """One row per example: its number, the turns and characters of its context, its target and its loss mask."""
    return segments.filter("example IS NOT NULL").select(
        "conv_id", "example", F.col("turn_index").alias("context_turns"), F.col("begin").alias("context_chars"),
        F.col("formatted").alias("target"), "loss_begin", "loss_end",
    )


def render(segments: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """Whole examples as text: (conv_id, example, text, loss_begin, loss_end), the mask counted in the whole text.

    The output repeats every context, so its size grows with the square of a conversation's turns; ``chosen``
    (conv_id, example) restricts it.
    """
    wanted = examples(segments)
    if chosen is not None:
        asked = chosen.select(F.col("conv_id").alias("_c"), F.col("example").alias("_e"))
        wanted = wanted.join(asked, wanted["conv_id"].eqNullSafe(asked["_c"]) & (wanted["example"] == asked["_e"]), "left_semi")
    parts = segments.select(F.col("conv_id").alias("_c"), "turn_index", "formatted")
    joined = wanted.join(parts, wanted["conv_id"].eqNullSafe(parts["_c"]) & (parts["turn_index"] <= wanted["context_turns"]))
    return joined.groupBy("conv_id", "example").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn_index", "formatted"))), lambda x: x["formatted"]), "").alias("text"),
        (F.first("context_chars") + F.first("loss_begin")).alias("loss_begin"), (F.first("context_chars") + F.first("loss_end")).alias("loss_end"),
    )


def _digests(df: DataFrame, columns: list[str], read: Callable, schema: str) -> DataFrame:
    """One row per conversation from rows that lie in order within partitions: conv_id, the number of its rows, a
    digest and a length. ``read`` gives a row's text for the digest and its length."""
    names = [field.split()[0] for field in schema.split(", ")]
    hashed, counted = (next(n for n in names if n.endswith(end)) for end in ("_sha256", "_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            conv_id, n, size, digest = None, 0, 0, None
            for conv, *row in rows_of(batches, "conv_id", *columns):
                if n and conv != conv_id:
                    yield conv_id, n, digest.hexdigest(), size
                    n = 0
                if not n:
                    conv_id, size, digest = conv, 0, hashlib.sha256()
                text, length = read(*row)
                digest.update(text.encode())
                n, size = n + 1, size + length
            if n:
                yield conv_id, n, digest.hexdigest(), size

        def batch(rows: list) -> pa.RecordBatch:
            ids, counts, digests, sizes = zip(*rows)
            by_name = {"conv_id": ids, names[1]: counts, hashed: digests, counted: sizes}
            return pa.RecordBatch.from_arrays(
                [pa.array(by_name[x], pa.string() if x == hashed else pa.int64()) for x in names], names=names)

        yield from in_chunks(made(), batch)

    return df.mapInArrow(run, schema)


def read_turns(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, formatted_chars) of all turns, parsed from ``formatted`` alone."""

    def read(formatted: str) -> tuple[str, int]:
        role, text = read_turn(formatted)
        return f"{role}\n{text}\n", len(formatted)

    return _digests(segments, ["formatted"], read, TURNS_READ)


def read_examples(expanded: DataFrame) -> DataFrame:
    """(conv_id, n_examples, loss_chars, loss_sha256): what lies under the loss masks of :func:`examples`."""

    def read(target: str, low: int, high: int) -> tuple[str, int]:
        reply = unescape(target[low:high])
        return reply, len(reply)

    return _digests(expanded, ["target", "loss_begin", "loss_end"], read, EXAMPLES_READ)


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation: what its turns hold, and what its examples train on.

    ``segments`` must come straight from :func:`format_conversations`, in order within partitions. A conversation
    without a reply has no example, nothing under the mask, and the digest of an empty text.
    """
    turns, trained = read_turns(segments), read_examples(examples(segments)).withColumnRenamed("conv_id", "_c")
    joined = turns.join(trained, turns["conv_id"].eqNullSafe(trained["_c"]), "left")
    return joined.select(
        "conv_id", "n_turns", "turns_sha256", F.coalesce("loss_chars", F.lit(0)).alias("loss_chars"),
        F.coalesce("loss_sha256", F.sha2(F.lit(""), 256)).alias("loss_sha256"), "formatted_chars",
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
    )


ship_by_value(__name__)
