"""Chat formatting by prefix-target expansion: one example per assistant turn, all turns before it as its context.

Every reply becomes an example, a row of its own: where its context ends, and the span of the reply, which alone is
trainable. The context is all formatted text of the conversation before that span. It is not copied into the row: the
examples of a conversation together grow with the square of its length, so turns are stored once, in rows ("pieces") that
hold the turns since the row before and end with a reply. An example names the piece that holds its reply; its context is
the text of the pieces before and of this one up to the reply. ``expanded`` writes examples out in full.

Turns are range-partitioned by (conversation, turn), so a conversation of any length is formatted by many tasks; where a
border or ``PIECE_CHARS`` cuts it, a piece ends without a reply and the next one goes on.

The template marks turns by control strings; a backslash goes before each of them inside texts and before each backslash.

Rules: NULL texts are empty; turns are ordered by turn (NULL first), then role, then a hash of the text; repeated rows
are turns of their own; roles other than the three known ones, NULL (as "") too, are written out by name; a
conversation without assistant turns has no example but is kept; NULL ids form one conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECE_CHARS = 1 << 20
# Fixed values of the template: opening and closing of the known roles, and of others around their name.
OPEN = {"system": "<<SYS>>", "user": "[INST] ", "assistant": "<s>"}
CLOSE = {"system": "<</SYS>>", "user": " [/INST]", "assistant": "</s>"}
NAME_OPEN, NAME_CLOSE, OTHER_CLOSE = "[ROLE]", "[/ROLE]", "[END]"
_CONTROL = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", NAME_OPEN, NAME_CLOSE, OTHER_CLOSE]
_PIECES = "conv_id long, part int, sequence long, n_turns long, text string, reply_start long, reply_end long, place long, chars_before long"
_EXAMPLES = "conv_id long, example long, context_chars long, part int, sequence long, reply_start long, reply_end long"

_ESCAPE = re.compile("|".join(map(re.escape, ["\\", *_CONTROL])))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_SCAN = re.compile(r"\\.|" + "|".join(map(re.escape, _CONTROL)), re.DOTALL)


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of the text in it)."""
    opening = OPEN[role] if role in OPEN else NAME_OPEN + escaped(role) + NAME_CLOSE
    body = escaped(text)
    return opening + body + CLOSE.get(role, OTHER_CLOSE), len(opening), len(opening) + len(body)


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    role, begin = "", 0
    for mark in _SCAN.finditer(text):
        control = mark[0]
        if control[0] == "\\":
            continue
        if control == NAME_OPEN:
            begin = mark.end()
        elif control == NAME_CLOSE:
            role, begin = unescaped(text[begin:mark.start()]), mark.end()
        elif control == OTHER_CLOSE:
            yield role, unescaped(text[begin:mark.start()])
        elif control in ("<<SYS>>", "[INST]", "<s>"):
            role = {"<<SYS>>": "system", "[INST]": "user", "<s>": "assistant"}[control]
            begin = mark.start() + len(OPEN[role])
        else:
            yield role, unescaped(text[begin:mark.end() - len(CLOSE[role])])


def _write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, sequence = TaskContext.get().partitionId(), 0
    current, texts, size, turns = None, [], 0, 0
    place, before = 0, 0     # replies and formatted characters of this conversation in this task
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["conv_id", "part", "sequence", "n_turns", "text", "reply_start", "reply_end", "place", "chars_before"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def close(start: int = -1, end: int = -1) -> None:
        nonlocal texts, size, turns, sequence, place, before
        if turns:
            text = "".join(texts)
            rows.append((current, part, sequence, turns, text, start, end, place, before))
            place, before = place + (start >= 0), before + len(text)
            texts, size, turns, sequence = [], 0, 0, sequence + 1

    held = 0
    for b in batches:
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if conv != current:
                close()
                current, place, before = conv, 0, 0
            turn, begin, end = formatted(role, text)
            texts.append(turn)
            turns += 1
            held += len(turn)
            if role == "assistant":
                close(size + begin, size + end)
            else:
                size += len(turn)
                if size >= PIECE_CHARS:
                    close()
            if held >= 4 * PIECE_CHARS and rows:
                yield batch()
                rows, held = [], 0
    close()
    if rows:
        yield batch()


def write_chats(turns: DataFrame, folder: str) -> None:
    """Writes the pieces and the examples of all conversations of ``turns`` (conv_id, turn, role, text)."""
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "role", "text")
     .mapInArrow(_write_part, _PIECES).write.parquet(f"{folder}/pieces"))
    _examples(read_chats(spark, folder)).write.parquet(f"{folder}/examples")


def _examples(pieces: DataFrame) -> DataFrame:
    """Every reply as an example of its own.

    A piece knows what its task wrote of the conversation before it; what earlier tasks wrote is one row per task and
    conversation, known only for conversations that a border cuts.
    """
    one = Window.partitionBy("_conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (pieces.groupBy(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"))
               .agg(F.count(F.when(F.col("reply_start") >= 0, 1)).alias("_replies"), F.sum(F.length("text")).alias("_chars"))
               .select("_conv", "_part", F.sum("_replies").over(one).alias("_replies"), F.sum("_chars").over(one).alias("_chars"))
               .where("_chars is not null"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    replies = pieces.where("reply_start >= 0").drop("text").join(earlier, same, "left")
    return replies.select(
        "conv_id", (F.col("place") + F.coalesce("_replies", F.lit(0))).alias("example"),
        (F.col("chars_before") + F.coalesce("_chars", F.lit(0)) + F.col("reply_start")).alias("context_chars"),
        "part", "sequence", "reply_start", "reply_end")


def read_chats(spark: SparkSession, folder: str) -> DataFrame:
    """The stored turns."""
    return spark.read.schema(_PIECES).parquet(f"{folder}/pieces")


def read_examples(spark: SparkSession, folder: str) -> DataFrame:
    """One row per reply; its text is in the piece (``part``, ``sequence``)."""
    return spark.read.schema(_EXAMPLES).parquet(f"{folder}/examples")


def _with_examples(pieces: DataFrame, examples: DataFrame) -> DataFrame:
    """Each piece with the example that ends in it; ``example`` is -1 where none does."""
    named = examples.select("part", "sequence", *(F.col(c).alias(f"_{c}") for c in ("example", "context_chars", "reply_start", "reply_end")))
    found = pieces.select("conv_id", "part", "sequence", "text").join(named, ["part", "sequence"], "left")
    return found.select("conv_id", "part", "sequence", "text", *(F.coalesce(f"_{c}", F.lit(-1)).cast("long").alias(c) for c in (
        "example", "context_chars", "reply_start", "reply_end")))


def _in_order(pieces: DataFrame) -> DataFrame:
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "sequence")


def _conversations(batches, start, step, finish):
    """Streams sorted pieces; one state per conversation, nothing else is held."""
    state, current, any_row = None, None, False
    for batch in batches:
        for row in batch.itertuples(index=False):
            conv = None if pd.isna(row.conv_id) else int(row.conv_id)
            if not any_row or conv != current:
                if any_row:
                    yield finish(state, current)
                state, current, any_row = start(), conv, True
            step(state, row)
    if any_row:
        yield finish(state, current)


def chat_digests(pieces: DataFrame, examples: DataFrame) -> DataFrame:
    """What each conversation's formatted text says, parsed back: turns, and the trainable text of its examples in order.

    An example whose context is not exactly what comes before its reply stops the job. A checksum has to see a conversation's turns one after another, so one task streams each conversation; it
    holds one piece at a time.
    """
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars"]

    def start():
        return {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "chars": 0, "formatted": 0, "examples": 0, "expanded": 0}

    def step(s, row):
        for role, text in turns_of(row.text):
            s["turns"].update(f"{role}\n{text}\n".encode())
            s["n"] += 1
        before = s["formatted"]
        s["formatted"] += len(row.text)
        if row.example >= 0:
            if (row.example, row.context_chars) != (s["examples"], before + row.reply_start):
                raise ValueError(f"example {row.example} of conversation {row.conv_id} is out of place")
            reply = unescaped(row.text[row.reply_start:row.reply_end])
            s["loss"].update(reply.encode())
            s["chars"] += len(reply)
            s["examples"] += 1
            s["expanded"] += s["formatted"]

    def finish(s, conv):
        return (conv, s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["formatted"], s["examples"], s["expanded"])

    def run(batches):
        held = []
        for row in _conversations(batches, start, step, finish):
            held.append(row)
            if len(held) >= 1000:
                yield _frame(held, columns)
                held = []
        if held:
            yield _frame(held, columns)

    kinds = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
             "n_examples long, example_chars long")
    return _in_order(_with_examples(pieces, examples)).mapInPandas(run, kinds)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})


def expanded(pieces: DataFrame, examples: DataFrame) -> DataFrame:
    """(conv_id, example, context, reply) of every example, written out in full: only ``reply`` is trainable.

    The rows of one conversation grow with the square of its length; they are streamed one at a time.
    """
    def run(batches):
        current, context, begun = None, "", False
        for batch in batches:
            for row in batch.itertuples(index=False):
                conv = None if pd.isna(row.conv_id) else int(row.conv_id)
                if not begun or conv != current:
                    current, context, begun = conv, "", True
                if row.example >= 0:
                    before = context + row.text[:row.reply_start]
                    yield _frame([(conv, row.example, before, row.text[row.reply_start:row.reply_end])], ["conv_id", "example", "context", "reply"])
                context += row.text
    return _in_order(_with_examples(pieces, examples)).mapInPandas(run, "conv_id long, example long, context string, reply string")
