"""Conversation structure repair: the cheapest edits that make the roles of a conversation read ``(s?(ua)+)?``.

Edits, in the order of the turns: Keep (0), Rerole to user or assistant (2), Delete (3, required for blank and duplicate rows), Insert
an empty user or assistant turn (2); a truncated row that is not deleted adds 1. Of the cheapest edits those whose initials,
read as one text (the audit), come first in ASCII order are taken.

A way through the graph of (row, state) has one whole number as its weight: the cost, followed by one digit for each edit in order,
D < I < K < R as 1 to 4, and zeros behind the last one up to a fixed width. The least number is the answer: no other comparison is
made. States are what was written last: nothing, a system, a user, or an assistant turn. Numbers go from the last row to the
first; a new edit moves the digits one place down and takes the first one.

A conversation is cut into segments of ``SEGMENT`` different rows. Each yields the least weight from every state to every state, and
segments are multiplied in groups of ``GROUP`` until one is left, so no task sees more than one segment's rows or one group's
weights. Ways between two states over the same rows that cost the same never begin with one another (what is left would have to be free
inserts), so the least weight of the parts gives the least weight of the whole. Only the written-out result of a conversation
runs through one task, for its checksum has to see one turn after another; that task streams.

Rules: a NULL role or text is one space; rows go by turn (NULL first), then role, then the SHA-256 of the text; equal rows of one turn
are adjacent copies; a role's initial is its first character, compared as it is; the NULL id is a conversation of its own; an empty
table has no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import PLACED_ROWS, join_counted, placed, stored

SEGMENT = 1024
GROUP = 16

# Costs of the edits, and what a truncated row adds unless it is deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_DIGITS = str.maketrans("DIKR", "1234")
_LETTERS = str.maketrans("1234", "DIKR")
_D, _I, _K, _R = 1, 2, 3, 4
_BITS = 3   # a digit

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}   # whose turn it is
_INITIALS = {"s": ((NOTHING, SYSTEM),), "u": ((NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
_INSERTS = {NOTHING: 2, SYSTEM: 2, USER: 1, ASSISTANT: 1}   # more of them in one place come back to the same state

SPACES = " \t\n\x0b\x0c\r"
_MATRIX = "array<struct<begin: int, end: int, cost: bigint, audit: string>>"
_PART = f"conv string, segment long, illegal long, first string, last string, ways {_MATRIX}"


def encoded(cost: int, audit: str, width: int) -> int:
    return (cost << _BITS * width) + int(audit.translate(_DIGITS).ljust(width, "0") or "0", 8)


def decoded(weight: int, width: int) -> tuple[int, str]:
    cost = weight >> _BITS * width
    digits = weight - (cost << _BITS * width)
    return cost, f"{digits:o}".zfill(width).rstrip("0").translate(_LETTERS) if digits else ""


def _before(weight: int | None, digit: int, cost: int, width: int) -> int | None:
    """The weight of a way that begins with one more edit."""
    if weight is None:
        return None
    whole = weight >> _BITS * width
    digits = weight - (whole << _BITS * width)
    return (whole + cost << _BITS * width) + (digit << _BITS * (width - 1)) + (digits >> _BITS)


def _joined(first: int, second: int, width: int) -> int:
    """The weight of one way after another."""
    whole = first >> _BITS * width
    digits = first - (whole << _BITS * width)
    after = second >> _BITS * width
    tail = second - (after << _BITS * width)
    used = 0 if not digits else width - ((digits & -digits).bit_length() - 1) // _BITS
    return (whole + after << _BITS * width) + digits + (tail >> _BITS * used)


def _least(weights) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def _inserted(ways: list[int | None], width: int) -> list[int | None]:
    out = []
    for state in _STATES:
        options, at = [ways[state]], state
        for n in range(1, _INSERTS[state] + 1):
            at = _NEXT[at]
            w = ways[at]
            for _ in range(n):
                w = _before(w, _I, INSERT, width)
            options.append(w)
        out.append(_least(options))
    return out


def _over_row(ways: list[int | None], initial: str, must_go: bool, truncated: bool, copies: int, width: int) -> list[int | None]:
    """From the weights behind a row and its copies to those in front of it; further copies are always deleted."""
    if copies > 1:
        run = copies - 1
        ones = ((1 << _BITS * run) - 1) // 7 << _BITS * (width - run)
        ways = [None if w is None else _joined((DELETE * run << _BITS * width) + ones, w, width) for w in ways]
    out = [_before(w, _D, DELETE, width) for w in ways]
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for state in _STATES:
            out[state] = _least([out[state], _before(ways[_NEXT[state]], _R, REROLE + extra, width)])
        for state, then in _INITIALS.get(initial, ()):
            out[state] = _least([out[state], _before(ways[then], _K, KEEP + extra, width)])
    return _inserted(out, width)


def matrix(rows: list[tuple[str, bool, bool, int]]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of the least ways over the rows (initial, must go, truncated, copies)."""
    width = sum(r[3] for r in rows) + 2 * len(rows) + 2
    out = []
    for end in _STATES:
        ways: list[int | None] = [0 if s == end else None for s in _STATES]
        for row in reversed(rows):
            ways = _over_row(ways, *row, width)
        out += [(s, end, *decoded(w, width)) for s, w in enumerate(ways) if w is not None]
    return out


def product(parts: list[list[tuple[int, int, int, str]]]) -> list[tuple[int, int, int, str]]:
    """The least ways over all parts, one after the other."""
    width = sum(max(len(way[3]) for way in part) for part in parts) + 1
    out = []
    for end in _STATES:
        ways: list[int | None] = [0 if s == end else None for s in _STATES]
        for part in reversed(parts):
            options: list[list[int]] = [[] for _ in _STATES]
            for s, then, cost, audit in part:
                if ways[then] is not None:
                    options[s].append(_joined(encoded(cost, audit, width), ways[then], width))
            ways = [_least(o) for o in options]
        out += [(s, end, *decoded(w, width)) for s, w in enumerate(ways) if w is not None]
    return out


def chosen(ways: list[tuple[int, int, int, str]]) -> tuple[int, str]:
    """Cost and audit of the least way from nothing to nothing or to an assistant's turn, with the last inserts."""
    width = max(len(w[3]) for w in ways) + 3
    ends = _inserted([0, None, None, 0], width)
    return decoded(_least(_joined(encoded(cost, audit, width), ends[end], width)
                          for begin, end, cost, audit in ways if begin == NOTHING and ends[end] is not None), width)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows whose first ``keys`` columns are equal, from sorted batches."""
    current, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != current:
                if held:
                    yield current, held
                current, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield current, held


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _part_schema() -> pa.Schema:
    way = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    return pa.schema([("conv", pa.string()), ("segment", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()),
                      ("last", pa.string()), ("ways", pa.list_(way))])


def _part(conv: str, segment: int, initials: list[str], inside: int, ways: list[tuple]) -> dict:
    return {"conv": conv, "segment": segment, "first": initials[0], "last": initials[-1], "illegal": inside,
            "ways": [dict(zip(("begin", "end", "cost", "audit"), w, strict=True)) for w in ways]}


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _segments(batches):
    def parts():
        for (conv, segment), rows in _grouped(batches, 2):
            rows = [r[1:] for r in rows]   # the position has done its work
            initials = [r[0] for r in rows]
            inside = sum(r[3] - 1 for r in rows) + sum(not _legal(a, b) for a, b in zip(initials, initials[1:], strict=False))
            yield _part(conv, segment, initials, inside, matrix(rows))
    yield from _batches(parts(), _part_schema())


def _multiplied(batches):
    def parts():
        for (conv, group), rows in _grouped(batches, 2):
            borders = sum(not _legal(a[3], b[2]) for a, b in zip(rows, rows[1:], strict=False))
            ways = product([[(w["begin"], w["end"], w["cost"], w["audit"]) for w in r[4]] for r in rows])
            yield _part(conv, group, [rows[0][2], rows[-1][3]], borders + sum(r[1] for r in rows), ways)
    yield from _batches(parts(), _part_schema(), 16)


def _finished(batches):
    def rows():
        for batch in batches:
            for conv, illegal, ways in zip(*(batch.column(c).to_pylist() for c in ("conv", "illegal", "ways")), strict=True):
                cost, audit = chosen([(w["begin"], w["end"], w["cost"], w["audit"]) for w in ways])
                yield {"conv": conv, "illegal": illegal, "cost": cost, "audit": audit}
    yield from _batches(rows(), pa.schema([("conv", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))


def _sorted_groups(rows: DataFrame, parts: int, keys: list[str], order: list[str]) -> DataFrame:
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, *order)


def _keyed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest) without NULL but in turn."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
                       F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def faults(rows: DataFrame) -> DataFrame:
    """One row per (conv, turn, role, digest) with its copies, and whether it is blank, repeated, truncated.

    ``repeated`` tells that an earlier turn has the same role and text. Equal rows are counted before the shuffle.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    marked = rows.select("conv", "turn", "role", "digest", (body == "").alias("blank"),
                         (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    found = stored(marked.groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("copies")), "turns")
    same = ["conv", "role", "digest"]
    firsts = stored(found.groupBy(*same).agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("times"))
                    .where("times > 1"), "first-turns")
    known = join_counted(found, firsts, same, "times")
    again = F.col("times").isNotNull() & ~F.col("earliest.turn").eqNullSafe(F.col("turn"))
    return known.select(*found.columns, again.alias("repeated"))


def counts(found: DataFrame) -> DataFrame:
    """Per conversation: gaps, and rows by their first fault."""
    sound = ~F.col("blank")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return found.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(sound, F.col("copies") - F.when(F.col("repeated"), 0).otherwise(1)).otherwise(0)).alias("duplicate"),
        F.sum((sound & ~F.col("repeated") & F.col("cut")).cast("long")).alias("truncated"))


def edits(found: DataFrame) -> DataFrame:
    """Per conversation: illegal neighbours, cost and audit of the cheapest edits."""
    rows = found.select("conv", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"),
                        (F.col("blank") | F.col("repeated")).alias("must_go"), F.col("cut"), F.col("copies"))
    ordered = placed(rows, "conv", ["turn", "role", "digest"], "position", "ordered")
    narrow = ordered.select("conv", F.floor(F.col("position") / SEGMENT).cast("long").alias("segment"), "position", "initial", "must_go", "cut", "copies")
    parts = found.count() // PLACED_ROWS + 1
    now = stored(_sorted_groups(narrow, parts, ["conv", "segment"], ["position"]).mapInArrow(_segments, _PART), "segments")
    done = None
    while not now.where("segment > 0").isEmpty():
        long = now.where("segment > 0").select("conv").distinct()
        rest = now.join(long, "conv", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        groups = now.join(long, "conv", "left_semi").select(
            "conv", F.floor(F.col("segment") / GROUP).cast("long").alias("group"), "segment", "illegal", "first", "last", "ways")
        now = stored(_sorted_groups(groups, parts, ["conv", "group"], ["segment"]).mapInArrow(_multiplied, _PART), "segments")
    done = now if done is None else done.unionByName(now)
    return done.select("conv", "illegal", "ways").mapInArrow(_finished, "conv string, illegal long, cost long, audit string")


def _written(batches):
    """Runs the audit over a conversation's rows: (conv, role, text) of the repaired turns; None after the last one."""
    conv, letters, state = None, iter(()), NOTHING

    def put(role: str | None, text: str):
        nonlocal state
        state = _NEXT[state] if role is None else {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        return conv, role or ("user" if state == USER else "assistant"), text

    for batch in batches:
        for owner, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")), strict=True):
            if audit is not None:   # comes before the rows of its conversation
                if conv is not None:
                    yield from (put(None, "") for _ in letters)
                    yield conv, None, None
                conv, letters, state = owner, iter(audit), NOTHING
                continue
            for letter in letters:
                if letter == "I":
                    yield put(None, "")
                    continue
                if letter != "D":
                    yield put(role if letter == "K" else None, text)
                break
    if conv is not None:
        yield from (put(None, "") for _ in letters)
        yield conv, None, None


def _digested(batches):
    def rows():
        total, begun = hashlib.sha256(), False
        for conv, role, text in _written(batches):
            if role is None:
                yield {"conv": conv, "repaired": total.digest()}
                total, begun = hashlib.sha256(), False
            else:
                total.update(f"{'\n' * begun}{role}:{text}".encode())
                begun = True
    yield from _batches(rows(), pa.schema([("conv", pa.string()), ("repaired", pa.binary())]))


def _listed(batches):
    def rows():
        place = 0
        for conv, role, text in _written(batches):
            if role is None:
                place = 0
            else:
                yield {"conv": conv, "place": place, "role": role, "text": text}
                place += 1
    kinds = [("conv", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    yield from _batches(rows(), pa.schema(kinds), 100)


def _streamed(rows: DataFrame, audits: DataFrame, function, kinds: str) -> DataFrame:
    """Rows of a conversation in order behind its audit, through one task that holds one batch."""
    lines = rows.select("conv", F.lit(1).alias("line"), "turn", "role", "digest", F.lit(None).cast("string").alias("audit"), "text")
    heads = audits.select("conv", F.lit(0).alias("line"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit(None).cast("binary").alias("digest"), "audit", F.lit("").alias("text"))
    return (lines.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "line", "turn", "role", "digest")
            .select("conv", "audit", "role", "text").mapInArrow(function, kinds))


def _conv_id(kind: str) -> Column:
    return F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, and ``repaired``, the SHA-256 of the repaired ``role:text`` lines."""
    keyed = _keyed(rows)
    found = stored(faults(keyed), "faults")
    audits = stored(edits(found), "audits")
    digests = _streamed(keyed, audits, _digested, "conv string, repaired binary")
    out = counts(found).join(audits, "conv").join(digests, "conv")
    return out.select(_conv_id(rows.schema["conv_id"].dataType.simpleString()), "gaps", "blank", "duplicate", "truncated", "illegal",
                      "cost", "audit", "repaired")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations."""
    keyed = _keyed(rows)
    audits = stored(edits(stored(faults(keyed), "faults")), "audits")
    out = _streamed(keyed, audits, _listed, "conv string, place long, role string, text string")
    return out.select(_conv_id(rows.schema["conv_id"].dataType.simpleString()), "place", "role", "text")
