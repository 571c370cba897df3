"""Repeated byte strings: every byte that a string of ``length`` bytes covers which starts elsewhere too.

All suffixes of all texts are ordered to the depth ``length`` by most-significant-digit passes, one grouping per digit;
a group that has one suffix left is dropped after each pass, and the groups that are left at the end are the repeated
strings. Two things make the passes fit a cluster:

* Digits are taken from a place that the content chooses, not from the suffix's first byte. Every window of ``length``
  bytes holds an anchor, the substring of ``length * 0.32`` bytes with the least hash; equal windows have equal anchors at
  equal places. First digit: the anchor (and one pass over its surroundings settles long copies at once). Second digit:
  the bytes that ``RUN`` neighbouring windows have in common. Last digit: the bytes that a window has beyond those.
* A digit is a hash of its bytes (the last one the bytes themselves) and a pass is a count by group, combined before
  the shuffle, so a string that is everywhere costs one row per task. Neighbouring suffixes travel as one row.

Rules: texts are UTF-8 bytes, NULL is empty; matches never cross documents; a text shorter than ``length`` loses nothing;
repeated rows repeat each other's strings, whatever their id; rows that share id and text have one result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import join_counted, stored
from lotwise.llm.words import Hasher, scramble, texts_of

RUN = 16
_U = np.uint64
_ANCHORS = "doc_id long, print long, anchor long, around long, at int, first int, last int"
_RUNS = "doc_id long, print long, digit long, beyond binary, low int, high int, at int, settled boolean"


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(_U).max, _U)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    after = np.minimum.accumulate(blocks, 1).ravel()
    before = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(before[:n], after[width - 1:width - 1 + n])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_width(length: int) -> int:
    return max(1, length * 8 // 25)


def _find_anchors(length: int):
    width = _anchor_width(length)
    reach = length - width

    def of_slice(texts):
        data, bounds = texts.data, texts.bounds
        hashed = Hasher(data)
        every = scramble(hashed.every(width))
        if len(data) < length:
            return None
        # The least hash decides, the first of equals; 32 bits of hash, then the place.
        order = (every >> _U(32) << _U(32)) | np.arange(len(every), dtype=_U)
        least = _sliding_least(order, reach + 1)
        steps = np.zeros(len(least) + 1, np.int32)
        long = np.flatnonzero(np.diff(bounds) >= length)
        np.add.at(steps, bounds[long], 1)
        np.add.at(steps, bounds[long + 1] - length + 1, -1)
        windows = np.flatnonzero(np.cumsum(steps)[:-1] > 0)
        if not len(windows):
            return None
        place = (least[windows] & _U(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(windows), bool)
        new[1:] = (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)
        begin = np.flatnonzero(new)
        first, at = windows[begin], place[begin]
        last = windows[np.append(begin[1:], len(windows)) - 1]
        row = np.searchsorted(bounds, first, "right") - 1
        start, end = bounds[row], bounds[row + 1]
        left, right = np.maximum(start, at - reach), np.minimum(end, at + length)
        around = scramble(Hasher(data, second=True).raw(left, right) ^ (at - left).astype(_U) * _U(0x9E3779B97F4A7C15)
                          ^ (right - at).astype(_U) * _U(0xC2B2AE3D27D4EB4F))
        return row, every[at], around, at - start, first - start, last - start

    def run(batches):
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                got = of_slice(texts)
                if got is not None:
                    row, anchor, around, at, first, last = got
                    rows = pa.array(row + texts.first)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(rows), batch.column("print").take(rows), _signed(anchor), _signed(around),
                         *(pa.array(x.astype(np.int32)) for x in (at, first, last))],
                        ["doc_id", "print", "anchor", "around", "at", "first", "last"])
    return run


def _cut_runs(length: int):
    reach = length - _anchor_width(length)

    def run(batches):
        for batch in batches:
            lists = batch.column("anchors")
            for texts in texts_of(batch.column("text")):
                part = lists.slice(texts.first, texts.rows)
                sizes = part.value_lengths().to_numpy(zero_copy_only=False)
                fields = part.flatten()
                anchor, at, first, last = (fields.field(k).to_numpy() for k in range(4))
                settled = fields.field(4).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(texts.rows), sizes)
                start, end = texts.bounds[row], texts.bounds[row + 1]
                at = at + start
                low, high = (first + start - at + reach) // RUN, (last + start - at + reach) // RUN
                count = high - low + 1
                k = np.repeat(np.arange(len(at)), count)
                number = low[k] + np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
                begin = at[k] - reach + RUN * number          # where the run's first window would start
                lows = np.maximum(begin, start[k]) - begin
                highs = np.minimum(begin + RUN - 1, end[k] - length) - begin
                common = Hasher(texts.data)(begin + RUN - 1, begin + length)
                digit = scramble(common ^ scramble(anchor.view(_U)[k] + number.astype(_U)))
                offsets = np.concatenate([np.arange(RUN - 1), np.arange(length, length + RUN - 1)])
                for a in range(0, len(k), 1 << 16):
                    some = slice(a, a + (1 << 16))
                    place = begin[some][:, None] + offsets
                    inside = (place >= start[k[some]][:, None]) & (place < end[k[some]][:, None])
                    beyond = np.where(inside, texts.data[np.clip(place, 0, len(texts.data) - 1)], 0).astype(np.uint8)
                    stride = np.arange(len(beyond) + 1, dtype=np.int32) * (2 * RUN - 2)
                    rows = pa.array(row[k[some]] + texts.first)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(rows), batch.column("print").take(rows), _signed(digit[some]),
                         pa.BinaryArray.from_buffers(pa.binary(), len(beyond), [None, pa.py_buffer(stride), pa.py_buffer(beyond.tobytes())]),
                         pa.array(lows[some].astype(np.int32)), pa.array(highs[some].astype(np.int32)),
                         pa.array((begin - start[k])[some].astype(np.int32)), pa.array(settled[k[some]])],
                        ["doc_id", "print", "digit", "beyond", "low", "high", "at", "settled"])
    return run


def _spans(rows: DataFrame, first, last, length: int) -> DataFrame:
    """Bytes that the windows starting at ``first`` to ``last`` cover."""
    return rows.select("doc_id", "print", first.cast("int").alias("start"), (last + length).cast("int").alias("end"))


def _pass(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Rows of groups with more than one row, and whether all of the group have one value.

    The counts are written first; rows of a hot group stay where they are.
    """
    counted = (rows.groupBy(group).agg(F.count("*").alias("times"), F.min(value).alias("x"), F.max(value).alias("y"))
               .where("times > 1").select(group, "times", (F.col("x") == F.col("y")).alias("same")))
    return join_counted(rows, stored(counted, "groups"), group, "times").where("times is not null").drop("times")


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, print, spans): byte spans of repeated strings, not merged yet; ``docs``: (doc_id, print, text)."""
    anchors = stored(docs.mapInArrow(_find_anchors(length), _ANCHORS), "anchors")
    anchors = stored(_pass(anchors, "anchor", "around"), "repeated-anchors")
    # Anchors whose surroundings are equal wherever they occur: all windows around them are repeated.
    spans = _spans(anchors.where("same"), F.col("first"), F.col("last"), length)
    mixed = anchors.where("not same").drop("same")
    # Equal surroundings settle their members; one of them still stands for all in the next passes.
    members = mixed.groupBy("anchor", "around").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "print", "at")).alias("one"))
    mixed = stored(join_counted(mixed, stored(members, "members"), ["anchor", "around"], "n"), "mixed-anchors")
    spans = spans.unionByName(_spans(mixed.where("n > 1"), F.col("first"), F.col("last"), length))
    going = (mixed.where(F.struct("doc_id", "print", "at") == F.col("one"))
             .groupBy("doc_id", "print").agg(F.collect_set(F.struct("anchor", "at", "first", "last", (F.col("n") > 1).alias("settled"))).alias("anchors")))
    same_doc = docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["print"] == F.col("_print"))
    texts = (docs.join(going.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "anchors").hint("merge"), same_doc)
             .select("doc_id", "print", "text", "anchors"))
    runs = stored(texts.mapInArrow(_cut_runs(length), _RUNS).withColumn("value", F.xxhash64("beyond", "low", "high")), "runs")
    runs = stored(_pass(runs, "digit", "value"), "repeated-runs")
    ends = (F.col("at") + F.col("low"), F.col("at") + F.col("high"))
    spans = spans.unionByName(_spans(runs.where("same and not settled"), *ends, length))
    mixed = runs.where("not same")
    members = mixed.groupBy("digit", "value").agg(F.count("*").alias("n"))
    mixed = stored(join_counted(mixed, stored(members, "members"), ["digit", "value"], "n"), "mixed-runs")
    spans = spans.unionByName(_spans(mixed.where("n > 1 and not settled"), *ends, length))
    # The last digit: a window's own bytes beside the common ones lie next to each other in ``beyond``.
    one = mixed.dropDuplicates(["digit", "value"])
    windows = one.select("doc_id", "print", "digit", "beyond", "at", (F.col("n") == 1).alias("open"), "settled",
                         F.explode(F.sequence("low", "high")).alias("number"))
    windows = windows.withColumn("rest", F.expr(f"substring(beyond, number + 1, {RUN - 1})")).drop("beyond")
    equal = windows.groupBy("digit", "number", "rest").agg(F.count("*").alias("m")).where("m > 1")
    hit = windows.where("open and not settled").join(equal, ["digit", "number", "rest"])
    start = F.col("at") + F.col("number")
    spans = spans.unionByName(_spans(hit, start, start, length))
    return spans.distinct().groupBy("doc_id", "print").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _remove(with_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = (text.as_py() or "").encode()
                found = _merged((s["start"], s["end"]) for s in spans.as_py() or ())
                places = [0, *(x for span in found for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(places[::2], places[1::2], strict=True))
                rows.append((len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), kept)[:4 + with_text])
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, zip(*rows, strict=True))], names)
    return run


def without_repeats(docs: DataFrame, length: int = 400, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeated) of every row of ``docs`` (doc_id, text), on request with the
    bytes kept; a cut may fall inside a character, so they are binary. ``repeated`` tells that bytes were removed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    found = repeated_spans(docs, length).select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "spans")
    rows = docs.join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), "left")
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    out = rows.select("doc_id", "text", "spans").mapInArrow(_remove(with_text), kinds)
    return out.withColumn("repeated", F.col("n_removed") > 0)
