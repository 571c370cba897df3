"""Benchmark decontamination: Wu-Manber search of documents for passages of test items.

Symbols are words. All windows of ``window`` consecutive words of an item are patterns (an item with fewer words,
but at least one, is one pattern). For the patterns of one length, a shift table over blocks of two words says how
far the search may jump; where it says 0, the hash of the last block selects a bucket of patterns, which are compared
word by word and, for hits, byte by byte. Texts are searched in lanes that walk side by side, so each step is one
numpy operation over all of them.

Items are dealt into blocks of about ``ITEM_BLOCK_BYTES`` by a hash, and tasks build the search tables of a block. Tables
travel as plain arrays, ``BLOCKS_A_SCAN`` blocks to a scan of the documents; so the driver and a worker hold the tables of
some 16 MB of items at most, and only a larger benchmark takes a further scan, whose spans join those found before.

Rules: a NULL or wordless text has no words and is clean; a wordless item has no pattern; an item without id counts
under the empty id; items with one id are one item; equal windows of several items hit all of them; an empty
benchmark leaves all documents clean. Repeated documents are judged alike. Other columns pass through.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import annotated, stored
from lotwise.llm.words import Hasher, Texts, alphanumeric, texts_of, words_of

ITEM_BLOCK_BYTES = 1 << 21
BLOCKS_A_SCAN = 8
_LANE = 256
_NEW = "n_words long, hit_spans array<struct<start: int, end: int>>, hit_items array<string>"


class _Length:
    """Shift table, buckets and patterns of one length."""

    def __init__(self, patterns: np.ndarray, words: int):
        count, self.length = patterns.shape
        self.block = min(2, self.length)
        self.words = words + 1
        self.bits = max(12, int(count * self.length).bit_length() + 1)
        self.shift = np.full(1 << self.bits, self.length - self.block + 1, np.min_scalar_type(-self.length - 1))
        for j in range(self.length - 1, self.block - 2, -1):  # the blocks that end at word j
            slots = self.slots(patterns[:, j - self.block + 1:j + 1])
            self.shift[slots] = np.minimum(self.shift[slots], self.length - 1 - j)
        last = self.slots(patterns[:, -self.block:])
        self.order = np.argsort(last, kind="stable")
        self.patterns = patterns
        self.buckets = last[self.order]     # a bucket is a run of equal numbers

    @classmethod
    def of(cls, state: dict) -> _Length:
        table = cls.__new__(cls)
        table.__dict__.update(state)
        return table

    def slots(self, block: np.ndarray) -> np.ndarray:
        key = block[:, -1].astype(np.uint64)
        if self.block == 2:
            key = key + block[:, 0].astype(np.uint64) * np.uint64(self.words)
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the last word, pattern) of every occurrence."""
        at = np.arange(self.length - 1, len(ids), _LANE)
        ends = np.minimum(at + _LANE, len(ids))
        found = []
        while len(at):
            jump = self.shift[self.slots(ids[at[:, None] + np.arange(1 - self.block, 1)])]
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            going = at < ends
            at, ends = at[going], ends[going]
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        slots = self.slots(ids[at[:, None] + np.arange(1 - self.block, 1)])
        first = np.searchsorted(self.buckets, slots)
        sizes = np.searchsorted(self.buckets, slots, "right") - first
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pattern = self.order[np.repeat(first, sizes) + within]
        at = np.repeat(at, sizes)
        for back in range(self.length):
            same = ids[at - back] == self.patterns[pattern, self.length - 1 - back]
            at, pattern = at[same], pattern[same]
        return at, pattern


class ItemBlock:
    """Search tables of some items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        fold, flags = alphanumeric()
        numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = {}
        self.item_ids = sorted({i for i, _ in items})
        index = {i: k for k, i in enumerate(self.item_ids)}
        for item, text in items:
            part = next(texts_of(pa.array([text])))
            folded = fold[part.data].tobytes()
            words = words_of(part, flags)
            ids = [numbers.setdefault(folded[a:b], len(numbers) + 1) for a, b in zip(words.starts, words.ends, strict=True)]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                by_length.setdefault(size, {}).setdefault(tuple(ids[k:k + size]), set()).add(index[item])
        self.vocabulary = np.frombuffer(b"".join(numbers), np.uint8)
        self.word_ends = np.cumsum([0, *map(len, numbers)])
        hashes = Hasher(self.vocabulary)(self.word_ends[:-1], self.word_ends[1:])
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], (order + 1).astype(np.int32)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[hashes >> np.uint64(48)] = True
        self.lengths, self.owners = [], []
        for windows in by_length.values():
            self.lengths.append(_Length(np.array(list(windows), np.int32), len(numbers)))
            sets = [sorted(x) for x in windows.values()]
            self.owners.append((np.cumsum([0, *map(len, sets)]), np.array([i for x in sets for i in x], np.int64)))

    def packed(self) -> bytes:
        """Plain arrays only, so that a worker needs nothing else to read them."""
        return pickle.dumps({**self.__dict__, "lengths": [t.__dict__ for t in self.lengths]}, 5)

    @classmethod
    def unpacked(cls, data: bytes) -> ItemBlock:
        block = cls.__new__(cls)
        block.__dict__.update(pickle.loads(data))
        block.lengths = [_Length.of(t) for t in block.lengths]
        return block

    def number(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int32)
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(48)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        same = self.hashes[place] == hashes[maybe]
        out[maybe[same]] = self.numbers[place[same]]
        return out

    def differ(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Which of these words are not, byte for byte, the vocabulary's words of these numbers."""
        first, sizes = self.word_ends[numbers - 1], ends - starts
        wrong = sizes != self.word_ends[numbers] - first
        sizes = np.where(wrong, 0, sizes)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        unequal = data[np.repeat(starts, sizes) + within] != self.vocabulary[np.repeat(first, sizes) + within]
        wrong[np.repeat(np.arange(len(sizes)), sizes)[unequal]] = True
        return wrong


def _search(block: ItemBlock, folded: np.ndarray, words, hashes: np.ndarray, rows: int):
    """(covered flag of each word, pairs of row and item index) of one slice."""
    counts = np.diff(words.bounds)
    row_of = np.repeat(np.arange(rows), counts)
    place = np.arange(len(row_of)) + row_of + 1  # one empty place before each row keeps matches inside it
    numbers = block.number(hashes)
    while True:
        ids = np.zeros(len(row_of) + rows + 1, np.int32)
        ids[place] = numbers
        steps = np.zeros(len(ids) + 1, np.int64)
        hits = []
        for table, (ends, owners) in zip(block.lengths, block.owners, strict=True):
            at, pattern = table.search(ids)
            np.add.at(steps, at - table.length + 1, 1)
            np.add.at(steps, at + 1, -1)
            sizes = ends[pattern + 1] - ends[pattern]
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hits.append((np.repeat(at, sizes), owners[np.repeat(ends[pattern], sizes) + within]))
        covered = np.cumsum(steps)[:-1][place] > 0
        mine = np.flatnonzero(covered)
        wrong = block.differ(folded, words.starts[mine], words.ends[mine], numbers[mine]) if len(mine) else mine
        if not wrong.any():
            break
        numbers[mine[wrong]] = 0  # words whose hash equals that of another word
    row_at = np.zeros(len(ids), np.int64)
    row_at[place] = row_of
    pairs = np.unique(np.concatenate([np.stack([row_at[a], i], 1) for a, i in hits]), axis=0) if hits else np.zeros((0, 2), int)
    return covered, pairs


def _spans(covered: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of covered words of each row, as word numbers within the row."""
    texts = Texts(0, covered.view(np.uint8), bounds)
    runs = words_of(texts, np.array([False, True] + [False] * 254))
    row = np.searchsorted(bounds, runs.starts, "right") - 1
    body = pa.StructArray.from_arrays([pa.array((runs.starts - bounds[row]).astype(np.int32)),
                                       pa.array((runs.ends - bounds[row]).astype(np.int32))], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(runs.bounds.astype(np.int32)), body)


def _annotator(held):
    fold, flags = alphanumeric()
    blocks: list[ItemBlock] = []

    def compute(column: pa.Array) -> list[pa.Array]:
        if not blocks:
            blocks.extend(ItemBlock.unpacked(data) for data in held.value)
        counts, spans, items = [], [], []
        for texts in texts_of(column):
            folded = fold[texts.data]
            words = words_of(texts, flags)
            hashes = Hasher(folded)(words.starts, words.ends)
            covered = np.zeros(len(hashes), bool)
            found: list[set[str]] = [set() for _ in range(texts.rows)]
            for block in blocks:
                got, pairs = _search(block, folded, words, hashes, texts.rows)
                covered |= got
                for row, item in pairs.tolist():
                    found[row].add(block.item_ids[item])
            counts.append(np.diff(words.bounds))
            spans.append(_spans(covered, words.bounds))
            items += [sorted(x) for x in found]
        return [pa.array(np.concatenate(counts)), pa.concat_arrays(spans), pa.array(items, pa.list_(pa.string()))]
    return compute


def item_tables(items: DataFrame, window: int) -> tuple[DataFrame, int]:
    """(block, table) rows with the packed search tables of the items, and the number of blocks."""
    rows = (items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
            .where("text is not null").distinct())
    count = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BLOCK_BYTES + 1

    def build(group: pd.DataFrame) -> pd.DataFrame:
        block = ItemBlock(list(zip(group["item"], group["text"], strict=True)), window)
        made = [(int(group["block"].iloc[0]), block.packed())] if block.lengths else []
        return pd.DataFrame(made, columns=["block", "table"])
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    return dealt.groupBy("block").applyInPandas(build, "block long, table binary"), count


def _union(a: Column, b: Column) -> Column:
    """Runs that cover what the runs of either list cover."""
    def add(runs: Column, s: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return (F.when(last["end"] >= s["start"], F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(joined)))
                .otherwise(F.concat(runs, F.array(s))))
    return F.aggregate(F.array_sort(F.concat(a, b)), F.slice(a, 1, 0), add)


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], window: int = 10) -> DataFrame:
    """Columns ``keep`` of ``docs`` with n_words, hit_spans (runs of hit words), hit_items (sorted ids),
    n_hit, n_items and contaminated."""
    sc = docs.sparkSession.sparkContext
    tables, count = item_tables(items, window)
    tables = stored(tables, "item-tables")
    spans, found = (f"_{name}{'_' * max(map(len, docs.columns))}" for name in ("spans", "items"))  # longer than any column's name
    out, carried = docs, list(dict.fromkeys([*keep, "text"]))
    for first in range(0, count, BLOCKS_A_SCAN):
        held = sc.broadcast([bytes(r["table"]) for r in tables.where(F.col("block").between(first, first + BLOCKS_A_SCAN - 1)).collect()])
        if not first:
            out = annotated(out, keep if count <= BLOCKS_A_SCAN else carried, _annotator(held), _NEW)
            continue
        before = stored(out.withColumnsRenamed({"hit_spans": spans, "hit_items": found}), "searched")
        out = annotated(before, [*carried, spans, found], _annotator(held), _NEW).withColumns({
            "hit_spans": _union(F.col(spans), F.col("hit_spans")),
            "hit_items": F.array_sort(F.array_union(found, "hit_items"))})
    new = ["n_words", "hit_spans", "hit_items"]
    out = out.select(*(f"`{k}`" for k in keep if k not in new), *new)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (out.withColumn("n_hit", hit).withColumn("n_items", F.size("hit_items").cast("long"))
            .withColumn("contaminated", F.col("n_hit") > 0))
