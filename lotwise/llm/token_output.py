"""Token-id output: texts as Simple-8b segments in ascending document order, and back.

Rows are range-partitioned by document id, each task encodes its own run of documents into segments of a few
hundred thousand ids, and Spark writes the segments as rows of a table (part, sequence, segment). Commit,
retries and lost executors are Spark's business; no task opens a file. Reading decodes segments and adds the
ids of all parts before (one number per part).

Rules: a NULL text is empty and gives the end id alone; a NULL id sorts first; rows with equal ids are all kept,
ordered by a hash of their text; an empty table gives an empty output. Other columns are ignored. A text that holds one of the
tokenizer's added tokens is encoded whole by the library, which gives such a token its own id.
"""

from __future__ import annotations

import re
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.base import scratch_path
from lotwise.llm.simple8b import decode, encode
from lotwise.llm.words import Texts, texts_of, worker_state

SEGMENT_IDS = 1 << 18
CACHED_PIECES = 350_000
SLICE_BYTES = 1 << 22
_SEGMENT_TYPE = "part int, sequence int, part_start long, n_ids long, doc_ids array<long>, segment binary"


def _byte_letters() -> str:
    """The letter that the byte-level form has for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_SPACE, _MARK = _flags(b"\t\n\v\f\r "), _flags(b".,:;!?")
_ASCII_LETTER = _flags(bytes(range(65, 91)) + bytes(range(97, 123)))
_LATIN_LEAD = _flags(b"\xc3\xc4\xc5")  # U+00C0 to U+017F: letters but for the signs of multiplication and division


def _rows_with(texts: Texts, tokens: list[bytes]) -> np.ndarray:
    """Rows that hold one of ``tokens``; a token across two rows may name the first of them needlessly."""
    data, found = texts.data.tobytes() if tokens else b"", []
    for token in tokens:
        at = data.find(token)
        while at >= 0:
            found.append(at)
            at = data.find(token, at + 1)
    return np.unique(np.searchsorted(texts.bounds, found, "right") - 1)


def _pieces(texts: Texts, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(borders of pieces that can be encoded on their own, rows that cannot be cut this way).

    Cut are: before a white-space run; between a letter and closing punctuation; between a lone white-space character
    that is no blank and a letter. The byte-level pre-tokenizer ends a piece of its own at each of these places.
    Rows with white space beyond ASCII or with one of the added ``tokens`` are left in one piece.
    """
    data = texts.data
    n = len(data)
    back = lambda x, k: np.concatenate([np.zeros(min(k, n), x.dtype), x[:max(n - k, 0)]])
    space, lead = _SPACE[data], _LATIN_LEAD[data]
    sign = back(data == 0xC3, 1) & ((data == 0x97) | (data == 0xB7))  # second byte of a sign
    letter_end = _ASCII_LETTER[data] | (back(lead, 1) & ~sign)
    letter_start = _ASCII_LETTER[data] | (lead & ~np.append(sign[1:], False))
    first = np.zeros(n + 1, bool)
    first[texts.bounds] = True
    first = first[:n]
    space_before = back(space, 1) & ~first
    alone = space & ~space_before & (data != 0x20)
    cut = first | (space & ~space_before) | (_MARK[data] & back(letter_end, 1)) | (letter_start & back(alone, 1))
    odd = ((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3)) & np.append(data[1:] >= 0x80, False)
    rows = np.zeros(0, np.int64)
    if odd.any():
        at = np.flatnonzero(odd)
        second, third = data[np.minimum(at + 1, n - 1)], data[np.minimum(at + 2, n - 1)]
        wide = (((data[at] == 0xC2) & ((second == 0x85) | (second == 0xA0)))
                | ((data[at] == 0xE1) & (second == 0x9A) & (third == 0x80))
                | ((data[at] == 0xE2) & (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)))
                | ((data[at] == 0xE2) & (second == 0x81) & (third == 0x9F)) | ((data[at] == 0xE3) & (second == 0x80) & (third == 0x80)))
        rows = np.unique(np.searchsorted(texts.bounds, at[wide], "right") - 1)
    rows = np.union1d(rows, _rows_with(texts, tokens)).astype(np.int64)
    for row in rows:
        cut[texts.bounds[row] + 1:texts.bounds[row + 1]] = False
    return np.append(np.flatnonzero(cut), n), rows


class _Known(dict):
    """Ids of pieces as bytes; a missing piece is encoded, unless the generation before knows it.

    A piece of letters is one piece for the pre-tokenizer too, so it goes to the tokenizer's BPE model at once.
    """

    def __init__(self, tokenizer, kind: str, before: dict[bytes, bytes], tokens: list[bytes]):
        super().__init__()
        self._tokens = tokens
        self._encode, self._merge, self._kind, self._before = tokenizer.encode, tokenizer.model.tokenize, kind, before
        self._letters = _byte_letters()
        self._plain = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4\xc5].)+", re.DOTALL).fullmatch

    def __missing__(self, piece: bytes) -> bytes:
        coded = self._before.get(piece)
        if coded is None:
            if self._plain(piece) and not any(t in piece for t in self._tokens):
                ids = [token.id for token in self._merge(charmap_decode(piece, "strict", self._letters)[0])]
            else:
                ids = self._encode(piece.decode(), add_special_tokens=False).ids
            coded = array(self._kind, ids).tobytes()
        if len(piece) <= 64:
            self[piece] = coded
        return coded


class PieceEncoder:
    """Encodes texts with a tokenizer whose pre-tokenizer is byte-level, each distinct piece of a slice once.

    Known pieces are kept in two generations of bounded size: what was not used during a whole generation is
    forgotten. That changes the time only, never the ids.
    """

    def __init__(self, path: str, capacity: int = CACHED_PIECES):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokens = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._kind = "H" if self._tokenizer.get_vocab_size() <= 1 << 16 else "I"  # of array and numpy alike
        self._known = _Known(self._tokenizer, self._kind, {}, self._tokens)
        self._capacity = capacity

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(borders of the rows among the ids, ids) of a slice."""
        if len(self._known) > self._capacity:
            self._known._before = {}
            self._known = _Known(self._tokenizer, self._kind, self._known, self._tokens)
        if not len(texts.data):
            return np.zeros(texts.rows + 1, np.int64), np.zeros(0, self._kind)
        borders, _ = _pieces(texts, self._tokens)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(borders) - 1,
                                                  [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(texts.data)])
        coded = pieces.dictionary_encode()
        which = coded.indices.to_numpy()
        distinct = list(map(self._known.__getitem__, coded.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) // np.dtype(self._kind).itemsize
        flat = np.frombuffer(b"".join(distinct), self._kind)
        starts = np.cumsum(sizes) - sizes
        each = sizes[which]
        ends = np.cumsum(each)
        ids = flat[np.repeat(starts[which] - (ends - each), each) + np.arange(ends[-1])]
        return np.concatenate([[0], ends])[np.searchsorted(borders, texts.bounds)], ids


def _encode_part(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"encoder {path}", lambda: PieceEncoder(path))
        part, sequence, before = TaskContext.get().partitionId(), 0, 0
        docs: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            body = encode(np.concatenate(lengths), np.concatenate(held))
            ids = pa.concat_arrays(docs)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([sequence], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([size], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([body], pa.binary())], ["part", "sequence", "part_start", "n_ids", "doc_ids", "segment"])

        for batch in batches:
            for texts in texts_of(batch.column("text"), SLICE_BYTES):
                bounds, ids = encoder(texts)
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                at = 0
                while at < texts.rows:  # whole documents, up to about SEGMENT_IDS ids
                    to = int(np.searchsorted(bounds, bounds[at] + SEGMENT_IDS - size))
                    to = min(max(to, at + 1), texts.rows)
                    docs.append(batch.column("doc_id").slice(texts.first + at, to - at))
                    lengths.append(np.diff(bounds[at:to + 1]))
                    held.append(ids[bounds[at]:bounds[to]].astype(np.uint32))
                    size += int(bounds[to] - bounds[at])
                    at = to
                    if size >= SEGMENT_IDS:
                        yield segment()
                        sequence, before, size, docs, lengths, held = sequence + 1, before + size, 0, [], [], []
        if docs:
            yield segment()
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> None:
    """Writes the ids of all texts, each followed by ``end_id``, in ascending order of ``doc_id``.

    Partitions: as many as the session shuffles into.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie))
    (ordered.mapInArrow(_encode_part(tokenizer, end_id), _SEGMENT_TYPE)
     .write.option("compression", "uncompressed").parquet(folder))


def _decode_segments(with_ids: bool):
    names = ["doc_id", "part", "in_part", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, before = batch.column("part")[row].as_py(), batch.column("part_start")[row].as_py()
                lengths, ids = decode(batch.column("segment")[row].as_py())
                ids = ids.astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                view = memoryview(ids).cast("B") if len(ids) else b""
                crcs = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [batch.column("doc_ids")[row].values, pa.array(np.full(len(lengths), part, np.int32)),
                           pa.array(before + starts), pa.array(lengths), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.append(starts, ends[-1:]).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and on request the ids themselves."""
    segments = spark.read.schema(_SEGMENT_TYPE).parquet(folder)
    kind = "doc_id long, part int, in_part long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = segments.select("part", "part_start", "doc_ids", "segment").mapInArrow(_decode_segments(with_ids), kind)
    # One row per written part: the numbers of ids before each part.
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    out = rows.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("in_part"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] * with_ids))


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the token file of ``docs`` to the shared folder and reads it back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end_id)
    return read_tokens(docs.sparkSession, folder)
