"""Simple-8b coding of token ids: 64-bit words with a 4-bit selector and 60 bits of equal fields.

Layout of one segment (all little-endian):

    magic "S8B1" | ids per block u32 | documents u64 | ids u64 | blocks u64 | words u64
    lengths of documents: u64 each | first word of each block, and the end: u64 each | words: u64 each

A block holds ``BLOCK`` ids (the last one the rest) and starts on a word of its own, so that any run of
blocks can be decoded without the words before it, and all words of one selector at once.
Selectors 1 to 14 pack 60 to 1 ids of 1 to 60 bits. Selector 0 is the escape: the word's low 60 bits hold 1
and the next word is one id of more than 60 bits as it is. Selector 15 packs 120 zeros.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
BLOCK = 1024
MAGIC = b"S8B1"
#: Ids per word and bits per id of the selectors 1 to 14.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ZEROS, ESCAPE, RUN = 15, 0, 120


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    width, rest = np.zeros(len(ids), np.uint8), ids
    while len(rest) and int(rest.max()) >> 16:
        big = rest > _U(0xFFFF)
        width += big.astype(np.uint8) * np.uint8(16)
        rest = np.where(big, rest >> _U(16), rest)
        if not int(rest.max()) >> 16:
            break
    small = np.zeros(1 << 16, np.uint8)
    for bits in range(16):
        small[1 << bits:] += np.uint8(1)
    return width + small[rest.astype(np.uint16)]


def _selectors(ids: np.ndarray) -> np.ndarray:
    """The selector of a word that would begin at each id: the one that takes most ids of its block."""
    n = len(ids)
    left = np.tile(np.arange(BLOCK, 0, -1, dtype=np.int16), n // BLOCK + 1)[:n]
    tail = n - n % BLOCK
    left[tail:] = np.arange(n - tail, 0, -1)
    chosen = np.zeros(n, np.uint8)
    widest, reach = _widths(ids), 1  # widest of the ids i .. i + reach - 1
    for selector, count in [*zip(range(14, 0, -1), COUNTS[::-1], strict=True), (ZEROS, RUN)]:
        while reach < min(count, n):
            step = min(reach, count - reach)
            np.maximum(widest[:-step], widest[step:], out=widest[:-step])
            reach += step
        fits = widest <= (0 if selector == ZEROS else BITS[selector - 1])
        if fits.any():
            fits &= left >= count
            chosen[fits] = selector
    return chosen


_TAKEN = np.array([1, *COUNTS, RUN], np.int64)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, index of the first word of each block and the end)."""
    ids = np.ascontiguousarray(ids, _U)
    if not len(ids):
        return np.zeros(0, _U), np.zeros(1, np.int64)
    chosen = _selectors(ids)
    taken = _TAKEN[chosen]
    # All blocks walk from word to word side by side.
    at = np.arange(0, len(ids), BLOCK)
    ends = np.minimum(at + BLOCK, len(ids))
    begins = np.zeros(len(ids), bool)
    while len(at):
        begins[at] = True
        at = at + taken[at]
        going = at < ends
        at, ends = at[going], ends[going]
    begins = np.flatnonzero(begins)
    selectors = chosen[begins]
    size = 1 + (selectors == ESCAPE)
    place = np.concatenate([[0], np.cumsum(size)])
    words = np.zeros(place[-1], _U)
    for selector in np.unique(selectors):
        mine = selectors == selector
        first, out = begins[mine], place[:-1][mine]
        if selector == ESCAPE:
            words[out] = 1
            words[out + 1] = ids[first]
            continue
        word = np.full(len(first), int(selector) << 60, _U)
        if selector != ZEROS:
            bits = BITS[selector - 1]
            for j in range(COUNTS[selector - 1]):
                word |= ids[first + j] << _U(j * bits)
        words[out] = word
    starts = place[np.searchsorted(begins, np.arange(0, len(ids), BLOCK))]
    return words, np.append(starts, place[-1])


def unpack(words: np.ndarray) -> np.ndarray:
    """Ids of any run of whole blocks."""
    if not len(words):
        return np.zeros(0, _U)
    selectors = (words >> _U(60)).astype(np.int64)
    # A word right after an escape is an id; escaped ids may look like escapes themselves.
    raw = np.zeros(len(words), bool)
    marks = np.flatnonzero((selectors == ESCAPE) & (words == _U(1)))
    if len(marks):
        run = np.concatenate([[True], np.diff(marks) > 1])
        first = marks[np.maximum.accumulate(np.where(run, np.arange(len(marks)), 0))]
        raw[marks[(marks - first) % 2 == 0] + 1] = True
    counts = np.where(raw, 0, _TAKEN[selectors])
    out = np.zeros(counts.sum(), _U)
    place = np.cumsum(counts) - counts
    for selector in range(1, 15):
        mine = np.flatnonzero((selectors == selector) & ~raw)
        if len(mine):
            bits = BITS[selector - 1]
            mask, word, at = _U((1 << bits) - 1), words[mine], place[mine]
            for j in range(COUNTS[selector - 1]):
                out[at + j] = (word >> _U(j * bits)) & mask
    escapes = np.flatnonzero((selectors == ESCAPE) & ~raw)
    out[place[escapes]] = words[escapes + 1]
    return out


def encode(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment from the ids of consecutive documents."""
    words, starts = pack(ids)
    head = np.array([len(lengths), len(ids), len(starts) - 1, len(words)], "<u8")
    return b"".join([MAGIC, np.array([BLOCK], "<u4").tobytes(), head.tobytes(), np.asarray(lengths, "<u8").tobytes(),
                     starts.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def _parts(segment: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    if segment[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    block = int(np.frombuffer(segment, "<u4", 1, 4)[0])
    documents, ids, blocks, words = (int(x) for x in np.frombuffer(segment, "<u8", 4, 8))
    lengths = np.frombuffer(segment, "<u8", documents, 40)
    starts = np.frombuffer(segment, "<u8", blocks + 1, 40 + 8 * documents)
    return block, ids, lengths, starts, np.frombuffer(segment, "<u8", words, 40 + 8 * (documents + blocks + 1))


def decode(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lengths of the documents, all ids)."""
    _, _, lengths, _, words = _parts(segment)
    return lengths.astype(np.int64), unpack(words)


def decode_range(segment: bytes, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a segment; only the blocks that hold them are decoded."""
    block, ids, _, starts, words = _parts(segment)
    start, end = max(start, 0), min(end, ids)
    if start >= end:
        return np.zeros(0, _U)
    first, last = start // block, (end - 1) // block
    got = unpack(words[int(starts[first]):int(starts[last + 1])])
    return got[start - first * block:end - first * block]
