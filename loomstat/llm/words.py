"""Words and their hashes straight from Arrow text buffers, as numpy arrays.

A batch is worked through in pieces of bounded size: whole documents while they fit, and a document
longer than a piece is cut between two words. Memory follows the piece, not the longest text (only a
single word longer than a piece makes the piece longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
SLICE_BYTES = 4 << 20
RUN_WORDS = 1 << 16
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd base of the polynomial hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_LONG = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE_BYTES, 1 << (n - 1).bit_length())
    if size not in _powers:
        if size > PIECE_BYTES:  # a giant word: keep only the usual table afterwards
            return tuple(np.cumprod(np.full(size, b, np.uint64)) for b in (BASE, INVERSE))
        _powers[size] = tuple(np.cumprod(np.full(size, b, np.uint64)) for b in (BASE, INVERSE))
    return _powers[size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a text column; a null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        ends = np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of at most ``size`` that end with a document or else between two words."""
    start, total = 0, len(data)
    while start < total:
        end = min(start + size, total)
        if end < total:
            fits = offsets[np.searchsorted(offsets, end, "right") - 1]
            if fits > start:
                end = int(fits)
            else:
                doc_end = int(offsets[np.searchsorted(offsets, start, "right")])
                end = min(end, doc_end)
                spaces = np.flatnonzero(IS_SPACE[data[start:end]])
                if end < doc_end and len(spaces):
                    end = start + int(spaces[-1]) + 1
                else:
                    while end < doc_end and not IS_SPACE[data[end]]:
                        end += 1
        yield start, end
        start = end


def spans(data: np.ndarray, offsets: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word of a piece, counted from the piece's start."""
    word = ~IS_SPACE[data[start:end]]
    before = np.empty(len(word) + 1, bool)
    before[0] = before[-1] = True
    before[1:-1] = ~word[:-1]
    after = np.empty(len(word), bool)
    after[:-1] = ~word[1:]
    after[-1:] = True
    cuts = offsets[np.searchsorted(offsets, start, "left") : np.searchsorted(offsets, end, "right")] - start
    before[cuts] = True
    after[cuts[cuts > 0] - 1] = True
    return np.flatnonzero(word & before[:-1]), np.flatnonzero(word & after) + 1


def range_hashes(part: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the bytes ``part[first:last]``, wherever they stand."""
    power, inverse = _power_tables(len(part))
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
    return mixed((sums[last] - sums[first]) * inverse[first])


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a text column, and where each document's words begin.

    Words are the runs without the bytes 20 and 09-0D; ``lower`` maps A-Z to a-z first.
    """
    data, offsets = text_buffer(column)
    found, counts = [np.zeros(0, np.uint64)], np.zeros(len(offsets), np.int64)
    for start, end in pieces(data, offsets):
        first, last = spans(data, offsets, start, end)
        part = data[start:end]
        if lower:
            part = LOWER[part]
        found.append(range_hashes(part, first, last))
        counts += np.searchsorted(first + start, offsets, "left") - np.searchsorted(first + start, 0, "left")
    return np.concatenate(found), counts


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a document, and where each document's begin.

    A document of fewer words, but at least one, has one shingle: all its words.
    """
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begins[-1]) + np.repeat(first[:-1] - begins[:-1], count)
    have = np.repeat(np.minimum(n, size), count)
    out = np.full(len(at), 0x51ED270B, np.uint64) * (have.astype(np.uint64) + np.uint64(1))
    for k in range(size):
        inside = k < have
        step = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else np.zeros(0, np.uint64)
        out = np.where(inside, mixed(out * np.uint64(BASE) + step), out)
    return out, begins


def run_hash(words: np.ndarray) -> int:
    """The hash that ``shingle_hashes`` gives a single run of all these words.

    Every step needs the one before. A numpy call for one number costs some fifty such steps, so they are
    done on Python's whole numbers, from a bounded piece of the words at a time.
    """
    h = (0x51ED270B * (len(words) + 1)) & _LONG
    for start in range(0, len(words), RUN_WORDS):
        for word in words[start : start + RUN_WORDS].tolist():
            h = (h * BASE + word) & _LONG
            h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & _LONG
            h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & _LONG
            h ^= h >> 31
    return h


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about 4 MB of text, or of lists of longs, one row at least."""
    lengths = pc.multiply(pc.list_value_length(column), 8) if pa.types.is_list(column.type) else pc.binary_length(column)
    lengths = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
    sizes = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + SLICE_BYTES, "right")) - 1)
        yield at, to
        at = to
