"""Word and shingle hashes of whole texts, over the bytes of a column batch at once.

Words are cut at separator bytes, letters A-Z are folded, and every run of ``width``
words becomes one 64-bit number. All of it is array arithmetic on the UTF-8 bytes that
Arrow hands over; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64); one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """n odd pseudo-random numbers, the same on every machine."""
    step = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    return mix(step + np.full(n, seed, U64) * U64(0xD1B54A32D192ED03)) | U64(1)


@dataclass(frozen=True)
class Alphabet:
    """separator: the bytes between words; fold: what each byte counts as.

    With ``characters``, each character of a script without spaces is a word.
    """

    separator: np.ndarray
    fold: np.ndarray
    characters: bool = False


def alphabet(separators: bytes, characters: bool = False) -> Alphabet:
    separator = np.zeros(256, dtype=bool)
    separator[list(separators)] = True
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return Alphabet(separator, fold, characters)


#: Words are runs of anything but white space.
SPACED = alphabet(b" \t\n\x0b\x0c\r")

#: Code points written without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = np.array(
    [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FA), (0x30FC, 0x31FF),
     (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
)
#: Punctuation and spaces beside them.
_BETWEEN = np.array(
    [(0x2000, 0x200A), (0x2010, 0x2027), (0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F),
     (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]
)


def _within(code: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ranges[:, 0], code, "right") - 1
    return (at >= 0) & (code <= ranges[np.maximum(at, 0), 1])


def unspaced(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte and length of characters that are words, and of characters between words."""
    lead = np.flatnonzero(raw >= 0xE0)
    long = raw[lead] >= 0xF0
    lead = lead[lead + 2 + long < len(raw)]
    long = raw[lead] >= 0xF0
    byte = [raw[np.minimum(lead + k, len(raw) - 1)].astype(np.int64) for k in range(4)]
    code = ((byte[0] & 15) << 12) | ((byte[1] & 63) << 6) | (byte[2] & 63)
    code[long] = (((byte[0] & 7) << 18) | ((byte[1] & 63) << 12) | ((byte[2] & 63) << 6) | (byte[3] & 63))[long]
    alone, between = _within(code, _UNSPACED), _within(code, _BETWEEN)
    size = 3 + long
    return lead[alone], size[alone], lead[between], size[between]


_BYTE = numbers(1, 256)
_PLACE = numbers(2, 64)
_SHORT = numbers(3, 64)


@dataclass
class Chunk:
    """Words of some consecutive texts: text i has words first[i] to first[i + 1]."""

    row: int
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray
    raw: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each text's bounds; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, bounds


def word_hashes(data: np.ndarray, start: np.ndarray, separator: np.ndarray) -> np.ndarray:
    """One number per word: a polynomial in its (folded) bytes, spread."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    value = _BYTE[data]
    value[separator] = 0
    place = np.arange(len(data), dtype=np.int64)
    place[start[0] :] -= np.repeat(start, np.diff(np.append(start, len(data))))
    place[separator] = 0
    place[: start[0]] = 0
    power = np.full(int(place.max()) + 1, U64(0x9E3779B97F4A7C55), dtype=U64)
    power[0] = 1
    value *= np.cumprod(power)[place]
    return mix(np.add.reduceat(value, start))


def chunks(column: pa.Array, letters: Alphabet = SPACED) -> Iterator[Chunk]:
    """The words of every text, some texts at a time."""
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, row + 1), rows)
        low, high = int(bounds[row]), int(bounds[last])
        raw = data[low:high]
        part = letters.fold[raw]
        separator = letters.separator[part]
        if letters.characters:
            alone, size, between, gap = unspaced(raw)
            for k in range(4):
                separator[between[gap > k] + k] = True
        inside = ~separator
        begins = inside.copy()
        begins[1:] &= separator[:-1]
        ends = inside.copy()
        ends[:-1] &= separator[1:]
        # A text's first byte begins a word even if the text before ends in one.
        edges = bounds[row + 1 : last] - low
        edges = edges[(edges > 0) & (edges < high - low)]
        begins[edges] |= inside[edges]
        ends[edges - 1] |= inside[edges - 1]
        if letters.characters:
            begins[alone] = ends[alone + size - 1] = True
            after, before = (alone + size)[alone + size < len(raw)], alone[alone > 0] - 1
            begins[after] |= inside[after]
            ends[before] |= inside[before]
        start = np.flatnonzero(begins)
        end = np.flatnonzero(ends) + 1
        first = np.searchsorted(start, bounds[row : last + 1] - low)
        yield Chunk(row, first, start, end, word_hashes(part, start, separator), raw)
        row = last


def windows(word: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` words, wherever texts end."""
    n = len(word) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    total = np.zeros(n, dtype=U64)
    for k in range(width):
        total += word[k : k + n] * _PLACE[k]
    return mix(total)


def shingle_sets(chunk: Chunk, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its distinct shingles in order) for every text of the chunk.

    A text with fewer words than ``width`` has one shingle, all of its words; a text
    without words has none.
    """
    run = windows(chunk.word, width)
    first = chunk.first
    for i in range(len(first) - 1):
        low, high = int(first[i]), int(first[i + 1])
        if high - low >= width:
            found = np.unique(run[low : high - width + 1])
        elif high > low:
            words = chunk.word[low:high] * _PLACE[: high - low]
            found = mix(words.sum(dtype=U64, keepdims=True) ^ _SHORT[high - low])
        else:
            found = np.zeros(0, dtype=U64)
        yield chunk.row + i, found
