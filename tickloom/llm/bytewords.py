"""Words of whole texts as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
PIECE_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    """Words in order: row of the text, first and end byte, 64-bit hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def scrambled(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Alphabet:
    """Which bytes make words, and the code of each; with ``fold`` A-Z count as a-z."""

    def __init__(self, word_bytes: np.ndarray, fold: bool = True) -> None:
        self.word = word_bytes
        letter = np.arange(256)
        if fold:
            letter[65:91] += 32
        self.fold = letter.astype(np.uint8)
        codes = scrambled((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)[letter]
        self.code = np.where(word_bytes, codes, np.uint64(0))


def _bytes_but(*ranges: tuple[int, int]) -> np.ndarray:
    kept = np.ones(256, bool)
    for low, high in ranges:
        kept[low : high + 1] = False
    return kept


# [^\x20\x09-\x0D]+ and, after A-Z became a-z, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
BETWEEN_BLANKS = Alphabet(_bytes_but((0x20, 0x20), (0x09, 0x0D)))
LETTERS_DIGITS = Alphabet(_bytes_but((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)))
ASCII_LETTERS_DIGITS = Alphabet(_bytes_but((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0xFF)))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each, plus the end; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def carried(batch: pa.RecordBatch, column: str) -> pa.Array:
    """Texts of a column, or of a field ``row.name`` of a struct."""
    head, _, field = column.partition(".")
    return batch.column(head).field(field) if field else batch.column(head)


def sliced(batches: Iterator[pa.RecordBatch], column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each stay within ``budget`` bytes, but for
    a single longer text."""
    for batch in batches:
        _, offsets = text_buffers(carried(batch, column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + budget, "right")) - 1
            end = max(at + 1, end)
            yield batch.slice(at, end - at)
            at = end


def words_of(texts: pa.Array, alphabet: Alphabet) -> Words:
    data, bounds = text_buffers(texts)
    return words_in(data, bounds, alphabet)


def words_in(data: np.ndarray, bounds: np.ndarray, alphabet: Alphabet) -> Words:
    """Words of texts that lie end to end; long buffers go piece by piece."""
    starts, ends, hashes = [], [], []
    for low, high in _pieces(data, alphabet.word):
        inner = bounds[np.searchsorted(bounds, low, "right") : np.searchsorted(bounds, high, "left")]
        start, end, hashed = _piece_words(data[low:high], inner - low, alphabet)
        starts.append(start + low)
        ends.append(end + low)
        hashes.append(hashed)
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64))
    start = np.concatenate(starts)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(start, bounds)))
    return Words(row, start, np.concatenate(ends), np.concatenate(hashes))


def _pieces(data: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(data):
        high = min(low + PIECE_BYTES, len(data))
        while high < len(data):  # on to the next byte outside words
            gap = np.flatnonzero(~word[data[high : high + PIECE_BYTES]])
            if len(gap):
                high += int(gap[0])
                break
            high = min(high + PIECE_BYTES, len(data))
        yield low, high
        low = high


def _piece_words(data: np.ndarray, borders: np.ndarray, alphabet: Alphabet):
    inside = alphabet.word[data]
    before = np.concatenate(([False], inside[:-1]))
    before[borders] = False
    after = np.concatenate((inside[1:], [False]))
    after[borders - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    longest = int((end - start).max())
    first = int(start[0])
    place = np.arange(first, len(data), dtype=np.int32)
    place -= np.repeat(start.astype(np.int32), np.diff(np.append(start, len(data))))
    np.minimum(place, longest, out=place)
    powers = np.full(longest + 1, _POWER)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    terms = alphabet.code[data[first:]]
    terms *= powers[place]
    return start, end, scrambled(np.add.reduceat(terms, start - first) + (end - start).astype(np.uint64))


def window_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``n`` words within a text."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(words.row[:count] == words.row[n - 1 :])
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total *= _POWER
        total += words.hash[k : k + count]
    return first, scrambled(total[first] + np.uint64(n))


def folded(data: np.ndarray, alphabet: Alphabet) -> bytes:
    """The bytes with A-Z as a-z and a blank for every byte outside words."""
    return np.where(alphabet.word[data], alphabet.fold[data], np.uint8(32)).tobytes()
