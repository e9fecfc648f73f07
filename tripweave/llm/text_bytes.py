"""Texts of an Arrow column as bytes: bounded slices, words, and hashes of words, by numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row groups of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        start, total = 0, np.cumsum(lengths)
        while start < batch.num_rows:
            before = int(total[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def release() -> None:
    """Hand freed memory back to the system: worker processes live on and serve other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts(part: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in part.column(column).to_pylist()]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins (one more than rows; null: empty)."""
    column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    if data is None or where[-1] == where[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[where[0]:where[-1]], where - where[0]


def word_spans(data: np.ndarray, where: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte and row of every word, in order: runs of bytes outside ``blank``
    (by default words ``[^\\x20\\x09-\\x0D]+``)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~blank[data]
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = ~inside[:-1]
    first[where] = True  # a row's first byte begins a word of its own
    starts = np.flatnonzero(inside & first[:-1])
    last = np.ones(len(data), bool)
    last[:-1] = ~inside[1:]
    last[where[(where > 0)] - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(where, starts, side="right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]), dtype=np.uint64)
                      for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each word among the distinct ones (by their bytes), the distinct words' 64-bit hashes, and all
    words as one buffer, each followed by a space, with their offsets there."""
    touching = np.append(starts[1:] == ends[:-1], ends[-1:] == len(data))[:len(starts)]
    if touching.any():  # a row's last word, without a byte between it and the next row's first
        shift = np.cumsum(touching)
        data = np.insert(data, ends[touching], 0x20)
        starts, ends = starts + shift - touching, ends + shift - touching
    kept = np.zeros(len(data) + 1, np.int8)
    kept[starts] = 1
    np.subtract.at(kept, ends + 1, 1)  # with the byte behind each word
    spaced = data[np.cumsum(kept[:-1], dtype=np.int8).view(bool)]
    offsets = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    spaced[offsets[1:] - 1] = 0x20
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(spaced)])
    coded = words.dictionary_encode()
    distinct, at = raw_binary(coded.dictionary)
    return np.asarray(coded.indices), word_hashes(distinct, at[:-1], at[1:] - 1), spaced, offsets


def raw_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), where


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words with A-Z lower-cased, from one prefix sum over the bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[_LOWER[data]] * up[:len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word shingles of each row, flat, with the rows' offsets.

    A row of 1 to ``size - 1`` words has its whole sequence as one shingle; none has none. The
    column is worked through in slices, as the hashing holds some 50 bytes per byte of text, and a text
    longer than a slice in pieces, which leaves 40 bytes or so per word of it.
    """
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    most = SLICE_BYTES // 4
    parts = []
    for part in slices([batch], "text", most):
        if part.num_rows == 1 and (pc.binary_length(part.column("text"))[0].as_py() or 0) > most:
            flat = _long_shingle_set(part.column("text"), size, most)
            parts.append((flat, np.array([0, len(flat)], np.int64)))
        else:
            parts.append(_shingle_sets(part.column("text"), size))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    sizes = np.concatenate([np.diff(where) for _, where in parts])
    return np.concatenate([flat for flat, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, where = raw(column)
    starts, ends, row = word_spans(data, where)
    words = word_hashes(data, starts, ends)
    n_rows = len(where) - 1
    n_words = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(n_words)])
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = mixed(rolled * _BASE + words[k:n + k])
    sets = []
    for r in range(n_rows):
        count = int(n_words[r])
        if count >= size:
            sets.append(np.unique(rolled[first[r]:first[r] + count - size + 1]))
        elif count:
            h = np.zeros(1, np.uint64)
            for word in words[first[r]:first[r] + count]:
                h = mixed(h * _BASE + word)
            sets.append(mixed(h + np.uint64(count)))
        else:
            sets.append(np.zeros(0, np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), offsets


def _long_word_hash(word: np.ndarray, piece: int) -> np.uint64:
    """``word_hashes`` of one word, summed piece by piece."""
    up, _ = _power_tables(piece + 1)
    total = 0
    for at in range(0, len(word), piece):
        part = word[at:at + piece]
        step = int(np.sum(_BYTE_VALUES[_LOWER[part]] * up[:len(part)], dtype=np.uint64))
        total += step * pow(int(_BASE), at, 1 << 64)
    return mixed(np.array([(total + len(word)) % (1 << 64)], np.uint64))[0]


def _all_word_hashes(data: np.ndarray, piece: int) -> Iterator[np.ndarray]:
    """Hashes of the words of one text, in order, with pieces that end behind a blank."""
    start = 0
    while start < len(data):
        stop = min(start + piece, len(data))
        blanks = np.flatnonzero(_SPACE[data[start:stop]])
        if stop == len(data) or len(blanks):
            if stop < len(data):
                stop = start + int(blanks[-1]) + 1
            part = data[start:stop]
            first, last, _ = word_spans(part, np.array([0, len(part)], np.int64))
            yield word_hashes(part, first, last)
        else:  # a word longer than a piece: it begins here, as pieces end behind a blank
            while stop < len(data):
                blanks = np.flatnonzero(_SPACE[data[stop:stop + piece]])
                if len(blanks):
                    stop += int(blanks[0])
                    break
                stop = min(stop + piece, len(data))
            yield np.array([_long_word_hash(data[start:stop], piece)], np.uint64)
        start = stop


def _long_shingle_set(column: pa.Array, size: int, piece: int) -> np.ndarray:
    """The set of ``_shingle_sets`` for one long text."""
    words = np.concatenate([np.zeros(0, np.uint64), *_all_word_hashes(raw(column)[0], piece)])
    if len(words) < size:
        h = np.zeros(1, np.uint64)
        for word in words:
            h = mixed(h * _BASE + word)
        return mixed(h + np.uint64(len(words))) if len(words) else words
    found = np.zeros(0, np.uint64)
    parts, held = [], 0
    for at in range(0, len(words) - size + 1, piece):
        here = words[at:at + piece + size - 1]
        rolled = np.zeros(len(here) - size + 1, np.uint64)
        for k in range(size):
            rolled = mixed(rolled * _BASE + here[k:len(rolled) + k])
        parts.append(np.unique(rolled))
        held += len(parts[-1])
        if held > len(found) + 8 * piece:
            found, parts, held = np.unique(np.concatenate([found, *parts])), [], 0
    return np.unique(np.concatenate([found, *parts]))
