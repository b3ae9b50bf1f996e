"""Whole texts as one byte buffer per Arrow batch, and word hashes over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ASCII whitespace of the contracts: space and 0x09-0x0D (as bytes.split takes it)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII upper to lower case, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

MULT = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x100000001B3)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null is an empty text."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def texts(col: pa.Array) -> list[bytes]:
    """Each text as UTF-8 bytes; a null is an empty text."""
    raw, off = buffers(col)
    whole = raw.tobytes()
    return [whole[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``most_bytes`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = buffers(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(off, off[start] + most_bytes, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0..n-1, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 1 << 16), BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers[:n]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word never crosses the end of its text."""
    if len(raw) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[raw]
    inner = off[(off > 0) & (off < len(raw))]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[inner] = word[inner]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[inner - 1] = word[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


#: a random number for each byte at each of the first places of a word
_PLACES = 32
_AT_PLACE = mix(np.arange(1, 256 * _PLACES + 1, dtype=np.uint64) * MULT).reshape(_PLACES, 256)[:, LOWER].ravel()


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of lower-cased words (A-Z only), none of them empty.

    The sum of one random number for each byte and its place (tabulation): unlike a
    polynomial modulo 2^64, no two words collide by their structure.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = ends - starts
    first = np.cumsum(n) - n
    at = np.arange(int(n.sum()), dtype=np.int32)
    place = at - np.repeat(first.astype(np.int32), n)
    byte = raw[at + np.repeat((starts - first).astype(np.int32), n)]
    value = _AT_PLACE[np.minimum(place, _PLACES - 1) * 256 + byte]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        value[far] = mix((place[far].astype(np.uint64) << np.uint64(8)) + LOWER[byte[far]] + np.uint64(1 << 60))
    return mix(np.add.reduceat(value, first) + n.astype(np.uint64) * MULT)


_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        p = np.full(max(n, 1 << 16), np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64)
        p[0] = 1
        _inverse = np.multiply.accumulate(p)
    return _inverse[:n]
