"""Vectorised text primitives for Arrow batches (used inside Spark tasks).

An Arrow string column is one byte buffer plus offsets.  Everything here
works on slices of that buffer of about ``BLOCK`` bytes, so a task needs
memory for one block (or one document, where that is longer), never for a
partition.  Hashes are polynomial (Rabin-Karp) over ``uint64`` wrap-around
arithmetic and end in a 64-bit finaliser.
"""

from __future__ import annotations

import ctypes
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
U64 = np.uint64
MAX_ID = 2**63 - 1  # stands for a null doc_id: after every other id

# Two odd bases; hashes under both make one 128-bit hash.
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)

#: white space of the word rule ``[^\x20\x09-\x0D]+``
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: word characters of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
#: lower-cases A-Z, leaves every other byte (so UTF-8 stays valid)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@lru_cache(maxsize=None)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    inv = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inv):
        p = np.ones(n, U64)
        size = 1
        while size < n:
            p[size:2 * size] = p[:size] * U64(pow(b, size, 1 << 64))
            size *= 2
        out.append(p)
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers (at least) of the base and of its inverse mod 2^64."""
    return _powers(base, max(16, int(n).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply), in place."""
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def give_back() -> None:
    """Freed memory goes back to the system: Spark uses a Python worker again
    for other stages, and it would keep what its largest task once needed."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidied(job):
    """The same job over Arrow batches, giving memory back at its end."""

    def run(batches):
        yield from job(batches)
        give_back()

    return run


def tidied_group(job):
    """The same job over one group's table, giving memory back at its end."""

    def run(table):
        out = job(table)
        give_back()
        return out

    return run


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col, "") if col.null_count else col


def ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The id column as int64; null becomes ``MAX_ID``."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.int64())
    return np.asarray(pc.fill_null(col, MAX_ID) if col.null_count else col, dtype=np.int64)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1 rows) of a string or binary column without nulls."""
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64 if big else np.int32)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offs.astype(np.int64)


def blocks(col: pa.Array, size: int = BLOCK):
    """Yield (first row, end row, bytes, offsets from 0) of about ``size`` bytes."""
    if not len(col):
        return
    buf, offs = buffers(col)
    i, n = 0, len(col)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + size, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(buf: np.ndarray, offs: np.ndarray, table: np.ndarray):
    """(starts, ends, first word of each row and the total) of maximal runs of
    table bytes; a run never crosses a row."""
    inside = table[buf]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cut = offs[1:-1]
    cut = cut[cut < len(buf)]
    start[cut] = inside[cut]
    cut = cut[cut > 0]
    end[cut - 1] = inside[cut - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of the bytes of each span."""
    pw, inv = powers(base, len(buf) + 1)
    acc = np.zeros(len(buf) + 1, U64)
    np.cumsum((buf.astype(U64) + U64(1)) * inv[:len(buf)], out=acc[1:])
    h = (acc[ends] - acc[starts]) * pw[starts]
    h += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def rolling(seq: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Rabin-Karp hash of every ``k`` consecutive values (length n - k + 1)."""
    n = len(seq)
    if n < k:
        return np.zeros(0, U64)
    pw, inv = powers(base, n + 1)
    acc = np.zeros(n + 1, U64)
    np.cumsum(seq * inv[:n], out=acc[1:])
    return mix((acc[k:] - acc[:-k]) * pw[:n - k + 1])


def range_hash(seq: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``seq[start:end]`` for each range."""
    pw, inv = powers(base, len(seq) + 1)
    acc = np.zeros(len(seq) + 1, U64)
    np.cumsum(seq * inv[:len(seq)], out=acc[1:])
    h = (acc[ends] - acc[starts]) * pw[starts]
    h += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def shingles(words: np.ndarray, first: np.ndarray, k: int):
    """Hashes of every run of ``k`` words inside a row, as (hashes, first of
    each row and the total).  A row of 1..k-1 words gives its whole sequence
    as one shingle, a row without words gives none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=begin[1:])
    if not begin[-1]:
        return np.zeros(0, U64), begin
    pos = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], count)
    full = rolling(words, k, BASES[1])
    out = full[np.minimum(pos, max(len(full) - 1, 0))] if len(full) else np.zeros(len(pos), U64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        out[begin[short]] = range_hash(words, first[short], first[short + 1], BASES[0])
    return out, begin


def unique_rows(values: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct values of each row."""
    return [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:])]


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (doubling; n - w + 1 long)."""
    if len(a) < w:
        return a[:0]
    size, m = 1, a
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = w - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m
