"""Periodic runs of words, by recursive frequency splitting and lag scans.

A *run* is a stretch of consecutive words with smallest period q and at least
``max(6, 4 q)`` words that no neighbouring word extends keeping period q.

A word inside a run stands in it four times at least.  So a word that stands
less often in the current segment is in no run there and splits it; the parts
are split again by their own counts until every word of a segment is frequent
enough in it.  In ordinary text nothing survives; what does is scanned lag by
lag.  For lag q the segment is cut into blocks of q words: a run of period q
holds three whole blocks, which are equal, so comparing neighbouring blocks
(prefix hashes, exact check afterwards) costs n / q, and all lags together
n log n.

Work is per document, in the tasks that read it: nothing is shuffled, and a
task needs memory for one document.
"""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textblock as tb
from .common import documents

EXPONENT = 4
MIN_WORDS = 6
U64 = np.uint64
BASE = tb.BASES[0]
SCHEMA = ("doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, "
          "exponent_milli bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def surviving_segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of at least ``MIN_WORDS`` words in which
    every word stands ``EXPONENT`` times or more, split to stability."""
    out, todo = [], [(0, len(codes))]
    while todo:
        begin, end = todo.pop()
        if end - begin < MIN_WORDS:
            continue
        _, part, count = np.unique(codes[begin:end], return_inverse=True, return_counts=True)
        often = count >= EXPONENT
        if often.all():
            out.append((begin, end))
        elif often.any():
            edges = np.flatnonzero(np.diff(np.concatenate(([False], often[part], [False])).view(np.int8)))
            todo += [(begin + int(a), begin + int(b)) for a, b in edges.reshape(-1, 2) if b - a >= MIN_WORDS]
    return sorted(out)


def _equal_before(x: np.ndarray, i: int, q: int) -> int:
    """How many words before ``i`` equal the one ``q`` further on, in a row."""
    low, step = i, 64
    while low > 0:
        a = max(0, low - step)
        bad = np.flatnonzero(x[a:low] != x[a + q:low + q])
        if len(bad):
            return i - (a + int(bad[-1]) + 1)
        low, step = a, 4 * step
    return i


def _equal_after(x: np.ndarray, i: int, q: int) -> int:
    """First index from ``i`` on whose word differs from the one ``q`` before."""
    step = 64
    while i < len(x):
        b = min(len(x), i + step)
        bad = np.flatnonzero(x[i:b] != x[i - q:b - q])
        if len(bad):
            return i + int(bad[0])
        i, step = b, 4 * step
    return i


def lag_scan(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a segment's word codes.

    Lags rise, so a stretch that a shorter period explains is already covered:
    two periods of one stretch of three blocks have their common divisor as a
    period too."""
    n, runs = len(x), []
    values = tb.mix(x.astype(U64) + U64(0x9E3779B97F4A7C15))
    power = tb.powers(BASE, n + 1)[0]
    acc = np.zeros(n + 1, U64)
    np.cumsum(values * power[:n], out=acc[1:])
    reach = np.zeros(n + 1, np.int64)  # end of the furthest run that covers a place
    for q in range(1, n // EXPONENT + 1):
        block = np.diff(acc[::q])
        same = block[:-1] * power[q] == block[1:]
        for k in np.flatnonzero(same[:-1] & same[1:]):
            i = int(k) * q
            if reach[i] >= i + 3 * q or not np.array_equal(x[i:i + 2 * q], x[i + q:i + 3 * q]):
                continue
            start, end = i - _equal_before(x, i, q), _equal_after(x, i + 3 * q, q)
            if end - start >= max(MIN_WORDS, EXPONENT * q):
                runs.append((start, end - start, q))
                np.maximum(reach[start:end], end, out=reach[start:end])
    return runs


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """Every run of a list of words, by start and then period."""
    if len(words) < MIN_WORDS:
        return []
    code: dict = {}
    codes = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
    return sorted((begin + s, length, q) for begin, end in surviving_segments(codes)
                  for s, length, q in lag_scan(codes[begin:end]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside every run's part after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def planted(words: list, doc_id: int | None) -> list:
    """Every tenth document (by crc32 of its id) with a periodic tail: word
    i >= a becomes word a + (i - a) % p.  A null id changes nothing."""
    n = len(words)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def runs_digest(runs) -> str:
    return hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()


def _judged(change):
    def job(batches):
        for batch in batches:
            id_col = batch.column(0)
            for i, j, buf, offs in tb.blocks(tb.column(batch, "text")):
                raw, ids = buf.tobytes(), id_col.slice(i, j - i).to_pylist()
                rows = []
                for d, a, b in zip(ids, offs[:-1], offs[1:]):
                    words = raw[a:b].split()  # bytes: splits at the six ASCII blanks alone
                    if change:
                        words = change(words, d)
                    runs = find_runs(words)
                    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
                    rows.append((d, len(words), len(runs), *best, best[1] and 1000 * best[1] // best[2],
                                 [{"start": s, "length": m, "period": q} for s, m, q in runs],
                                 b" ".join(collapse(words, runs)).decode()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)

    return job


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
TYPES = [pa.int64()] * 7 + [pa.list_(RUN), pa.string()]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None) -> DataFrame:
    """One row per document row: doc_id, n_words, n_runs; start, length,
    period and exponent_milli of the longest run (ties: smallest start, then
    period; null without runs); runs; collapsed (the words outside the
    repeated part of every run, joined by spaces).

    Words are ``[^\\x20\\x09-\\x0D]+``.  ``change(words, doc_id)`` may replace a
    document's words first.  Null and empty texts have no words and no runs;
    rows of a repeated or null id are judged each on their own.
    """
    docs = documents(docs, id_col, text_col)
    return docs.mapInArrow(_judged(change), SCHEMA)
