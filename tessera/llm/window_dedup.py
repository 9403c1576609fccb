"""Repeated word windows removed, by Rabin-Karp hashes counted in Spark.

A window is ``WINDOW`` consecutive words.  Its Rabin-Karp hash is taken from
prefix sums of word hashes, under two bases (128 bits).  A word goes if a
window covering it also starts in a document of smaller doc_id.

Shipping one row per window would move several times the corpus, so windows
are counted in *stretches*: consecutive windows whose smallest ``GRAM``-word
hash is the same occurrence (the stretch's anchor).  Equal windows have equal
anchors, and a stretch has one Rabin-Karp hash for all its words.

1. Anchors whose gram is in one document only hold no repeated window.
2. Among the rest, equal stretches are counted: their smallest document keeps
   the words, all others lose every word of the stretch.
3. Where one gram has several different stretches, the windows of each
   stretch's first document are hashed one by one and counted, so windows
   shared by different stretches are found too.
4. Removed windows merge into maximal intervals per document.

Every aggregate combines on the map side; joins against its result leave the
hot side splittable.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import MAX_ID, documents, shuffle_partitions, small_side, stored
from .suffix_dedup import CHUNK, POS_BITS, SPANS, merge_gaps, of_document, text_hashes, with_text_hashes

WINDOW = 50
GRAM = 10


def _words(col: pa.Array):
    """Yield (first row, end row, bytes, offsets, starts, ends, first word per row, hashes)."""
    for i, j, buf, offs in tb.blocks(col):
        s, e, first = tb.word_spans(buf, offs, tb.SPACE_WORD)
        yield i, j, buf, offs, s, e, first, tb.span_hash(buf, s, e)


def stretches(words: np.ndarray, first: np.ndarray, window: int, gram: int):
    """(row, first window, last window, gram hash) of word-hash rows."""
    out = []
    for c in range(0, max(len(words) - window + 1, 0), CHUNK):
        h = tb.rolling(words[c:c + CHUNK + window - 1], gram)
        key = ((h >> POS_BITS) << POS_BITS) | np.arange(len(h), dtype=np.uint64)
        at = (tb.sliding_min(key, window - gram + 1) & np.uint64((1 << int(POS_BITS)) - 1)).astype(np.int64)
        start = np.arange(len(at)) + c
        row = np.searchsorted(first, start, "right") - 1
        ok = start + window <= first[row + 1]
        start, at, row = start[ok], at[ok], row[ok]
        if len(start):
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
            out.append((row[new], start[new], start[np.append(new[1:], len(start)) - 1], h[at[new]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def _stretch_table(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, (k, k2) = tb.ids(batch, "doc_id"), text_hashes(batch)
            for i, j, _, _, _, _, first, h in _words(tb.column(batch, "text")):
                row, a, b, g = stretches(h, first, window, gram)
                lo, hi = (tb.range_hash(h, a, b + window, base).view(np.int64) for base in tb.BASES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (g.view(np.int64), lo, hi, ids[i:j][row], k[i:j][row], k2[i:j][row],
                                           a - first[row], b - first[row])],
                    ["gram", "lo", "hi", "d", "k", "k2", "a", "b"])

    return docs.select("doc_id", "text", "k", "k2").mapInArrow(
        run, "gram bigint, lo bigint, hi bigint, d bigint, k bigint, k2 bigint, a bigint, b bigint")


def _windows(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(lo, hi, d, k, k2, a): Rabin-Karp hash of every wanted window.
    ``wanted(d, k, k2, spans)``: packed ranges of window starts."""
    def run(batches):
        for batch in batches:
            ids, (k, k2), spans = tb.ids(batch, "doc_id"), text_hashes(batch), batch.column(4)
            for i, j, _, _, _, _, first, h in _words(tb.column(batch, "text")):
                lo, hi = (tb.rolling(h, window, base) for base in tb.BASES)
                at, row = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for r in range(j - i):
                    for a, b in np.frombuffer(spans[i + r].as_py(), "<i8").reshape(-1, 2).tolist():
                        at.append(np.arange(a, b) + first[r])
                        row.append(np.full(b - a, r))
                at, row = np.concatenate(at), np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (lo[at].view(np.int64), hi[at].view(np.int64), ids[i:j][row],
                                           k[i:j][row], k2[i:j][row], at - first[row])],
                    ["lo", "hi", "d", "k", "k2", "a"])

    held = docs.join(wanted, of_document(docs, wanted)).select("doc_id", "text", docs["k"], docs["k2"], "spans")
    return held.mapInArrow(run, "lo bigint, hi bigint, d bigint, k bigint, k2 bigint, a bigint")


def window_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (remaining
    words joined by one space), spans (maximal removed runs of words).

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller doc_id, judged on the input.  Null text has no
    words; a document of fewer words than the window is kept whole.  A null
    doc_id comes after every other.  Rows of one doc_id never remove words
    from each other.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    source = with_text_hashes(documents(docs, id_col, text_col))
    parts = 4 * shuffle_partitions(spark)
    table = stored(_stretch_table(source, window, gram), "stretches")
    grams = stored(table.groupBy("gram").agg(F.min("d").alias("d0"), F.max("d").alias("d1"))
                   .where("d0 < d1").select("gram"), "grams")
    shared = stored(table.join(small_side(grams, 16), "gram"), "stretches")
    same = shared.groupBy("gram", "lo", "hi", (F.col("b") - F.col("a")).alias("n")).agg(F.min("d").alias("d0"))
    same = stored(same, "stretches")
    placed = shared.withColumn("n", F.col("b") - F.col("a")).join(same, ["gram", "lo", "hi", "n"])
    whole = placed.where("d > d0").select("d", "k", "k2", "a", (F.col("b") + window).alias("b"))
    several = same.groupBy("gram").agg(F.count(F.lit(1)).alias("n_stretches")).where("n_stretches > 1").select("gram")
    several = small_side(stored(several, "grams"), 16)
    firsts = placed.where("d = d0").join(several, "gram", "leftsemi") \
                   .select("d", "k", "k2", "a", (F.col("b") + 1).alias("b"))
    wanted = stored(merge_gaps(firsts, parts), "wanted")
    windows = stored(_windows(source, small_side(wanted, 32, "spans"), window), "windows")
    least = windows.groupBy("lo", "hi").agg(F.min("d").alias("d0"), F.max("d").alias("d1")).where("d0 < d1")
    single = windows.join(least, ["lo", "hi"]).where("d > d0") \
                    .select("d", "k", "k2", "a", (F.col("a") + window).alias("b"))
    gaps = stored(merge_gaps(whole.union(single), parts), "gaps")
    side = small_side(gaps, 32, "spans")
    rows = source.join(side, of_document(source, side), "left") \
                 .select(source["doc_id"], "text", "spans")

    def cut(batches):
        for batch in batches:
            ids, spans, text = tb.ids(batch, "doc_id"), batch.column(2), tb.column(batch, "text")
            for i, j, buf, offs in tb.blocks(text):
                raw, n_words, n_removed, kept, spans_of = buf.tobytes(), [], [], [], []
                for r in range(j - i):
                    # bytes.split() parts at exactly \x20 and \x09-\x0D
                    words = raw[offs[r]:offs[r + 1]].split()
                    packed = spans[i + r].as_py()
                    pairs = np.frombuffer(packed, "<i8").reshape(-1, 2).tolist() if packed else []
                    n_words.append(len(words))
                    n_removed.append(sum(b - a for a, b in pairs))
                    spans_of.append([{"first": a, "end": b} for a, b in pairs])
                    for a, b in reversed(pairs):
                        del words[a:b]
                    kept.append(b" ".join(words))
                id_ = ids[i:j]
                yield pa.RecordBatch.from_arrays([
                    pa.array(id_, mask=id_ == MAX_ID), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans_of, SPANS)],
                    ["doc_id", "n_words", "n_removed", "kept", "spans"])

    return rows.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string, "
                                "spans array<struct<first:bigint,end:bigint>>")
