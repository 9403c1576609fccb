"""Repeated lines removed, by range-partitioned line hashes.

DataFrame functions only: no Python runs on the executors.

A line's *key* is the line without surrounding white space, A-Z lower-cased.
A key of at least ``MIN_CHARS`` code points that stands in at least
``MIN_DOCS`` documents keeps its lines in the last of them only.

1. Every document gives each of its long keys once; 128-bit hashes are counted
   (combined on the map side) and the frequent ones kept with their counts.
2. The places of frequent keys are range-partitioned by hash and sorted by
   document and position behind it; the first occurrence is streamed off each
   run.  A key of many places is dealt into segments of about ``SEGMENT``
   places, so no task holds a whole hot key; a second, tiny step takes the
   first of the segments' firsts.
3. Every other place sets a bit.  A document's bits become its keep bitmap:
   64-line words, those that keep everything left out.  Bits are combined on
   the map side, so text is neither shuffled nor returned by these steps.

Each row is a document.  Documents are ordered by doc_id, null last, then by a
128-bit hash of the text; rows equal in both are kept or cut alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import MAX_ID, documents, small_side, stored

MIN_CHARS = 40
MIN_DOCS = 5
SEGMENT = 1000
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
DOC = ["d", "t1", "t2"]
KEY = ["h1", "h2"]


def line_keys(text: Column) -> Column:
    """The key of every line; ``lower`` is the fast way on ASCII texts."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
           .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.transform(F.split(low, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, d, t1, t2, text): a document's place in the order is its id
    and text hash, so rows without an id are told apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(MAX_ID)).alias("d"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def _frequent(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(h1, h2, n): hashes of keys in at least ``min_docs`` documents."""
    long = F.filter(line_keys(F.col("text")), lambda k: F.char_length(k) >= min_chars)
    keys = docs.select(F.explode(F.array_distinct(long)).alias("key")).select(*_hashes(F.col("key")))
    return keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)


def _firsts(places: DataFrame) -> DataFrame:
    """(h1, h2, first): the last document of each key, streamed off sorted runs."""
    dealt = places.withColumn("segment", F.pmod(F.xxhash64(F.lit(2), *DOC), F.ceil(F.col("n") / SEGMENT)))
    runs = dealt.repartitionByRange(*KEY, "segment")
    order = W.partitionBy(*KEY, "segment").orderBy(*[F.col(c).desc() for c in DOC], "pos")
    heads = runs.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return heads.groupBy(*KEY).agg(F.max(F.struct(*DOC)).alias("first"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(d, t1, t2, keep) of every document that loses a line, for documents
    named by ``_named``.  ``keep`` is an array of (word, bits) by word: bit b of
    word w is 1 if line 64 w + b stays; a missing word keeps all its lines."""
    frequent = small_side(stored(_frequent(docs, min_chars, min_docs), "frequent"), 32)
    lines = docs.select(*DOC, F.posexplode(line_keys(F.col("text"))).alias("pos", "key")) \
                .where(F.char_length("key") >= min_chars).select(*DOC, "pos", *_hashes(F.col("key")))
    places = stored(lines.join(frequent, KEY), "places")
    firsts = small_side(stored(_firsts(places), "firsts"), 56)
    gone = places.join(firsts, KEY).where(F.struct(*DOC) != F.col("first"))
    words = gone.groupBy(*DOC, F.expr("cast(pos div 64 as int)").alias("word")) \
                .agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("drop"))
    word = F.struct("word", F.bitwise_not("drop").alias("bits"))
    return words.groupBy(*DOC).agg(F.array_sort(F.collect_list(word)).alias("keep"))


def apply_keep(docs: DataFrame) -> DataFrame:
    """Adds ``kept`` to rows with ``text`` and ``keep`` (null: all stays): the
    lines whose bit is 1, joined by line ends.  Cost is linear in the text."""
    bits = F.transform("keep", lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["bits"], b) == 0), lambda b: w["word"] * 64 + b))
    docs = docs.withColumn("gone", F.flatten(bits))
    near = lambda i, step: F.get("gone", i + step)
    docs = docs.withColumn("begins", F.filter("gone", lambda x, i: F.coalesce(near(i, -1) < x - 1, F.lit(True)))) \
               .withColumn("ends", F.filter("gone", lambda x, i: F.coalesce(near(i, 1) > x + 1, F.lit(True)))) \
               .withColumn("lines", F.when(F.col("gone").isNotNull(), F.split("text", "\n")))

    def stretch(j: Column) -> Column:
        low = F.coalesce(F.get("ends", j - 1) + 1, F.lit(0))
        return F.slice("lines", low + 1, F.coalesce(F.get("begins", j), F.size("lines")) - low)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("ends")), stretch))
    return docs.withColumn("kept", F.coalesce(F.array_join(kept, "\n"), "text")).drop("gone", "begins", "ends", "lines")


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_lines, n_dropped, keep (its
    bitmap; empty: all stays), kept (the text left).

    Null and empty texts are one empty line.  Every row counts as a document:
    rows of one id, or without id, with different texts are judged apart, and
    copies of one row are cut alike.  An empty table gives none.
    """
    named = _named(documents(docs, id_col, text_col))
    bitmaps = stored(keep_bitmaps(named, min_chars, min_docs), "bitmaps")
    # a word takes 12 bytes, and about 4 more as an array element
    size = bitmaps.withColumn("size", F.size("keep")).agg(F.sum(F.col("size") * 16 + 48)).first()[0] or 0
    side = F.broadcast(bitmaps) if size <= 16 << 20 else bitmaps
    rows = apply_keep(named.join(side, DOC, "left"))
    ends = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    dropped = F.aggregate("keep", F.lit(0), lambda n, w: n + 64 - F.bit_count(w["bits"]))
    none = F.array().cast(bitmaps.schema["keep"].dataType)
    return rows.select("doc_id", (ends + 1).cast("bigint").alias("n_lines"),
                       F.coalesce(dropped, F.lit(0)).cast("bigint").alias("n_dropped"),
                       F.coalesce("keep", none).alias("keep"), "kept")
