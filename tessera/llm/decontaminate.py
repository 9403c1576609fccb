"""Benchmark decontamination with a distributed positional inverted index.

DataFrame functions only: no Python runs on the executors.

A *window* is ``WINDOW`` consecutive words of a benchmark item (the whole item
if it has fewer).  Documents are the indexed side.

1. One pass counts the corpus occurrences of every benchmark term.  A window
   with a term that never occurs cannot occur.
2. Each remaining window is looked up by its two rarest terms.  Postings
   (term, document, position) of just those terms are written to the shared
   folder: the index.
3. Posting lists are offset-adjusted (document position minus position in the
   item) and intersected: a document, item and offset on which two terms
   agree is a candidate.
4. Candidates are compared word by word with the document's tokens at that
   offset, which gives exact phrase matches (all words of a window) and
   proximity matches (at least ``NEAR`` of them in their places).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, MAX_ID, documents, small_side, stored

WINDOW = 10
NEAR = 8
RAREST = 2
ROW = ["d", "t1", "t2"]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null: none.

    ``lower`` equals A-Z lower-casing on ASCII text and is much faster than
    ``translate``, which the other texts need.
    """
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
           .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _window_anchors(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(term, item_id, at): the places of every possible window's rarest terms."""
    words = items.select("item_id", "item_key", F.posexplode("words").alias("at", "term"))
    counted = words.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    starts = items.select("item_key", F.explode(F.sequence(
        F.lit(0), F.greatest(F.lit(0), F.size("words") - window))).alias("start"))
    inside = starts.join(counted, "item_key").where((F.col("at") >= F.col("start")) &
                                                    (F.col("at") < F.col("start") + window))
    by_rarity = W.partitionBy("item_key", "start").orderBy("n", "at")
    whole = W.partitionBy("item_key", "start")
    ranked = inside.withColumn("rank", F.row_number().over(by_rarity)).withColumn("least", F.min("n").over(whole))
    return ranked.where((F.col("rank") <= RAREST) & (F.col("least") > 0)) \
                 .select("term", "item_id", "item_key", "at").distinct()


def _aligned(doc: Column, at: Column, words: Column) -> Column:
    """'1' for each item word that stands in its place in the document, else '0'."""
    return F.array_join(F.transform(words, lambda w, i: F.when(
        F.get(doc, at + i) == w, F.lit("1")).otherwise(F.lit("0"))), "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, item_ids,
    near_item_ids (sorted arrays of strings), contaminated.

    A document word is hit if it lies inside an occurrence of a window.
    ``near_item_ids`` adds items of which a window's two rarest words and at
    least ``NEAR`` of all its words (scaled to shorter windows) stand in place.

    Null or empty texts have no words; an item without words has no window; an
    empty benchmark hits nothing.  Rows with a repeated or null doc_id are
    judged each on their own text; items of one id are tested each (one that
    stands twice once), and reported under the id (a null id is never reported).
    """
    # a row is its id and two hashes of its text: rows without id stay apart
    docs = documents(docs, id_col, text_col).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(MAX_ID)).alias("d"), F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(1), "text").alias("t2"))
    items = benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(item_text_col)).alias("words")) \
                     .where(F.size("words") > 0).dropDuplicates(["item_id", "words"]) \
                     .withColumn("item_key", F.xxhash64("item_id", "words")) \
                     .withColumn("joined", F.array_join("words", "   "))
    items = stored(items, "items")
    vocabulary = stored(items.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    words = docs.select(F.explode(tokens(F.col("text"))).alias("term"))
    counts = words.join(small_side(vocabulary, 32, "term"), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    anchors = stored(_window_anchors(items, stored(counts, "counts"), window), "anchors")

    places = docs.select(*ROW, F.posexplode(tokens(F.col("text"))).alias("pos", "term"))
    terms = stored(anchors.select("term").distinct(), "terms")
    index = stored(places.join(small_side(terms, 32, "term"), "term").select("term", *ROW, "pos"), "postings")
    need = F.least(F.lit(RAREST), F.size("words"))
    lists = index.join(small_side(anchors, 48, "term"), "term") \
                 .groupBy(*ROW, "item_key", (F.col("pos") - F.col("at")).alias("at")).agg(F.count(F.lit(1)).alias("agree"))
    found = lists.join(small_side(items, 128, "joined"), "item_key") \
                 .where(F.col("agree") >= need)
    candidates = stored(found.groupBy(*ROW).agg(
        F.collect_list(F.struct(F.col("item_id").cast("string").alias("item"), "at", "words")).alias("found")),
        "candidates")

    rows = docs.join(_sized(candidates), ROW, "left")
    rows = rows.select("doc_id", tokens(F.col("text")).alias("words"), "found")

    def judge(c: Column) -> Column:
        """Windows of one candidate: (item, its place, exact and near starts)."""
        line = _aligned(F.col("words"), c["at"], c["words"])
        return F.struct(c["item"].alias("item"), c["at"].alias("at"),
                        F.least(F.lit(window), F.size(c["words"])).alias("w"), line.alias("line"))

    def exact(c: Column) -> Column:
        last = F.greatest(F.length(c["line"]) - c["w"], F.lit(0))
        return F.filter(F.sequence(F.lit(0), last), lambda s: F.instr(
            F.substr(c["line"], s + 1, c["w"]), "0") == 0)

    def near(c: Column) -> Column:
        last = F.greatest(F.length(c["line"]) - c["w"], F.lit(0))
        return F.exists(F.sequence(F.lit(0), last), lambda s: F.length(F.replace(
            F.substr(c["line"], s + 1, c["w"]), F.lit("0"), F.lit(""))) * window >= c["w"] * NEAR)

    seen = rows.select("doc_id", F.size("words").alias("n_words"),
                       F.transform("found", judge).alias("lines"))
    seen = seen.select("doc_id", "n_words", F.transform("lines", lambda c: F.struct(
        c["item"].alias("item"), c["at"].alias("at"), c["w"].alias("w"),
        exact(c).alias("starts"), near(c).alias("near"))).alias("lines"))
    hits = F.filter("lines", lambda c: F.size(c["starts"]) > 0)
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda c: F.flatten(F.transform(
        c["starts"], lambda s: F.sequence(c["at"] + s, c["at"] + s + c["w"] - 1))))))
    item_ids = F.array_sort(F.array_distinct(F.array_compact(F.transform("hits", lambda c: c["item"]))))
    near_ids = F.array_sort(F.array_distinct(F.array_compact(F.transform(
        F.filter("lines", lambda c: c["near"]), lambda c: c["item"]))))
    none = F.array().cast("array<string>")
    seen = seen.withColumn("hits", hits).select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce(F.size(covered), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(item_ids, none).alias("item_ids"), F.coalesce(near_ids, none).alias("near_item_ids"))
    return seen.select("doc_id", "n_words", F.greatest("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                       F.size("item_ids").cast("bigint").alias("n_items"), "item_ids", "near_item_ids",
                       (F.col("n_hit") > 0).alias("contaminated"))


def _sized(candidates: DataFrame) -> DataFrame:
    """The candidate lists, with a broadcast hint if they are measured small."""
    size = F.aggregate("found", F.lit(64), lambda n, c: n + 64 + 32 * F.size(c["words"]))
    total = candidates.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(candidates) if total <= BROADCAST_BYTES else candidates
