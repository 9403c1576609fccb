"""Document fingerprints: MinHash under vectorised universal hashing.

A fingerprint has ``PERMS`` registers; register *i* is the minimum of
``a_i * x + b_i mod 2^64`` over the hashes *x* of the document's word
shingles, of which 16 bits are kept.  The share of equal registers estimates
the Jaccard similarity of the shingle sets (corrected for the 2^-16 chance of
an accidental match).

``near_pairs`` bands the registers, brings equal bands together in Spark and
verifies the Jaccard similarity on the full shingle sets, over the whole table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import MAX_ID, documents, shuffle_partitions, small_side, stored
from .components import connected_components
from .hyperminhash import _bands

PERMS = 128
SHINGLE_WORDS = 5
CHANCE = 2.0 ** -16
EMPTY = 0xFFFF
PERCENT = 80             # linked when 100 * intersection >= PERCENT * union
BLOCK_ROWS = 256         # sets of a block; one task compares two blocks

_rng = np.random.RandomState(20240601)
_A = _rng.randint(0, 2**63 - 1, PERMS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.randint(0, 2**63 - 1, PERMS, dtype=np.int64).astype(np.uint64)


def row_shingles(buf: np.ndarray, offs: np.ndarray, k: int, table: np.ndarray = tb.SPACE_WORD):
    s, e, first = tb.word_spans(buf, offs, table)
    return tb.shingles(tb.span_hash(buf, s, e), first, k)


def registers(hashes: np.ndarray, begin: np.ndarray, perms: int = PERMS) -> np.ndarray:
    """uint16 registers, one row per document (all ``EMPTY`` without shingles)."""
    n = len(begin) - 1
    out = np.full((n, perms), EMPTY, np.uint16)
    full = np.flatnonzero(np.diff(begin))
    if not len(full):
        return out
    at, t = begin[full], np.empty_like(hashes)
    for i in range(perms):
        np.multiply(hashes, _A[i], out=t)
        np.add(t, _B[i], out=t)
        out[full, i] = (np.minimum.reduceat(t, at) >> np.uint64(24)).astype(np.uint16)
    return out


def fingerprint_rows(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(registers, shingles per row) of the rows of a byte block."""
    h, begin = row_shingles(buf, offs, k)
    return registers(h, begin), np.diff(begin)


def likeness(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, 0 to 1; two empty documents are alike."""
    raw = (a == b).mean(axis=1)
    est = np.clip((raw - CHANCE) / (1 - CHANCE), 0.0, 1.0)
    return np.where((na == 0) | (nb == 0), (na == nb).astype(float), est)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, fingerprint hex) of every row, in one narrow pass.

    A null or empty text, or one without words, has no shingles and the
    fingerprint of all ones; a text shorter than the shingle is one shingle.
    Null and repeated ids are kept as they come.
    """

    def run(batches):
        for batch in batches:
            fp, ns = [], []
            for _, _, buf, offs in tb.blocks(tb.column(batch, "text")):
                regs, n = fingerprint_rows(buf, offs, shingle_words)
                fp += [r.tobytes().hex() for r in regs]
                ns += n.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(fp, pa.string())],
                                             ["doc_id", "n_shingles", "fingerprint"])

    return documents(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, fingerprint string")


def _bucket(order: Column, cuts: list[int], lo: int, hi: int) -> Column:
    """How many cuts are <= order, as a balanced tree of comparisons."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(order < F.lit(cuts[mid]), _bucket(order, cuts, lo, mid)).otherwise(_bucket(order, cuts, mid + 1, hi))


def _ordered_with_next(docs: DataFrame) -> DataFrame:
    """Rows range-partitioned and sorted by id; each partition's stretch of ids
    is followed by a copy (``tail = 1``) of the document that comes after it.

    The cuts are quantiles of the ids (a few hundred numbers on the driver);
    every text is shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("ord", F.coalesce("doc_id", F.lit(MAX_ID)))
    parts = shuffle_partitions(spark)
    want = min(4 * parts, 2000)
    cuts = sorted({int(c) for c in docs.stat.approxQuantile(
        "doc_id", [i / want for i in range(1, want)], 0.25 / want) or []})
    rows = rows.withColumn("bucket", _bucket(F.col("ord"), cuts, 0, len(cuts)).cast("int"))
    firsts = sorted((r["bucket"], r["first"]) for r in
                    rows.groupBy("bucket").agg(F.min("ord").alias("first")).collect())
    first_of, before = [None] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    for n, (b, first) in enumerate(firsts):
        first_of[b], before[b] = first, firsts[n - 1][0]
    at = F.col("bucket") + 1
    own = F.struct(F.col("bucket").alias("b"), F.lit(0).alias("tail"))
    tail = F.struct(F.element_at(F.lit(before), at).cast("int").alias("b"), F.lit(1).alias("tail"))
    is_first = F.col("ord") == F.element_at(F.array(*[F.lit(f).cast("bigint") for f in first_of]), at)
    sent = rows.select("doc_id", "text", "ord", F.explode(
        F.when(is_first, F.array(own, tail)).otherwise(F.array(own))).alias("to"))
    return sent.select("doc_id", "text", "ord", "to.b", "to.tail") \
               .repartition(parts, "b").sortWithinPartitions("b", "tail", "ord", "text")


def _edits(texts: list[bytes], starts: list[np.ndarray]) -> list[bytes]:
    """Edited text of each row but the last, given its successor's row."""
    out = []
    for i in range(len(texts) - 1):
        n = len(starts[i])
        q = n // 4
        if not q:
            out.append(texts[i])
            continue
        head = texts[i][:starts[i][n - q]]
        nxt = starts[i + 1]
        out.append(head + (texts[i + 1][:nxt[q]] if q < len(nxt) else texts[i + 1]))
    return out


def _pack(texts: list[bytes]):
    offs = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offs[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offs


EDIT_SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text and of its edited text.

    The edited text replaces the last quarter (rounded down) of the code
    points by the first as many (or all) of the next document in ascending id
    order; the first document follows the last.  Rows with a null id come
    last; rows of equal id are ordered by text; null text counts as empty.  A
    single document is its own successor.  Columns as ``EDIT_SCHEMA``.
    """

    def run(batches):
        held_id, held_text, held_tail = [], [], []

        def work(ids, texts, tails):
            """Rows are complete but for the last one, which only follows."""
            buf, offs = _pack(texts)
            cp = np.flatnonzero((buf & 0xC0) != 0x80)
            first = np.searchsorted(cp, offs)
            starts = [cp[a:b] - o for a, b, o in zip(first[:-1], first[1:], offs)]
            edited = _edits(texts, starts)
            fp, n = fingerprint_rows(buf, offs)
            efp, en = fingerprint_rows(*_pack(edited))
            near_e = likeness(fp[:-1], efp, n[:-1], en)
            near_n = likeness(fp[:-1], fp[1:], n[:-1], n[1:])
            keep = [i for i in range(len(edited)) if not tails[i]]
            return pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in keep], pa.int64()),
                pa.array([len(starts[i]) for i in keep], pa.int64()),
                pa.array([hashlib.sha256(edited[i]).hexdigest() for i in keep], pa.string()),
                pa.array([fp[i].tobytes().hex() for i in keep], pa.string()),
                pa.array([efp[i].tobytes().hex() for i in keep], pa.string()),
                pa.array(near_e[keep], pa.float64()), pa.array(near_n[keep], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            text = tb.column(batch, "text")
            id_of, tail_of = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j, buf, offs in tb.blocks(text):
                raw = buf.tobytes()
                held_id += id_of[i:j]
                held_tail += tail_of[i:j]
                held_text += [raw[a:b] for a, b in zip(offs[:-1], offs[1:])]
                if len(held_text) > 1:
                    yield work(held_id, held_text, held_tail)
                    held_id, held_text, held_tail = held_id[-1:], held_text[-1:], held_tail[-1:]

    rows = _ordered_with_next(documents(docs, id_col, text_col))
    return rows.select("doc_id", "tail", "text").mapInArrow(run, EDIT_SCHEMA)


def _class_rows(rows: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, d, n, lo, hi, regs): size, 128-bit hash and registers of every row's set."""
    def run(batches):
        for batch in batches:
            for i, j, buf, offs in tb.blocks(tb.column(batch, "text")):
                h, begin = row_shingles(buf, offs, shingle_words)
                sets = tb.unique_rows(h, begin)
                lo = np.array([u.sum(dtype=np.uint64) for u in sets], np.uint64)
                hi = np.array([tb.mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for u in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                    pa.array([len(u) for u in sets], pa.int64()), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)),
                    pa.array([r.tobytes() for r in registers(h, begin)], pa.binary())],
                    ["doc_id", "d", "n", "lo", "hi", "regs"])

    return rows.select("doc_id", "d", "text").mapInArrow(
        run, "doc_id bigint, d bigint, n bigint, lo bigint, hi bigint, regs binary")


def _full_sets(rows: DataFrame, shingle_words: int) -> DataFrame:
    """(d, set): sorted distinct shingle hashes."""
    def run(batches):
        for batch in batches:
            for i, j, buf, offs in tb.blocks(tb.column(batch, "text")):
                sets = tb.unique_rows(*row_shingles(buf, offs, shingle_words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i),
                                                  pa.array([u.tobytes() for u in sets], pa.binary())], ["d", "set"])

    return rows.select("d", "text").mapInArrow(run, "d bigint, set binary")


def _count_links(percent: int):
    """Counts, for two blocks of sets, the rows that each set is linked with."""
    share = percent / 100
    reach = share - 6 * np.sqrt(share * (1 - share) / PERMS)     # a true link fails here once in 1e9

    def run(table: pa.Table) -> pa.Table:
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        blk, rows = table["blk"].to_numpy(), table["n_rows"].to_numpy()
        regs = np.frombuffer(b"".join(table["regs"].to_pylist()), np.uint16).reshape(-1, PERMS)
        sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        size, links = np.array([len(s) for s in sets]), np.zeros(len(sets), np.int64)
        left, right = np.flatnonzero(blk == x), np.flatnonzero(blk == y)
        for i in left:
            j = right[right > i] if x == y else right
            j = j[100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])]
            # registers of a small set depend on each other: nothing is pruned there
            j = j[((regs[i] == regs[j]).mean(axis=1) >= reach) | (np.minimum(size[i], size[j]) < PERMS)]
            for k in j.tolist():
                u, v = (sets[i], sets[k]) if size[i] <= size[k] else (sets[k], sets[i])
                same = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
                if 100 * same >= percent * (len(u) + len(v) - same):
                    links[i] += rows[k]
                    links[k] += rows[i]
        return pa.table({"d": table["d"], "links": pa.array(links)})

    return run


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id, n_links.

    ``class_id`` is the smallest doc_id among the rows of the same shingle set
    (null where all of them have none), ``n_links`` the number of other rows,
    anywhere in the table, whose set has a Jaccard similarity of at least
    ``percent`` to the row's own; rows of one class are linked.

    Equal sets are compared once, as a class.  Classes that share one of 32
    bands of four registers, directly or through others, form a family (a pair
    of similarity 0.8 shares none with a chance of 5e-8); a family is dealt
    into blocks, one task compares two of them on the full sets, and only
    counts leave it, never pairs.

    A row without words is alone in its class and has no links.  Rows are
    judged each on their own text, also where ids are null or repeated.
    """
    rows = documents(docs, id_col, text_col).withColumn("d", F.xxhash64("doc_id", "text"))
    of_row = stored(_class_rows(rows, shingle_words), "registers")
    classes = stored(of_row.where("n > 0").groupBy("lo", "hi", "n").agg(
        F.min("d").alias("d"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_rows"),
        F.min("regs").alias("regs")), "classes")
    bands = stored(_bands(classes), "bands")
    shared = bands.groupBy("band").agg(F.min("d").alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1")
    star = bands.join(shared, "band").where("d != lead").select(F.col("lead").alias("a"), F.col("d").alias("b")).distinct()
    family = stored(connected_components(star).select(F.col("node").alias("d"), F.col("component").alias("family")), "families")
    sizes = stored(family.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks")), "sizes")
    dealt = family.join(small_side(sizes, 16), "family") \
                  .withColumn("blk", F.pmod(F.xxhash64("d"), "blocks")) \
                  .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))) \
                  .select("family", "d", "blk", F.least("blk", "other").alias("x"), F.greatest("blk", "other").alias("y"))
    wanted = rows.join(small_side(family.select("d"), 8), "d", "leftsemi").dropDuplicates(["d"])
    sets = stored(_full_sets(wanted, shingle_words), "sets")
    links = dealt.join(classes.select("d", "n_rows", "regs"), "d").join(sets, "d") \
                 .select("family", "x", "y", "blk", "d", "n_rows", "regs", "set") \
                 .groupBy("family", "x", "y").applyInArrow(_count_links(percent), "d bigint, links bigint") \
                 .groupBy("d").agg(F.sum("links").alias("links"))
    found = stored(classes.drop("regs").join(links, "d", "left").select(
        "lo", "hi", "n", "class_id", (F.col("n_rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "links")
    out = of_row.select("doc_id", "n", "lo", "hi").join(found, ["lo", "hi", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
