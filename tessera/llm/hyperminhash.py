"""Near-duplicate classes by HyperMinHash, banding and exact verification.

A document's set is its distinct word shingles.  It is sketched ``SEEDS``
times; each sketch deals the set into ``BUCKETS`` buckets and stores, per
bucket, the smallest hash in compressed form: 6 bits of leading zeros and 10
bits of mantissa.  The registers of one sketch are one band (64 bits), so the
chance that a pair of similarity 0.85 shares no band is (1 - 0.85^4)^32, about
1e-10, at every set size: no bucket of a band can be empty for both documents
unless neither has a shingle there.

1. Equal sets form a class, represented by its smallest doc_id; only the
   representatives go on.
2. Equal bands bring representatives together.  In each band bucket everyone
   is paired with the smallest member only.
3. Pairs whose collision-corrected similarity estimate is within reach are
   verified on the full sets; verified links give components.
4. Components that still share a band bucket form a family.  Its documents
   are dealt into blocks; one task compares a pair of blocks, verifying every
   pair of different components within reach of the estimate on the full
   sets, until they are joined.  Only links that join something leave the
   task.  So no link between components is lost to step 2, and no group is
   expanded into pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import MAX_ID, documents, small_side, stored
from .components import connected_components

SHINGLE_WORDS = 3
PERCENT = 85             # linked when 100 * intersection >= PERCENT * union
SEEDS, BUCKETS = 32, 4
REGISTERS = SEEDS * BUCKETS
MANTISSA = 10
BLOCK_ROWS = 256         # documents of a block; one task compares two blocks

_rng = np.random.RandomState(987654321)
_MUL = _rng.randint(0, 2**63 - 1, SEEDS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.randint(0, 2**63 - 1, SEEDS, dtype=np.int64).astype(np.uint64)
#: chance that different minima share a register: equal leading zeros (0.4) and mantissa
COLLISION = 2.0 ** -MANTISSA * 0.4


def compress(low: np.ndarray) -> np.ndarray:
    """62-bit minima -> uint16 registers: leading zeros, then mantissa bits."""
    f = low.astype(np.float64)          # exact exponent, 53 bits of mantissa
    m, e = np.frexp(f)
    zeros = np.clip(62 - e, 0, 62).astype(np.uint16)
    mant = np.where(low == 0, 0, (m * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | np.minimum(mant, (1 << MANTISSA) - 1).astype(np.uint16)


EMPTY_REGISTER = 0xFFFF


def sketches(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """uint16[rows, REGISTERS]; an empty bucket holds ``EMPTY_REGISTER``."""
    n = len(begin) - 1
    out = np.full((n, REGISTERS), EMPTY_REGISTER, np.uint16)
    full = np.flatnonzero(np.diff(begin))
    if not len(full):
        return out
    at, none = begin[full], np.uint64(2**64 - 1)
    t, u = np.empty_like(hashes), np.empty_like(hashes)
    low = np.empty((len(full), REGISTERS), np.uint64)
    for s in range(SEEDS):
        np.multiply(hashes, _MUL[s], out=t)
        np.add(t, _ADD[s], out=t)
        np.right_shift(t, np.uint64(29), out=u)
        np.bitwise_xor(t, u, out=t)
        np.multiply(t, _MUL[-1 - s], out=t)
        bucket = (t >> np.uint64(62)).astype(np.uint8)
        t &= np.uint64((1 << 62) - 1)
        for b in range(BUCKETS):
            u.fill(none)
            np.copyto(u, t, where=bucket == b)
            low[:, s * BUCKETS + b] = np.minimum.reduceat(u, at)
    regs = compress(low & np.uint64((1 << 62) - 1))
    out[full] = np.where(low == none, EMPTY_REGISTER, regs)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate from registers: share of equal ones among those filled
    in either, corrected for the chance that different minima look equal."""
    filled = (a != EMPTY_REGISTER) | (b != EMPTY_REGISTER)
    raw = ((a == b) & filled).sum(axis=-1) / np.maximum(filled.sum(axis=-1), 1)
    return np.clip((raw - COLLISION) / (1 - COLLISION), 0.0, 1.0)


def _possible(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimate allows a link: at most six standard errors under
    the threshold, so a true link fails here with a chance of about 1e-9.
    Registers of one small set depend on each other: nothing is pruned there."""
    filled = ((a != EMPTY_REGISTER) | (b != EMPTY_REGISTER)).sum(axis=-1)
    j = percent / 100
    return (likeness(a, b) >= j - 6 * np.sqrt(j * (1 - j) / np.maximum(filled, 1))) | (filled < REGISTERS)


SIG_SCHEMA = "d bigint, n bigint, lo bigint, hi bigint, regs binary"


def _signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, col = tb.ids(batch, "doc_id"), tb.column(batch, "text")
            for i, j, raw, offs in tb.blocks(col):
                buf = tb.LOWER[raw]
                s, e, first = tb.word_spans(buf, offs, tb.SPACE_WORD)
                h, begin = tb.shingles(tb.span_hash(buf, s, e), first, shingle_words)
                n, lo, hi = [], [], []
                for u in tb.unique_rows(h, begin):
                    n.append(len(u))
                    lo.append(u.sum(dtype=np.uint64))
                    hi.append(tb.mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                regs = sketches(h, begin)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[i:j]), pa.array(n, pa.int64()),
                    pa.array(np.array(lo, np.uint64).view(np.int64)), pa.array(np.array(hi, np.uint64).view(np.int64)),
                    pa.array([r.tobytes() for r in regs], pa.binary())], ["d", "n", "lo", "hi", "regs"])

    return docs.mapInArrow(tb.tidied(run), SIG_SCHEMA)


def _bands(reps: DataFrame) -> DataFrame:
    """(band, d): one row per sketch with a shingle."""
    salt = np.arange(SEEDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, SEEDS, BUCKETS)
            packed = np.ascontiguousarray(regs).view(np.uint64)[:, :, 0]
            band = tb.mix(packed ^ salt).view(np.int64)
            d = np.repeat(np.asarray(batch.column(0)), SEEDS)
            yield pa.RecordBatch.from_arrays([pa.array(band.ravel()), pa.array(d)], ["band", "d"])

    return reps.select("d", "regs").mapInArrow(tb.tidied(run), "band bigint, d bigint")


def _sets(docs: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """(d, set): sorted distinct shingle hashes of the wanted documents."""
    def run(batches):
        for batch in batches:
            ids, col = tb.ids(batch, "doc_id"), tb.column(batch, "text")
            for i, j, raw, offs in tb.blocks(col):
                buf = tb.LOWER[raw]
                s, e, first = tb.word_spans(buf, offs, tb.SPACE_WORD)
                h, begin = tb.shingles(tb.span_hash(buf, s, e), first, shingle_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j]), pa.array([u.tobytes() for u in tb.unique_rows(h, begin)], pa.binary())],
                    ["d", "set"])

    held = docs.join(small_side(wanted, 16), docs["doc_id"] == wanted["d"], "leftsemi")
    return held.mapInArrow(tb.tidied(run), "d bigint, set binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                same = int((y[at] == x).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    sa = sets.select(F.col("d").alias("a"), F.col("set").alias("sa"))
    sb = sets.select(F.col("d").alias("b"), F.col("set").alias("sb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb") \
                .mapInArrow(tb.tidied(run), "a bigint, b bigint")


def _within_reach(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ra, rb) whose estimate allows a link, as (a, b)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                      for c in (2, 3))
            mask = pa.array(_possible(ra, rb, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return pairs.mapInArrow(tb.tidied(run), "a bigint, b bigint")


def _open_blocks(members: DataFrame, comp: DataFrame) -> DataFrame | None:
    """(family, x, y, blk, d, comp): documents still to be compared, dealt to
    pairs of blocks; None if every band bucket lies in one component.

    A family is a set of components that open buckets hold together.  Its
    documents are dealt into blocks of about ``BLOCK_ROWS``: a large component
    fills blocks of its own, small ones share some.  A document goes to each
    pair of blocks that its block is part of, but for pairs inside one large
    component.
    """
    labelled = members.join(comp.withColumnRenamed("node", "d"), "d", "left") \
                      .select("band", "d", F.coalesce("component", "d").alias("comp"))
    several = labelled.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1")
    rows = stored(labelled.join(several.select("band", "c0"), "band").select("d", "comp", "c0").distinct(), "open")
    if not rows.limit(1).count():
        return None
    families = connected_components(rows.select(F.col("c0").alias("a"), F.col("comp").alias("b")))
    held = rows.select("d", "comp").distinct() \
               .join(families.select(F.col("node").alias("comp"), F.col("component").alias("family")), "comp")
    held = stored(held, "open")
    of_comp = held.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("n")) \
                  .withColumn("own", F.when(F.col("n") >= BLOCK_ROWS, F.col("comp")))
    crowd = of_comp.groupBy(F.col("family").alias("f2"), F.col("own").alias("o2")).agg(F.sum("n").alias("n_own"))
    sized = of_comp.join(crowd, (F.col("family") == F.col("f2")) & F.col("own").eqNullSafe(F.col("o2"))) \
                   .select("comp", "own", "n_own")
    deal = F.when(F.col("own").isNull(), F.xxhash64("comp")).otherwise(F.xxhash64("d"))
    held = held.join(sized, "comp") \
               .withColumn("blk", F.xxhash64("own", F.pmod(deal, F.ceil(F.col("n_own") / BLOCK_ROWS)))) \
               .select("family", "d", "comp", "own", "blk")
    blocks = held.select("family", "own", "blk").distinct()
    other = blocks.select("family", F.col("own").alias("own2"), F.col("blk").alias("y"))
    pairs = blocks.withColumnRenamed("blk", "x").join(other, "family").where("x <= y") \
                  .where(F.col("own").isNull() | ~F.col("own").eqNullSafe(F.col("own2")))
    sent = pairs.select("family", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("blk"))
    return held.select("family", "blk", "d", "comp").join(sent, ["family", "blk"])


def _rest_links(dealt: DataFrame, regs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components, found block by block: only as many
    as are needed to join what belongs together leave a task."""

    def run(table: pa.Table) -> pa.Table:
        d, comp, blk = (table[c].to_numpy() for c in ("d", "comp", "blk"))
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        regs = np.frombuffer(b"".join(table["regs"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        size = np.array([len(s) for s in sets])
        label = comp.copy()
        left, right = np.flatnonzero(blk == x), np.flatnonzero(blk == y)
        a, b = [], []
        for i in left:
            j = right[label[right] != label[i]]
            if x == y:
                j = j[j > i]
            j = j[100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])]
            if not len(j):
                continue
            near = likeness(regs[i][None, :], regs[j])
            ok = _possible(regs[i][None, :], regs[j], percent)
            for k in j[ok][np.argsort(-near[ok], kind="stable")].tolist():
                if label[k] == label[i]:
                    continue
                u, v = (sets[i], sets[k]) if size[i] <= size[k] else (sets[k], sets[i])
                same = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
                if 100 * same >= percent * (len(u) + len(v) - same):
                    a.append(d[i])
                    b.append(d[k])
                    label[label == label[k]] = label[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    full = dealt.join(regs, "d").join(sets, "d")
    return full.select("family", "x", "y", "blk", "d", "comp", "regs", "set") \
               .groupBy("family", "x", "y").applyInArrow(tb.tidied_group(run), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` over
    their sets of distinct word shingles (A-Z lower-cased; a text shorter than
    the shingle is one shingle).  ``component_id`` is the smallest doc_id
    reachable over links, ``kept`` whether it is the document's own.

    A text that is null, empty or without words has an empty set, is linked
    with nothing and kept.  Rows that share a doc_id are one document: links
    of each of its texts count.  A null doc_id comes after every other id and
    stays null where nothing smaller is reachable.  Sets are compared as
    64-bit shingle hashes.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = documents(docs, id_col, text_col)
    ranked = docs.select(F.coalesce("doc_id", F.lit(MAX_ID)).alias("doc_id"), "text")
    sigs = stored(_signatures(docs, shingle_words), "sketches")
    classes = sigs.where("n > 0").groupBy("lo", "hi", "n").agg(F.min("d").alias("rep"))
    of_row = stored(sigs.where("n > 0").select("lo", "hi", "n", "d", "regs").join(classes, ["lo", "hi", "n"])
                    .select("lo", "hi", "n", "d", "rep", F.when(F.col("d") == F.col("rep"), F.col("regs")).alias("regs")),
                    "classes")
    reps = of_row.where("regs IS NOT NULL").select("d", "n", "regs").dropDuplicates(["d", "n", "regs"])
    bands = _bands(reps)
    buckets = bands.groupBy("band").agg(F.min("d").alias("lead"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    members = stored(bands.join(buckets, "band"), "bands")
    star = members.where("d != lead").select(F.col("lead").alias("a"), F.col("d").alias("b")).distinct()
    regs = reps.select("d", "regs")
    sized = star.join(regs.select(F.col("d").alias("a"), F.col("regs").alias("ra")), "a") \
                .join(regs.select(F.col("d").alias("b"), F.col("regs").alias("rb")), "b") \
                .select("a", "b", "ra", "rb")
    pairs = stored(_within_reach(sized, percent), "pairs")
    wanted = stored(members.select("d").distinct(), "wanted")
    sets = stored(_sets(ranked, wanted, shingle_words), "sets")
    links = stored(_verified(pairs, sets, percent), "links")
    comp = stored(connected_components(links), "components")

    dealt = _open_blocks(members, comp)      # step 4
    if dealt is not None:
        more = stored(_rest_links(dealt, regs, sets, percent), "links")
        if more.limit(1).count():
            comp = stored(connected_components(links.union(more)), "components")

    found = of_row.select("lo", "hi", "n", "d", "rep").distinct() \
                  .join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
                  .select("lo", "hi", "n", "d", F.coalesce("component", "rep").alias("c"))
    out = sigs.select("lo", "hi", "n", "d").join(found, ["lo", "hi", "n", "d"], "left")
    c = F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("d"))
    null = F.lit(None).cast("bigint")
    return out.select(F.when(F.col("d") != MAX_ID, F.col("d")).otherwise(null).alias("doc_id"),
                      F.col("n").alias("n_shingles"),
                      F.when(c != MAX_ID, c).otherwise(null).alias("component_id"),
                      (c == F.col("d")).alias("kept"))
