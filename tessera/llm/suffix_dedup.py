"""Exact substring removal by a common-prefix-aware distributed merge sort.

Every byte covered by a ``WINDOW``-byte string that also starts earlier is
removed.  Sorting one suffix per byte would move the corpus a hundred times,
so suffixes are sorted at *anchors*: the start of the smallest hash among the
``GRAM``-byte strings inside a window.  Equal windows have equal anchors at
equal offsets, so anchors lose nothing.  Consecutive windows with one anchor
form a *stretch*; its sort key is the text from the anchor to the stretch's
end, then the text before the anchor, backwards.

1. Grams that occur once cannot belong to a repeated window.  Tasks exchange
   the distinct gram hashes they hold; the repeated ones form a filter, which
   is broadcast if its measured size allows (else every anchor goes on).
2. Each task sorts its keys, one run per bucket (a hash of the gram), and
   front-codes them: the length of the prefix shared with the key before, and
   the rest.  Equal keys of one run collapse to the first at once.
3. A bucket's runs are merged by a loser tree over (key, shared prefix with
   the last winner).  Unequal prefixes decide without looking at text; equal
   ones compare from there on.  The merged order comes with its LCP array.
4. Equal neighbours are equal stretches: all but the first are removed whole.
   Different stretches around one gram share windows where their common
   parts to the right (from the LCP array) and to the left together reach
   ``WINDOW`` bytes; those are removed in the later one.
5. Removed intervals are merged per document and applied to its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import MAX_ID, documents, shuffle_partitions, small_side, stored

WINDOW = 100
GRAM = 32
BUCKETS_PER_PARTITION = 4
FILTER_BYTES = 64 << 20       # largest gram filter sent to the executors
PAIRWISE = 16                 # stretches around one gram compared pair by pair
RUN_KEYS = 150_000            # keys that a task holds before it writes a run
GAP_ROWS = 20_000             # gaps that go to one bucket together
CHUNK = 1 << 22               # window starts handled at once (fits the packed position)
POS_BITS = np.uint64(23)
CODEC = "zstd"


def anchors(buf: np.ndarray, offs: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Stretches of a byte block: (row, anchor, first start, last start, gram hash)."""
    spread = window - gram + 1
    out = []
    for c in range(0, max(len(buf) - window + 1, 0), CHUNK):
        part = buf[c:c + CHUNK + window - 1]
        h = tb.rolling(part.astype(np.uint64) + np.uint64(1), gram)
        key = ((h >> POS_BITS) << POS_BITS) | np.arange(len(h), dtype=np.uint64)
        at = (tb.sliding_min(key, spread) & np.uint64((1 << int(POS_BITS)) - 1)).astype(np.int64)
        start = np.arange(len(at))
        ends = np.zeros(len(at) + 1, np.int64)     # windows that would cross a row end
        bad_from = np.clip(offs[1:-1] - window + 1 - c, 0, len(at))
        bad_to = np.clip(offs[1:-1] - c, 0, len(at))
        np.add.at(ends, bad_from, 1)
        np.add.at(ends, bad_to, -1)
        ok = np.cumsum(ends[:-1]) == 0
        start, at = start[ok], at[ok]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
        first, last = start[new] + c, start[np.append(new[1:], len(start)) - 1] + c
        row = np.searchsorted(offs, first, "right") - 1
        out.append((row, at[new] + c, first, last, h[at[new]]))
    if not out:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def _repeated_grams(docs: DataFrame, buckets: int, window: int, gram: int) -> DataFrame:
    """(grams): sorted hashes that occur at least twice, one row per bucket."""

    def held(batches):
        for batch in batches:
            grams = [np.zeros(0, np.uint64)]
            for _, _, buf, offs in tb.blocks(tb.column(batch, "text")):
                grams.append(anchors(buf, offs, window, gram)[4])
            u, n = np.unique(np.concatenate(grams), return_counts=True)
            u = np.sort(np.concatenate([u, u[n > 1]]))          # twice here: twice there
            b = (u % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(b, kind="stable")
            u, cut = u[order], np.searchsorted(b[order], np.arange(buckets + 1))
            own = [i for i in range(buckets) if cut[i + 1] > cut[i]]
            yield pa.RecordBatch.from_arrays([
                pa.array(own, pa.int32()), pa.array([u[cut[i]:cut[i + 1]].tobytes() for i in own], pa.binary())],
                ["bucket", "grams"])

    def repeated(table: pa.Table) -> pa.Table:
        u = np.sort(np.concatenate([np.frombuffer(g.as_py(), np.uint64) for g in table["grams"]]))
        twice = np.unique(u[1:][u[1:] == u[:-1]])
        return pa.table({"grams": pa.array([twice.tobytes()], pa.binary())})

    return docs.select("text").mapInArrow(tb.tidied(held), "bucket int, grams binary").groupBy("bucket") \
               .applyInArrow(tb.tidied_group(repeated), "grams binary")


def _prefixes(keys: list[bytes]) -> np.ndarray:
    """Length of the prefix each key shares with the one before (first: 0)."""
    n = len(keys)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    lens = np.array([len(k) for k in keys])
    width = int(lens.max())
    if not width:
        return out
    for c in range(0, n, 20000):
        part = keys[max(c - 1, 0):c + 20000]
        m = np.frombuffer(b"".join(k.ljust(width, b"\0") for k in part), np.uint8).reshape(len(part), width)
        differ = m[1:] != m[:-1]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        a = max(c - 1, 0)
        out[a + 1:a + len(part)] = np.minimum(lcp, np.minimum(lens[a:a + len(part) - 1], lens[a + 1:a + len(part)]))
    return out


# a document is its id and two hashes of its text: ids may be null or repeated
DOC = ("d", "k", "k2")
PLACE = np.dtype([*((c, "<i8") for c in DOC), ("at", "<i8"), ("right", "u1"), ("left", "u1")])
GAP = np.dtype([*((c, "<i8") for c in DOC), ("a", "<i8"), ("b", "<i8")])


def encode_run(keys: list[bytes], prefixes: np.ndarray, places: np.ndarray) -> bytes:
    """A sorted run, front-coded and compressed: header, lengths, places, rests."""
    rest = b"".join(k[p:] for k, p in zip(keys, prefixes.tolist()))
    raw = (np.array([len(keys)], "<i8").tobytes() + prefixes.astype(np.uint8).tobytes()
           + np.array([len(k) for k in keys], np.uint8).tobytes() + places.tobytes() + rest)
    return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec=CODEC, asbytes=True)


def decode_run(data: bytes) -> tuple[list[bytes], list[int], np.ndarray]:
    """(keys, shared prefixes, places) of a run."""
    size = int(np.frombuffer(data, "<i8", 1)[0])
    raw = pa.decompress(data[8:], decompressed_size=size, codec=CODEC, asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    prefix = np.frombuffer(raw, np.uint8, n, 8)
    length = np.frombuffer(raw, np.uint8, n, 8 + n)
    places = np.frombuffer(raw, PLACE, n, 8 + 2 * n)
    at, keys, last = 8 + 2 * n + n * PLACE.itemsize, [], b""
    for p, m in zip(prefix.tolist(), length.tolist()):
        last = last[:p] + raw[at:at + m - p]
        at += m - p
        keys.append(last)
    return keys, prefix.tolist(), places


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that ``known`` bytes agree."""
    n = min(len(a), len(b))
    m = n - known
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n if not x else known + m - (x.bit_length() + 7) // 8


def merge_runs(runs: list[tuple[list[bytes], list[int]]]):
    """Merge sorted runs with a loser tree; yield (run, index, shared prefix
    with the key yielded before).  Equal keys come in run order.

    Every contender carries the length of the prefix it shares with the last
    winner (-1: its run is spent).  The longer prefix wins unread, and the
    loser's value stays right against the new winner; equal values compare
    from that byte on.  A run's next key needs no comparison at all: its
    front code is its prefix with the winner just taken.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [r[0][0] if r[0] else b"" for r in runs] + [b""] * (k - len(runs))
    share = [0 if r[0] else -1 for r in runs] + [-1] * (k - len(runs))
    at = [0] * k
    loser, kept = [0] * k, [0] * k

    def play(a, ha, b, hb):
        """(winner, its prefix, loser, its prefix with the winner)."""
        if ha > hb:
            return a, ha, b, hb
        if hb > ha:
            return b, hb, a, ha
        if ha < 0:
            return a, ha, b, hb
        x, y = heads[a], heads[b]
        c = _common(x, y, ha)
        if x[c:c + 1] < y[c:c + 1] or (x == y and a < b):
            return a, ha, b, c
        return b, hb, a, c

    winners = [(i, share[i]) for i in range(k)]
    node = k
    level = winners
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            w, hw, lo, hl = play(*level[i], *level[i + 1])
            loser[node + i // 2], kept[node + i // 2] = lo, hl
            up.append((w, hw))
        level = up
    w, hw = level[0]
    while hw >= 0:
        i = at[w]
        yield w, i, hw
        keys, prefixes = runs[w]
        i += 1
        at[w] = i
        if i < len(keys):
            heads[w], hw = keys[i], prefixes[i]
        else:
            heads[w], hw = b"", -1
        n = (w + k) >> 1
        while n:
            hl = kept[n]
            if hl > hw:
                w, loser[n] = loser[n], w
                kept[n], hw = hw, hl
            elif hl == hw and hw >= 0:
                lo = loser[n]
                x, y = heads[w], heads[lo]
                c = _common(x, y, hw)
                kept[n] = c
                if y[c:c + 1] < x[c:c + 1] or (lo < w and x == y):
                    loser[n], w = w, lo
            n >>= 1


def _pairwise(group, window: int, out: list) -> None:
    """Windows that stretches around one gram share, removed in the later one.
    ``group``: (key, right, left, (d, k, k2, at), shared prefix with the one before)."""
    for j in range(1, len(group)):
        kb, rb, lb, pb, lcp = group[j]
        for i in range(j - 1, -1, -1):
            ka, ra, la, pa_, below = group[i]
            right = min(lcp, ra, rb)
            if lcp > below:
                lcp = below
            low = max(window - right, window - ra, window - rb)
            if low > min(la, lb):
                continue
            left = _common(ka[ra:ra + la], kb[rb:rb + lb], 0)
            # offsets of the window's start before the anchor
            if low <= left:
                *doc, at = max(pa_, pb)
                out.append((*doc, at - left, at - low + window))


def _by_offset(group, window: int, out: list) -> None:
    """The same for many stretches: at each offset, those with equal classes
    to the left and to the right (from two LCP arrays) hold the same window."""
    n = len(group)
    right = np.array([g[1] for g in group])
    left = np.array([g[2] for g in group])
    place = np.array([g[3] for g in group], dtype=np.int64).reshape(n, 4)
    lcp_r = np.array([g[4] for g in group])
    backs = [g[0][g[1]:g[1] + g[2]] for g in group]
    order = sorted(range(n), key=backs.__getitem__)
    lcp_l = _prefixes([backs[i] for i in order])
    by_place = np.lexsort(place.T[::-1])
    rank = np.empty(n, np.int64)
    rank[by_place] = np.arange(n)
    order = np.array(order)
    low = np.full(n, 256)
    high = np.full(n, -1)
    for o in range(int(left.max()) + 1):
        has = (left >= o) & (right >= window - o)
        cr = np.cumsum(lcp_r < window - o)
        cl = np.empty(n, np.int64)
        cl[order] = np.cumsum(lcp_l < o)
        who = np.flatnonzero(has)
        who = who[np.lexsort((rank[who], cr[who], cl[who]))]
        hit = who[1:][(cr[who[1:]] == cr[who[:-1]]) & (cl[who[1:]] == cl[who[:-1]])]
        gone = np.setdiff1d(np.flatnonzero(high >= 0), hit)     # an interval ends here
        for g in gone.tolist():
            *doc, at = place[g].tolist()
            out.append((*doc, at - int(high[g]), at - int(low[g]) + window))
        low[gone], high[gone] = 256, -1
        low[hit] = np.minimum(low[hit], o)
        high[hit] = o
    for g in np.flatnonzero(high >= 0).tolist():
        *doc, at = place[g].tolist()
        out.append((*doc, at - int(high[g]), at - int(low[g]) + window))


def _merge_bucket(window: int, gram: int):
    def merge(table: pa.Table) -> pa.Table:
        gaps = [np.frombuffer(x.as_py(), GAP) for x in table["gaps"] if x.is_valid]
        runs = [decode_run(x.as_py()) for x in table["run"] if x.is_valid]
        out: list[tuple[int, ...]] = []
        group: list = []

        def close():
            if len(group) > PAIRWISE:
                _by_offset(group, window, out)
            elif len(group) > 1:
                _pairwise(group, window, out)
            group.clear()

        places = [r[2].tolist() for r in runs]
        same: list = []       # places of the current key

        def settle(key, lcp):
            """The first place stands for its stretch, the others go."""
            first = min(p[:4] for p in same)
            *_, right, left = same[0]
            for *doc, at, r, le in same:
                if (*doc, at) != first:
                    out.append((*doc, at - le, at + r))
            group.append((key, right, left, first, lcp))
            same.clear()

        key, key_lcp = None, 0
        for r, i, lcp in merge_runs([(x[0], x[1]) for x in runs]):
            k = runs[r][0][i]
            if key is not None and lcp == len(k) == len(key):
                same.append(places[r][i])
                continue
            if key is not None:
                settle(key, key_lcp)
                if lcp < gram:
                    close()
            key, key_lcp = k, lcp
            same.append(places[r][i])
        if key is not None:
            settle(key, key_lcp)
        close()
        if out:
            gaps.append(np.array(out, GAP))
        all_ = np.concatenate(gaps) if gaps else np.zeros(0, GAP)
        return pa.table({c: all_[c].copy() for c in GAP.names})

    return merge


def _runs(docs: DataFrame, grams, buckets: int, window: int, gram: int) -> DataFrame:
    """(bucket, run, gaps): sorted front-coded runs; gaps are stretches that
    repeat inside their own run."""

    def write(keys, places, where):
        """One run per bucket of the keys gathered so far."""
        places, where = np.concatenate(places), np.concatenate(where)
        by_place = np.lexsort((places["at"], *(places[c] for c in DOC[::-1]), where))
        cut = np.searchsorted(where[by_place], np.arange(buckets + 1))
        out_b, out_run, gone_here = [], [], []
        for b in range(buckets):
            own = by_place[cut[b]:cut[b + 1]].tolist()
            if not own:
                continue
            own.sort(key=keys.__getitem__)                   # stable: equal keys stay by place
            ks = [keys[i] for i in own]
            prefix = _prefixes(ks)
            lens = np.array([len(k) for k in ks])
            again = np.concatenate([[False], (prefix[1:] == lens[1:]) & (lens[1:] == lens[:-1])])
            order = np.array(own)
            lead = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))]
            x, y = places[order], places[lead]
            gone = again & ~np.logical_and.reduce([x[c] == y[c] for c in (*DOC, "at")])
            g = np.zeros(int(gone.sum()), GAP)
            for c in DOC:
                g[c] = x[c][gone]
            g["a"] = x["at"][gone] - x["left"][gone]
            g["b"] = x["at"][gone] + x["right"][gone]
            keep = np.flatnonzero(~again)
            out_b.append(b)
            out_run.append(encode_run([ks[i] for i in keep], prefix[keep], x[keep]))
            gone_here.append(g)
        # what is decided here needs no bucket of its gram: it goes to any, so a
        # hot gram's bucket doesn't get the gaps of all its copies
        gaps = np.concatenate(gone_here)
        cut = [gaps[c:c + GAP_ROWS] for c in range(0, len(gaps), GAP_ROWS)]
        out_b += [int((g["d"][0] ^ g["a"][0]) % buckets) for g in cut]
        return pa.RecordBatch.from_arrays(
            [pa.array(out_b, pa.int32()), pa.array(out_run + [None] * len(cut), pa.binary()),
             pa.array([None] * len(out_run) + [g.tobytes() for g in cut], pa.binary())], ["bucket", "run", "gaps"])

    def build(batches):
        known = grams.value if grams is not None else None
        keys, places, where = [], [], []
        for batch in batches:
            ids, col = tb.ids(batch, "doc_id"), tb.column(batch, "text")
            k, k2 = text_hashes(batch)
            for i, j, buf, offs in tb.blocks(col):
                row, at, first, last, h = anchors(buf, offs, window, gram)
                if known is not None:
                    pos = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                    keep = known[pos] == h if len(known) else np.zeros(len(h), bool)
                    row, at, first, last, h = (x[keep] for x in (row, at, first, last, h))
                if not len(row):
                    continue
                raw, back, n = buf.tobytes(), buf[::-1].tobytes(), len(buf)
                right, left = last + window - at, at - first
                p = np.zeros(len(row), PLACE)
                p["d"], p["k"], p["k2"], p["at"] = ids[i:j][row], k[i:j][row], k2[i:j][row], at - offs[row]
                p["right"], p["left"] = right, left
                keys += [raw[a:a + r] + back[n - a:n - f] + bytes((r,)) for a, r, f in
                         zip(at.tolist(), right.tolist(), first.tolist())]
                places.append(p)
                where.append((h % np.uint64(buckets)).astype(np.int32))
                if len(keys) >= RUN_KEYS:
                    yield write(keys, places, where)
                    keys, places, where = [], [], []
        if keys:
            yield write(keys, places, where)

    return docs.select("doc_id", "text", "k", "k2").mapInArrow(tb.tidied(build), "bucket int, run binary, gaps binary")


def with_text_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k, k2): null ids last, and two 64-bit hashes of the text."""
    return docs.select(F.coalesce("doc_id", F.lit(MAX_ID)).alias("doc_id"), "text",
                       F.xxhash64("text").alias("k"), F.xxhash64(F.lit(1), "text").alias("k2"))


def text_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.asarray(batch.column(batch.schema.get_field_index(c)), dtype=np.int64) for c in ("k", "k2"))


def of_document(docs: DataFrame, spans: DataFrame):
    """Join condition of ``with_text_hashes`` rows with (d, k, k2) rows."""
    return (docs["doc_id"] == spans["d"]) & (docs["k"] == spans["k"]) & (docs["k2"] == spans["k2"])


def union_intervals(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [a, b) (touching ones join)."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
    return a[new], b[np.append(new[1:], len(a)) - 1]


def merge_gaps(gaps: DataFrame, parts: int) -> DataFrame:
    """(d, k, k2, spans): maximal removed runs of each document, as packed int64 pairs."""

    def merge(table: pa.Table) -> pa.Table:
        d, k, k2, a, b = (table[c].to_numpy() for c in GAP.names)
        order = np.lexsort((a, k2, k, d))
        d, k, k2, a, b = (x[order] for x in (d, k, k2, a, b))
        new = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in (d, k, k2)])]))
        spans = []
        for i, j in zip(new, np.append(new[1:], len(d))):
            x, y = union_intervals(a[i:j], b[i:j])
            spans.append(np.stack([x, y], 1).astype("<i8").tobytes())
        return pa.table({"d": d[new], "k": k[new], "k2": k2[new], "spans": pa.array(spans, pa.binary())})

    return gaps.select(*GAP.names, F.pmod(F.xxhash64(*DOC), F.lit(parts)).cast("int").alias("part")) \
               .groupBy("part").applyInArrow(tb.tidied_group(merge), "d bigint, k bigint, k2 bigint, spans binary")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, gram: int = GRAM, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (the
    remaining bytes), kept_text (the same as text, without characters that were
    cut in half; null stays null), spans (maximal removed runs, byte offsets),
    and a struct ``extra`` of the input columns named in ``keep``.

    A byte goes if a ``window``-byte string that covers it also starts earlier:
    in a smaller doc_id, or earlier in the same document.  Matches stay inside
    a document, may overlap, and are judged on the input.

    Null text counts as empty; a text shorter than the window stays whole.  A
    null doc_id comes after every other.  Rows of one doc_id with different
    texts are ordered by 128 bits of hash of the text; identical rows (id and text) are
    one document, each returned with the same result.  An empty table gives
    an empty result.
    """
    if not gram <= window <= 127:
        raise ValueError("gram <= window <= 127 is needed (lengths are stored in a byte)")
    spark = docs.sparkSession
    source = with_text_hashes(documents(docs, id_col, text_col))
    buckets = BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    repeated = stored(_repeated_grams(source, buckets, window, gram), "grams")
    size = repeated.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    known = None
    if size <= FILTER_BYTES:
        parts = [np.frombuffer(r[0], np.uint64) for r in repeated.collect()]
        known = spark.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, np.uint64), *parts])))
    gaps = _runs(source, known, buckets, window, gram).groupBy("bucket") \
        .applyInArrow(tb.tidied_group(_merge_bucket(window, gram)), "d bigint, k bigint, k2 bigint, a bigint, b bigint")
    spans = stored(merge_gaps(gaps, buckets), "gaps")
    side = small_side(spans, 32, "spans")
    whole = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(MAX_ID)).alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.col(text_col).cast("string")).alias("k"),
                        F.xxhash64(F.lit(1), F.col(text_col).cast("string")).alias("k2"),
                        F.struct(F.lit(0).alias("_"), *[F.col(c) for c in keep]).alias("extra"))
    rows = whole.join(side, of_document(whole, side), "left") \
                .select(whole["doc_id"], "text", "spans", "extra")
    kept_type = rows.schema["extra"].dataType

    def cut(batches):
        for batch in batches:
            ids, col, gaps_of = tb.ids(batch, "doc_id"), tb.column(batch, "text"), batch.column(2)
            null = np.asarray(batch.column(1).is_null())
            for i, j, buf, offs in tb.blocks(col):
                raw, n_removed, n_spans, kept, spans_of = buf.tobytes(), [], [], [], []
                for r in range(j - i):
                    text = raw[offs[r]:offs[r + 1]]
                    s = gaps_of[i + r].as_py()
                    if s is None:
                        kept.append(text)
                        n_removed.append(0)
                        n_spans.append(0)
                        spans_of.append([])
                        continue
                    pairs = np.frombuffer(s, "<i8").reshape(-1, 2)
                    at, rest = 0, []
                    for a, b in pairs.tolist():
                        rest.append(text[at:a])
                        at = b
                    rest.append(text[at:])
                    kept.append(b"".join(rest))
                    n_removed.append(len(text) - len(kept[-1]))
                    n_spans.append(len(pairs))
                    spans_of.append([{"first": a, "end": b} for a, b in pairs.tolist()])
                id_ = ids[i:j]
                texts = [None if x else t.decode("utf-8", "ignore") for t, x in zip(kept, null[i:j])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(id_, mask=id_ == MAX_ID), pa.array(np.diff(offs)), pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(texts, pa.string()),
                    pa.array(spans_of, SPANS),
                    batch.column(3).slice(i, j - i)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_text", "spans", "extra"])

    out = rows.mapInArrow(tb.tidied(cut), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, "
                               f"kept_text string, spans array<struct<first:bigint,end:bigint>>, extra {kept_type.simpleString()}")
    return out if keep else out.drop("extra")


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
