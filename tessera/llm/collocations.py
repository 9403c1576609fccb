"""Phrase collocations, counted through mergeable Misra-Gries summaries.

Phrases of 1 to 3 words that stand at least ``MIN_COUNT`` times in a language
are needed with exact counts: the candidates and the parts that score them.

1. Scan tasks code the words of about ``FLUSH`` words at a time by a
   dictionary of their own and count phrases of codes.  The counts are dealt
   to hash partitions as compressed *blobs*: the words, sorted code columns
   and counts, some 5 to 8 bytes a phrase.  This is the only exchange of
   phrases.
2. The task of a hash partition first learns the partition's mass (a small
   header row of each blob comes first), and takes its blobs into a
   Misra-Gries summary of more than mass / ``MIN_COUNT`` counters.  Whatever
   stands ``MIN_COUNT`` times survives (see ``MisraGries``).
3. A second pass over the partition's blobs counts the survivors exactly, under
   a 128-bit hash, and returns the frequent ones as words.
4. Cuts are joined with the counts of their parts, scored in exact decimals,
   absorbed candidates dropped, and each language ranked in two levels.

A partition holds about ``PARTITION_MASS`` phrase occurrences, so a task's
memory is that of its compressed blobs and the summary; the number of
partitions follows the measured text.  A phrase standing anywhere often is one
counter, and at most one entry of each blob.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textblock as tb
from .common import ship, shuffle_partitions, stored

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
FLUSH = 1_800_000  # words; with one more step their codes fit in 21 bits
STEP = 1 << 18     # words of one document added at once
PARTITION_MASS = 8_000_000
PHRASES_PER_BYTE = 0.45  # rough: sizes the number of partitions only
UNKNOWN = "und"
U64 = np.uint64
I64 = np.int64
CODE_BITS = 21
MULT = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, 0x09, *b".,;:!?\n\x0b\x0c\r"]] = False
CUT = np.zeros(256, np.int32)
CUT[list(b".,;:!?\n\x0b\x0c\r")] = 1


class MisraGries:
    """Counts of at most ``capacity`` keys, of a stream or of merged summaries.

    Taking c from all counters when there are too many takes it from more than
    ``capacity`` of them, so all such c together are below mass / capacity: a
    key that stands mass / capacity times keeps a counter, however often
    summaries were merged."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, I64)
        self._more: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Counts of more keys (of another summary, or plain)."""
        self._more.append((keys, counts))
        self._held += len(keys)
        if self._held > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._more)])
        counts = np.concatenate([self.counts, *(n for _, n in self._more)])
        self._more, self._held = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        if len(keys) > self.capacity:
            counts = counts - np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts


def phrase_hash(word_hash: np.ndarray, codes: np.ndarray, lang: str) -> np.ndarray:
    """Hash of each row of ``codes`` (1-based, 0: no word) in a language."""
    table = np.concatenate(([U64(0)], word_hash))
    raw = np.frombuffer(lang.encode() + b"\0", np.uint8)
    h = np.full(len(codes), tb.span_hash(raw, np.array([0]), np.array([len(raw)]))[0])
    for k in range(codes.shape[1]):
        h += table[codes[:, k]] * U64(MULT[k % 3] + 2 * (k // 3))
    return tb.mix(h)


def word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buf, offs = tb.buffers(words)
    part, offs = buf[offs[0]:offs[-1]], offs - offs[0]
    return tuple(tb.span_hash(part, offs[:-1], offs[1:], b) for b in tb.BASES)


def pack(words: pa.Array, codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Words, and code columns by byte planes (first column as differences)."""
    buf, offs = tb.buffers(words)
    cols = [np.diff(codes[:, 0], prepend=0), *codes.T[1:], np.minimum(counts, 255)]
    big = counts[counts >= 255]
    planes = [np.ascontiguousarray(c).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in cols]
    head = np.array([len(words), len(codes), codes.shape[1], offs[-1] - offs[0], len(big)], "<i8").tobytes()
    body = b"".join([head, np.diff(offs).astype("<u4").tobytes(), buf[offs[0]:offs[-1]].tobytes(), *planes,
                     big.astype("<i8").tobytes()])
    return len(body).to_bytes(8, "little") + pa.Codec("zstd", 6).compress(body, asbytes=True)


def unpack(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    body = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n_words, n, width, n_bytes, n_big = np.frombuffer(body, "<i8", 5).tolist()
    at = 40
    offs = np.zeros(n_words + 1, np.int32)
    np.cumsum(np.frombuffer(body, "<u4", n_words, at), out=offs[1:])
    at += 4 * n_words
    words = pa.StringArray.from_buffers(n_words, pa.py_buffer(offs), pa.py_buffer(body[at:at + n_bytes]))
    at += n_bytes
    cols = []
    for _ in range(width + 1):
        cols.append(np.ascontiguousarray(np.frombuffer(body, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel().astype(I64))
        at += 4 * n
    counts = cols.pop()
    counts[counts == 255] = np.frombuffer(body, "<i8", n_big, at)
    cols[0] = np.cumsum(cols[0])
    return words, np.stack(cols, 1), counts


class _Buffer:
    """Words of one language waiting to be counted."""

    def __init__(self):
        self.named, self.check, self.words = [], [], []          # of each step's distinct words
        self.code, self.linked, self.counted = [], [], []        # of all words

    def add(self, buf, starts, ends, linked, counted):
        """Words at the spans.  ``linked``: the next word follows in the same
        piece; ``counted``: phrases that begin here are counted."""
        names, at, code = np.unique(tb.span_hash(buf, starts, ends), return_index=True, return_inverse=True)
        check = tb.span_hash(buf, starts, ends, tb.BASES[1])
        if not (check == check[at][code]).all():
            raise ValueError("two words share a 64-bit hash")
        size = ends[at] - starts[at]
        offs = np.zeros(len(at) + 1, np.int32)
        np.cumsum(size, out=offs[1:])
        place = np.repeat(starts[at] - offs[:-1], size) + np.arange(offs[-1])
        self.words.append(pa.StringArray.from_buffers(len(at), pa.py_buffer(offs), pa.py_buffer(buf[place].tobytes())))
        for column, values in ((self.named, names), (self.check, check[at]), (self.code, code.astype(np.int32)),
                               (self.linked, linked), (self.counted, counted)):
            column.append(values)

    def _coded(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words, frequent ones first, and each word's code from 1."""
        names, first, place = np.unique(np.concatenate(self.named), return_index=True, return_inverse=True)
        check = np.concatenate(self.check)
        if not (check == check[first][place]).all():
            raise ValueError("two words share a 64-bit hash")
        begins = np.cumsum([0, *map(len, self.named)])
        code = np.concatenate([place[a:a + len(n)][c] for a, n, c in zip(begins, self.named, self.code)])
        by_count = np.argsort(-np.bincount(code, minlength=len(names)), kind="stable")
        rank = np.empty(len(names), I64)
        rank[by_count] = np.arange(1, len(names) + 1)
        return pa.concat_arrays(self.words).take(pa.array(first[by_count])), rank[code]

    def _phrases(self, code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``width`` codes (0: no more words) and their counts."""
        linked, counted = np.concatenate(self.linked), np.concatenate(self.counted)
        shifts = [CODE_BITS * (width - 1 - k) for k in range(width)]
        follows, packed, keys = counted, code << shifts[0], [(code << shifts[0])[counted]]
        for k in range(1, width):  # phrases of k + 1 words
            follows = follows[:-1] & linked[k - 1:-1]
            packed = packed[:-1] + (code[k:] << shifts[k])
            keys.append(packed[follows])
        keys, counts = np.unique(np.concatenate(keys), return_counts=True)
        return np.stack([(keys >> s) & ((1 << CODE_BITS) - 1) for s in shifts], 1), counts

    def blobs(self, lang: str, parts: int, width: int):
        """(partition, phrase occurrences, word occurrences, blob) of what was added."""
        words, code = self._coded()
        codes, counts = self._phrases(code, width)
        part = (phrase_hash(word_hashes(words)[0], codes, lang) % U64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edges)):
            mine = order[edges[p]:edges[p + 1]]
            used, own = np.unique(codes[mine], return_inverse=True)
            own = own.reshape(-1, width) + int(used[0] != 0)
            single = codes[mine, 1:].max(axis=1, initial=0) == 0
            yield (int(p), int(counts[mine].sum()), int(counts[mine][single].sum()),
                   pack(words.take(pa.array(used[used > 0] - 1)), own, counts[mine]))


def _dealt(parts: int, width: int, flush: int):
    """Scan tasks: a header row (kind 0) and a blob (kind 1) by partition."""

    def rows(held):
        for lang, buffer in held.items():
            for p, mass, words, blob in buffer.blobs(lang, parts, width):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    ([p, p], [0, 1], [lang, lang], [mass, 0], [words, 0], [None, blob]), BLOB_TYPES)], BLOB_NAMES)

    def job(batches):
        held, waiting = {}, 0
        for batch in batches:
            langs = tb.column(batch, "lang").to_pylist()
            for i, j, buf, offs in tb.blocks(tb.column(batch, "text")):
                buf = tb.LOWER[buf]
                cuts = np.zeros(len(buf) + 1, np.int32)
                np.cumsum(CUT[buf], out=cuts[1:])
                starts, ends, first = tb.word_spans(buf, offs, IN_WORD)
                if not len(starts):
                    continue
                linked = np.zeros(len(starts), bool)
                linked[:-1] = cuts[starts[1:]] == cuts[ends[:-1]]
                linked[first[1:][first[1:] > 0] - 1] = False  # a document's last word
                where: dict = {}
                for k in range(j - i):
                    where.setdefault(langs[i + k], []).append(np.arange(first[k], first[k + 1]))
                for lang, places in where.items():
                    places = np.concatenate(places)
                    step = min(STEP, flush)
                    for a in range(0, len(places), step):  # a long document's steps overlap by the words that follow
                        at = places[a:a + step + width - 1]
                        buffer = held.setdefault(lang, _Buffer())
                        link = linked[at]
                        link[-1] = False
                        buffer.add(buf, starts[at], ends[at], link, np.arange(len(at)) < step)
                        waiting += len(at)
                        if waiting >= flush:
                            yield from rows(held)
                            held, waiting = {}, 0
        yield from rows(held)

    return job


class _Partition:
    """The blobs of one hash partition."""

    def __init__(self):
        self.mass, self.words, self.blobs = 0, {}, []

    def add(self, kind, lang, mass, words, blob):
        if kind:
            self.blobs.append((lang, blob))
        else:
            self.mass += mass
            self.words[lang] = self.words.get(lang, 0) + words

    def survivors(self, min_count: int) -> np.ndarray:
        summary = MisraGries(self.mass // min_count + 1)
        for lang, blob in self.blobs:
            words, codes, counts = unpack(blob)
            summary.add(phrase_hash(word_hashes(words)[0], codes, lang), counts)
        summary.settle()
        return summary.keys

    def frequent(self, min_count: int):
        """Batches of (lang, words, n): exact counts of at least ``min_count``,
        and each language's word occurrences under no words."""
        yield _grams(list(self.words), pa.array([[]] * len(self.words), pa.list_(pa.string())), list(self.words.values()))
        keys = self.survivors(min_count)
        if not len(keys):
            return
        total, check = np.zeros(len(keys), I64), np.zeros(len(keys), U64)
        blob_of, row_of = np.full(len(keys), -1), np.zeros(len(keys), I64)
        twins: dict = {}  # phrases that share the first hash with another
        for b, (lang, blob) in enumerate(self.blobs):
            words, codes, counts = unpack(blob)
            one, two = word_hashes(words)
            h = phrase_hash(one, codes, lang)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == h)
            at, g, n = at[hit], phrase_hash(two, codes[hit], lang), counts[hit]
            new = np.flatnonzero(blob_of[at] < 0)
            blob_of[at[new]], row_of[at[new]], check[at[new]] = b, hit[new], g[new]
            same = check[at] == g
            np.add.at(total, at[same], n[same])
            for k in np.flatnonzero(~same):
                found = twins.setdefault((at[k], g[k]), [0, b, hit[k]])
                found[0] += int(n[k])
        often = np.flatnonzero(total >= min_count)
        more = [x for x in twins.values() if x[0] >= min_count]
        blob_at = np.concatenate([blob_of[often], [x[1] for x in more]]).astype(I64)
        row_at = np.concatenate([row_of[often], [x[2] for x in more]]).astype(I64)
        n_at = np.concatenate([total[often], [x[0] for x in more]]).astype(I64)
        for b in np.unique(blob_at):
            mine = blob_at == b
            lang, blob = self.blobs[b]
            words, codes, _ = unpack(blob)
            codes = codes[row_at[mine]]
            offs = np.zeros(len(codes) + 1, np.int32)
            np.cumsum((codes > 0).sum(1), out=offs[1:])
            yield _grams([lang] * len(codes), pa.ListArray.from_arrays(pa.array(offs), words.take(pa.array(codes[codes > 0] - 1))),
                         n_at[mine])


def _grams(lang, words, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), words, pa.array(n, pa.int64())], ["lang", "words", "n"])


def _counted(min_count: int):
    """Tasks of hash partitions: rows come by partition, headers first."""

    def job(batches):
        at, held = None, _Partition()
        for batch in batches:
            for p, kind, lang, mass, words, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if p != at:
                    if at is not None:
                        yield from held.frequent(min_count)
                    at, held = p, _Partition()
                held.add(kind, lang, mass, words, blob)
        if at is not None:
            yield from held.frequent(min_count)

    return job


BLOB = "p int, kind int, lang string, mass bigint, words bigint, blob binary"
BLOB_NAMES = [c.split()[0] for c in BLOB.split(", ")]
BLOB_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text_col: str = "text",
                     lang_col: str = "lang", partition_mass: int = PARTITION_MASS, flush: int = FLUSH) -> DataFrame:
    """(lang, words, n): every phrase of up to ``max_words`` (at most 3) words
    that stands ``min_count`` times or more in a language, with its exact
    count, and the language's number of words under an empty array (one row
    per hash partition)."""
    if not 1 <= max_words <= MAX_WORDS:
        raise ValueError(f"max_words is 1 to {MAX_WORDS}")
    ship(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + int(size * PHRASES_PER_BYTE) // partition_mass
    blobs = docs.mapInArrow(_dealt(parts, max_words, flush), BLOB)
    by_part = blobs.repartitionById(parts, F.col("p")).sortWithinPartitions("p", "kind")
    return by_part.mapInArrow(_counted(min_count), "lang string, words array<string>, n bigint")


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) by each candidate's lowest-scoring cut."""
    size = F.size("words")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))) \
                     .select("lang", "phrase", "a", "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("left"),
                             _joined(F.col("words"), F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]) \
               .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = [f"cast({c} as decimal(19,0))" for c in "aalr"]
    score = F.expr("(1000000 * ({} * {})) div ({} * {})".format(*wide))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a") \
               .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _absorbed(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, most): the largest count of a longer candidate around each phrase."""
    size = F.size("words")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda s: _joined(F.col("words"), s, m)))))
    return candidates.where(size > 2).select("lang", inner.alias("phrase"), "a") \
                     .groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 text_col: str = "text", lang_col: str = "lang", partition_mass: int = PARTITION_MASS,
                 flush: int = FLUSH) -> DataFrame:
    """Each language's first ``top`` collocations: lang, rank, phrase, a, l,
    r, n, score.

    Texts, A-Z lower-cased, are split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
    those into words ``[^\\x20\\x09]+``.  A phrase of 2 to ``max_words`` words
    standing ``min_count`` times or more (a) is scored by its weakest cut into
    parts that stand l and r times, 1000000 a a / (l r) rounded down; one that
    lies mostly (half of a) inside one longer candidate is dropped.

    Null or empty texts have no words, a null lang is ``und``; rows of one
    document standing twice count twice.  Ties go by a, then phrase (bytes).
    """
    grams = stored(frequent_phrases(docs, min_count, max_words, text_col, lang_col, partition_mass, flush), "grams")
    totals = grams.where(F.size("words") == 0).groupBy("lang").agg(F.sum("n").alias("n"))
    counts = grams.where(F.size("words") > 0).withColumn("phrase", F.array_join("words", " "))
    candidates = counts.where(F.size("words") > 1).withColumnRenamed("n", "a")
    scored = _scored(candidates, counts).join(_absorbed(candidates), ["lang", "phrase"], "left") \
        .where(F.col("most").isNull() | (100 * F.col("most") < 50 * F.col("a"))).drop("most")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))
    for keys in (["lang", "salt"], ["lang"]):  # the firsts of each salt, then of those
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        scored = scored.withColumn("salt", salt).withColumn("rank", rank).where(F.col("rank") <= top)
    return scored.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase",
                                              "a", "l", "r", "n", "score")
