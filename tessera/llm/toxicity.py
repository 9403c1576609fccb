"""Toxicity scores over deobfuscated text (a noisy-channel decoder).

Obfuscated words are read as a noisy channel's output: letters may have been
replaced by look-alikes (leetspeak), repeated, or set apart by spaces and
dots.  Each suspicious stretch becomes a lattice of possible letters with
channel costs; Viterbi decoding under a character trigram model finds the
most likely original.  Plain words have a single path and are left alone.

1. The trigram model is counted over all documents.
2. Features of the restored words (the word and its prefixes) are counted over
   labelled documents, a bounded sample (``TRAIN_ROWS`` per class, by a hash of
   the id); features more common in toxic documents get log-odds weights.
3. A document's evidence (its best word, the sum over its words, and the sum
   relative to its length) goes through a logistic model fitted on the same
   sample.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import documents, ship, stored

TRAIN_ROWS = 100_000     # labelled rows of each class used for training, at most
MIN_DOCS = 4             # toxic training documents that a feature must be in
MIN_WEIGHT = 1.5         # log-odds from which a feature is kept
PREFIXES = (4, 5)

# Look-alikes of letters, as commonly used in leetspeak.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
COST_LEET, COST_REPEAT, COST_DROP = 1.0, 0.3, 6.0
SHORT = 2                        # a separator beside a piece of at most so many characters
COST_JOIN, COST_APART = 0.4, 2.0    # was likely put inside a word,
COST_GLUE, COST_SPLIT = 4.0, 0.4    # any other between two words

BOUND, OTHER, LETTERS = 0, 27, 28
_CODE = np.zeros(256, np.int64)
_CODE[0x61:0x7B] = np.arange(1, 27)
_CODE[0x41:0x5B] = np.arange(1, 27)
_CODE[0x80:] = OTHER

_EDGE = " \t\r\n.,;:!?\"'()[]{}<>|-_/\\*"
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_RUN = re.compile(r"(\S)\1\1+")
_APART = re.compile(r"(?<![^\s.,;:\"(])(?:[^\W_][ .\-_*]){2,}[^\W_](?![^\s.,;:!?\")])")
_WORD = re.compile(r"[^\W\d_]+")
_GLUE = re.compile(r"(?:[^\w@$!|+(€*]|_)+")
HELD = 40        # longer stretches are not remembered


# -- the character model -----------------------------------------------------

def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Letter trigram counts of all whole texts, boundaries included."""
    size = LETTERS ** 3

    def count(batches):
        total, seen = np.zeros(size, np.int64), False
        for batch in batches:
            for _, _, buf, _ in tb.blocks(tb.column(batch, "text")):
                c = np.concatenate([[BOUND, BOUND], _CODE[buf], [BOUND]])
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=size)
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "n": pa.array([total.tobytes()])})

    def add(table: pa.Table) -> pa.Table:
        v = sum((np.frombuffer(x.as_py(), np.int64) for x in table["n"]), np.zeros(size, np.int64))
        return pa.table({"n": pa.array([v.tobytes()], pa.binary())})

    # slices of the table are added up in parallel before the last, small sum
    rows = docs.select("text").mapInArrow(count, "part int, n binary") \
               .withColumn("part", F.spark_partition_id() % 64)
    once = rows.groupBy("part").applyInArrow(add, "n binary").withColumn("part", F.lit(0))
    got = once.groupBy("part").applyInArrow(add, "n binary").collect()
    return np.frombuffer(got[0]["n"], np.int64) if got else np.zeros(size, np.int64)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """-log p(c | a, b), interpolated with the bigram and unigram."""
    tri = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
    bi = tri.sum(axis=0)
    uni = bi.sum(axis=0)
    p1 = (uni + 1) / (uni.sum() + LETTERS)
    p2 = (bi + 2 * p1) / (bi.sum(axis=1, keepdims=True) + 2)
    p3 = (tri + 4 * p2[None, :, :]) / (tri.sum(axis=2, keepdims=True) + 4)
    return -np.log(p3)


class Decoder:
    """Viterbi decoding of suspicious stretches."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.held: dict[str, str] = {}

    @staticmethod
    def separators(text: str) -> dict[int, bool]:
        """Place of each separator -> whether a short piece is beside it."""
        gaps = [m.span() for m in _GLUE.finditer(text)]
        ends, starts = [0, *(j for _, j in gaps)], [*(i for i, _ in gaps), len(text)]
        return {x: min(i - ends[k], starts[k + 1] - j) <= SHORT for k, (i, j) in enumerate(gaps) for x in range(i, j)}

    @staticmethod
    def lattice(text: str) -> list[list[tuple[str, float]]]:
        """Options (letter, '' or ' ') with channel costs for each character.
        A run of three or more of one letter may lose any of its repeats."""
        out, before, apart = [], "", Decoder.separators(text)
        repeats = {i for m in _RUN.finditer(text) for i in range(*m.span())}
        for i, c in enumerate(text):
            options = []
            if c.isalpha():
                options.append((c, 0.0))
            elif i in apart:
                options += [("", COST_JOIN), (" ", COST_APART)] if apart[i] else [("", COST_GLUE), (" ", COST_SPLIT)]
            for x in LEET.get(c, ""):
                options.append((x, COST_LEET))
            if c == before and i in repeats:
                options.append(("", COST_REPEAT))
            if not options:
                options.append(("", COST_DROP))
            out.append(options)
            before = c
        return out

    @staticmethod
    def _code(c: str) -> int:
        if c == " ":
            return BOUND
        return ord(c) - 96 if "a" <= c <= "z" else OTHER

    def decode(self, text: str) -> str:
        """Most likely original of one stretch (lower case) of any length.

        A path is a chain (path before, letter), shared by the paths that go
        on from it, so the cost is linear in the length.
        """
        if text in self.held:
            return self.held[text]
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(BOUND, BOUND): (0.0, None)}
        for options in self.lattice(text):
            nxt: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, done) in paths.items():
                for letter, channel in options:
                    if not letter:
                        state, total, got = (a, b), cost + channel, done
                    else:
                        c = self._code(letter)
                        state, total, got = (b, c), cost + channel + self.costs[a][b][c], (done, letter)
                    if state not in nxt or total < nxt[state][0]:
                        nxt[state] = total, got
            paths = nxt
        _, (_, path) = min(paths.items(), key=lambda x: x[1][0] + self.costs[x[0][0]][x[0][1]][BOUND])
        letters = []
        while path is not None:
            path, letter = path
            letters.append(letter)
        best = "".join(reversed(letters))
        if len(text) <= HELD:
            if len(self.held) > 100_000:
                self.held.clear()
            self.held[text] = best
        return best

    def restore(self, text: str) -> list[str]:
        """Restored words of a text, in order."""
        low = text.lower()
        if _APART.search(low):
            low = _APART.sub(lambda m: " " + self.decode(m[0]) + " ", low)
        triple = bool(_TRIPLE.search(low))
        out = []
        for t in low.split():
            out += self.word(t, triple)
        return out

    def word(self, t: str, triple: bool) -> list[str]:
        if not t.isalpha():
            bare = t.strip(_EDGE)
            if not bare:
                return []
            if not bare.isalpha():
                # '!' and '*' at the end are punctuation, inside a word letters
                if not any(c in LEET for c in bare) or not any(c.isalpha() for c in bare):
                    return _WORD.findall(bare)
                return self.decode(bare).split()
            t = bare
        if triple and _TRIPLE.search(t):
            return self.decode(t).split()
        return [t]


def suspicious(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows that may hold spaced-out letters or a letter three times in a row;
    the others need no search for either."""
    low = tb.LOWER[buf]
    solid = _CODE[low] > 0
    flag = np.zeros(len(buf), bool)
    if len(buf) > 2:
        flag[:-2] = solid[:-2] & (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:])
    if len(buf) > 4:
        # x?x?x with ? a separator: bytes 0, 2, 4 of the stretch are word bytes
        word = solid | ((buf >= 0x30) & (buf <= 0x39))
        gap = ~word
        flag[:-4] |= word[:-4] & gap[1:-3] & word[2:-2] & gap[3:-1] & word[4:]
        flag |= buf >= 0xC3          # letters of several bytes: left to the patterns
    acc = np.concatenate([[0], np.cumsum(flag)])
    return (acc[offs[1:]] - acc[offs[:-1]]) > 0


def word_sets(batch: pa.RecordBatch, decoder: Decoder):
    """Yield (row, distinct restored words, words) of a batch."""
    col = tb.column(batch, "text")
    for i, j, buf, offs in tb.blocks(col):
        look = suspicious(buf, offs)
        for r, text in enumerate(col.slice(i, j - i).to_pylist()):
            if look[r]:
                words = decoder.restore(text)
                yield i + r, set(words), len(words)
            else:
                tokens = text.lower().split()
                out = set()
                for t in set(tokens):
                    if t.isalpha():
                        out.add(t)
                    else:
                        out.update(decoder.word(t, False))
                yield i + r, out, len(tokens)


def features(word: str):
    """The word and, for longer words, its prefixes (marked by '^')."""
    yield word
    for n in PREFIXES:
        if len(word) > n:
            yield "^" + word[:n]


# -- training ------------------------------------------------------------------

class Model:
    def __init__(self, costs: np.ndarray, weights: dict[str, float], coef: np.ndarray):
        self.costs, self.weights, self.coef = costs, weights, coef

    def evidence(self, words: set[str], n: int) -> tuple[float, float, float]:
        """(best, sum, sum over the root of the length) of the words' weights;
        a word counts by its strongest feature."""
        get, best, total = self.weights.get, 0.0, 0.0
        for w in words:
            v = get(w, 0.0)
            if len(w) > 4:
                v = max(v, get("^" + w[:4], 0.0))
                if len(w) > 5:
                    v = max(v, get("^" + w[:5], 0.0))
            if v:
                total += v
                if v > best:
                    best = v
        return best, math.log1p(total), total / math.sqrt(n) if n else 0.0

    def score(self, evidence) -> float:
        z = float(self.coef[0] + np.dot(self.coef[1:], evidence))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; intercept first."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (p - y) + ridge * w * np.r_[0, np.ones(len(w) - 1)])
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(train: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` (doc_id, y) of each class, those of smallest id hash."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    one, two = (train.where(F.col("y") == y).orderBy(*order).limit(rows) for y in (1, 0))
    return one.union(two)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Train on the documents that ``labels`` marks.  A null label or id is left
    out; of repeated labels of one id the largest counts."""
    spark = docs.sparkSession
    docs = documents(docs, id_col, text_col)
    sc = spark.sparkContext
    costs = trigram_costs(count_trigrams(docs))
    held = sc.broadcast(costs)
    marked = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y")) \
                   .where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = stored(_sample(marked, rows), "chosen")    # at most 2 * rows ids: small enough to broadcast
    train = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")

    def count(batches):
        decoder, n = Decoder(held.value), ({}, {})

        def counts():
            return pa.RecordBatch.from_pydict({"f": [*n[0], *n[1]], "y": [0] * len(n[0]) + [1] * len(n[1]),
                                               "n": [*n[0].values(), *n[1].values()]}, FEATURE_COUNTS)

        for batch in batches:
            y = batch.column(1).to_pylist()
            for r, words, _ in word_sets(batch, decoder):
                own = n[y[r]]
                for f in {f for w in words for f in features(w)}:
                    own[f] = own.get(f, 0) + 1
                if len(n[0]) + len(n[1]) > 300_000:
                    yield counts()
                    n = ({}, {})
        yield counts()

    totals = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    both = train.select("text", "y").mapInArrow(count, "f string, y int, n bigint").groupBy("f").agg(
        *[F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(c) for y, c in ((1, "toxic"), (0, "clean"))])
    odds = F.log((F.col("toxic") + .5) / (n1 + 1)) - F.log((F.col("clean") + .5) / (n0 + 1))
    weighted = both.where(F.col("toxic") >= MIN_DOCS).select("f", odds.alias("w")).where(F.col("w") >= MIN_WEIGHT)
    model = Model(costs, {r["f"]: r["w"] for r in weighted.collect()}, np.array([0.0, 0.0, 0.0, 0.0]))
    first = sc.broadcast(model)

    def measure(batches):
        m = first.value
        decoder = Decoder(m.costs)
        for batch in batches:
            e = np.array([m.evidence(words, n) for _, words, n in word_sets(batch, decoder)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(e[:, k]) for k in range(3)]],
                                             ["y", "a", "b", "c"])

    got = train.select("text", "y").mapInArrow(measure, "y int, a double, b double, c double").toPandas()
    if len(got):
        y = got["y"].to_numpy(float)
        if 0 < y.sum() < len(y):
            model.coef = logistic(got[["a", "b", "c"]].to_numpy(), y)
        else:
            model.coef = np.array([5.0 if y.all() else -5.0, 0, 0, 0])
    return model


FEATURE_COUNTS = pa.schema([("f", pa.string()), ("y", pa.int32()), ("n", pa.int64())])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row.  A null or empty text has no
    evidence and gets the model's base score.  Ids are passed through."""
    docs = documents(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        decoder = Decoder(m.costs)
        for batch in batches:
            s = np.array([m.score(m.evidence(words, n)) for _, words, n in word_sets(batch, decoder)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id bigint, score double, predicted int")


def restored(docs: DataFrame, costs: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, restored): the deobfuscated words of every text, joined by blanks."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(costs)

    def run(batches):
        decoder = Decoder(held.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([" ".join(decoder.restore(t)) for t in tb.column(batch, "text").to_pylist()],
                                           pa.string())], ["doc_id", "restored"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, restored string")


def held_out(id_col: str = "doc_id"):
    """Whether a document is held out of training: crc32 of its id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
