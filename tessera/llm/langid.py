"""Language identification with error-correcting output codes.

Every language gets a codeword of bits.  For each bit one binary classifier
tells the languages that have the bit from those that don't, from character
n-grams of the text.  The classifiers' real-valued outputs are decoded by
loss: the language whose codeword has the smallest total loss wins, and the
gap to the runner-up says how certain that is.

Training is a count: n-grams per language over *all* labelled training rows,
summed in Spark into a table of fixed size (``DIM`` buckets per language and
n-gram order).  A bit's classifier is the log-odds of each bucket between its
two groups of languages, with groups weighted evenly over their languages.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textblock as tb
from .common import ship

ORDERS = (1, 2, 3)      # n-gram lengths in bytes of the normalised text
DIM = 1 << 15           # hash buckets per n-gram order
CODE_BITS = 31          # codeword length beyond which codes are no longer exhaustive
MAX_LANGS = 512         # more labels than this are refused (model size)
SMOOTH = 0.5
UNKNOWN = "und"
AMBIGUOUS = 0.02        # score under which a prediction is flagged

# Normalisation: letters (and every non-ASCII byte) stay, A-Z become a-z,
# anything else becomes a blank, so words are bounded by blanks.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def codewords(n: int) -> np.ndarray:
    """int8[n, bits] of +1/-1 codewords.

    Up to seven languages: the exhaustive code (every split of the languages,
    once).  Beyond: pseudo-random columns, keeping those that split the
    languages and differ from each other, with a distance of about half the
    bits between any two languages.
    """
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        cols = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(cols, np.int8).T
    rng, cols, seen = np.random.RandomState(n), [], set()
    bits = max(CODE_BITS, 8 * int(np.ceil(np.log2(n))))
    while len(cols) < bits:
        c = rng.permutation(np.where(np.arange(n) < n // 2, 1, -1))
        c = tuple((c * c[0]).tolist())
        if c not in seen:
            seen.add(c)
            cols.append(c)
    return np.array(cols, np.int8).T


def _features(buf: np.ndarray, offs: np.ndarray):
    """Yield (bucket of every n-gram start, whether it counts) per order.
    N-grams that are all blank or cross a row do not count."""
    t = _LETTER[buf]
    n = len(t)
    last = np.repeat(offs[1:], np.diff(offs))            # end of each byte's row
    blank = t == 0x20
    for k, order in enumerate(ORDERS):
        if n < order:
            yield np.zeros(0, np.int64), np.zeros(0, bool)
            continue
        code = t[:n - order + 1].astype(np.uint64)
        solid = ~blank[:n - order + 1]
        for i in range(1, order):
            code = (code << np.uint64(8)) | t[i:n - order + 1 + i]
            solid = solid | ~blank[i:n - order + 1 + i]
        ok = solid & (np.arange(len(code)) + order <= last[:len(code)])
        bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)).astype(np.int64)
        yield bucket + k * DIM, ok


ADD_PARTS = 64           # first sums of a language's partial tables


def count_ngrams(train: DataFrame) -> list[tuple[str, np.ndarray]]:
    """(language, n-gram counts) over all rows of ``train(lang, text)``."""
    ship(train.sparkSession)
    size = DIM * len(ORDERS)

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = batch.column(0).to_pylist()
            for i, j, buf, offs in tb.blocks(tb.column(batch, "text")):
                names = sorted(set(lang[i:j]))
                code = np.array([names.index(x) for x in lang[i:j]])
                per_byte = np.repeat(code, np.diff(offs))
                for name in names:
                    total.setdefault(name, np.zeros(size))
                    if len(total) > MAX_LANGS:
                        raise ValueError(f"more than {MAX_LANGS} languages")
                for bucket, ok in _features(buf, offs):
                    if not len(bucket):
                        continue
                    who = per_byte[:len(bucket)]
                    for c, name in enumerate(names):
                        total[name] += np.bincount(bucket[ok & (who == c)], minlength=size)
        if total:
            yield pa.RecordBatch.from_pydict({"lang": list(total), "counts": [v.tobytes() for v in total.values()]},
                                             pa.schema([("lang", pa.string()), ("counts", pa.binary())]))

    def add(table: pa.Table) -> pa.Table:
        v = np.zeros(size)
        for x in table["counts"]:
            v += np.frombuffer(x.as_py())
        return pa.table({"lang": table["lang"][:1], "counts": pa.array([v.tobytes()], pa.binary())})

    # the tables of slices are added up in parallel before each language's last, small sum
    partial = train.select("lang", "text").mapInArrow(count, "lang string, counts binary") \
                   .withColumn("part", F.spark_partition_id() % ADD_PARTS)
    once = partial.groupBy("lang", "part").applyInArrow(add, "lang string, counts binary")
    got = once.groupBy("lang").applyInArrow(add, "lang string, counts binary")
    return sorted((r["lang"], np.frombuffer(r["counts"])) for r in got.collect())


class Model:
    """Codewords and the bit classifiers' weights."""

    def __init__(self, counts: list[tuple[str, np.ndarray]]):
        self.langs = [x for x, _ in counts]
        self.code = codewords(len(counts))
        size = DIM * len(ORDERS)
        p = np.zeros((len(counts), size))
        for k in range(len(ORDERS)):
            part = slice(k * DIM, (k + 1) * DIM)
            for i, (_, c) in enumerate(counts):
                p[i, part] = (c[part] + SMOOTH) / (c[part].sum() + SMOOTH * DIM)
        bits = self.code.shape[1] if len(counts) else 0
        self.weights = np.zeros((bits, size), np.float32)
        for b in range(bits):
            one = self.code[:, b] > 0
            if one.all():
                continue
            self.weights[b] = np.log(p[one].mean(axis=0)) - np.log(p[~one].mean(axis=0))

    def outputs(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Mean log-odds per n-gram of every row and bit."""
        rows, bits = len(offs) - 1, len(self.weights)
        total, n = np.zeros((rows, bits)), np.zeros(rows)
        row_of = np.repeat(np.arange(rows), np.diff(offs))
        for bucket, ok in _features(buf, offs):
            if not len(bucket):
                continue
            r, g = row_of[:len(bucket)][ok], bucket[ok]
            n += np.bincount(r, minlength=rows)
            cut = np.searchsorted(r, np.arange(rows + 1))
            for b in range(bits):
                acc = np.zeros(len(g) + 1)
                np.cumsum(self.weights[b][g], dtype=np.float64, out=acc[1:])
                total[:, b] += acc[cut[1:]] - acc[cut[:-1]]
        return total / np.maximum(n, 1)[:, None]

    def decode(self, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best language, score).  A bit's loss is logistic in the margin; the
        score is how much smaller the best total loss is than the next."""
        margin = 4.0 * out[:, None, :] * self.code[None, :, :]
        loss = np.logaddexp(0.0, -margin).mean(axis=2)
        best = loss.argmin(axis=1)
        if loss.shape[1] < 2:
            return best, np.ones(len(best))
        two = np.partition(loss, 1, axis=1)
        return best, np.clip((two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1e-12), 0.0, 1.0)


def fit(train: DataFrame) -> Model:
    """Train on ``train(lang, text)``; rows with a null in either are left out."""
    return Model(count_ngrams(train.where("lang IS NOT NULL AND text IS NOT NULL")))


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """lang_pred, score and ambiguous for every row, beside the ``keep`` columns
    and doc_id.

    ``lang_pred`` is ``und`` with score 0 (and ambiguous) for a null text, one
    without any letter, or when the model knows no language.  Rows are judged
    one by one, so repeated rows and null ids need no rule.
    """
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast(model)
    cols = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
            *[F.col(c) for c in keep if c not in (id_col, text_col)]]
    rows = docs.select(*cols)

    def run(batches):
        m = held.value
        for batch in batches:
            text, pred, score = tb.column(batch, "text"), [], []
            for i, j, buf, offs in tb.blocks(text):
                raw = buf.tobytes()
                # ASCII letters show in the bytes; other scripts are looked up
                ascii_ = (_LETTER[buf] >= 0x61) & (_LETTER[buf] <= 0x7A)
                acc = np.concatenate([[0], np.cumsum(ascii_)])
                letters = (acc[offs[1:]] - acc[offs[:-1]]) > 0
                for r in np.flatnonzero(~letters).tolist():
                    letters[r] = _has_letter(raw[offs[r]:offs[r + 1]].decode("utf-8", "replace"))
                if not m.langs:
                    letters[:] = False
                    pred += [UNKNOWN] * (j - i)
                    score += [0.0] * (j - i)
                    continue
                best, sure = m.decode(m.outputs(buf, offs))
                pred += [m.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
                score += np.where(letters, sure, 0.0).tolist()
            s = np.array(score, float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(s), pa.array(s < AMBIGUOUS)],
                [*batch.schema.names, "lang_pred", "score", "ambiguous"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a document is held out of training: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
