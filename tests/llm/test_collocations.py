"""op11: collocations against brute force, and the Misra-Gries guarantee."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import CLASHING, SF
from pyspark.sql import functions as F

import brute
from tessera.llm import collocations as co
from tessera.llm.queries import QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _brute(rows, min_count=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower_az(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        most = Counter()
        for p, a in cands.items():
            if len(p) == 3:
                for part in {p[:2], p[1:]}:
                    most[part] = max(most[part], a)
        rows = []
        for p, a in cands.items():
            if most[p] and 100 * most[p] >= 50 * a:
                continue
            score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def _frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "lang string, text string").repartition(parts)


def _got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def _random(rng, n, words=12):
    names = [f"w{i}" for i in range(words)] + ["Éa", "éa", "X", "x", "a\xa0b", "\x1c"]
    marks = [" ", " ", " ", "\t ", ". ", ",", "\n", "\v", " ; "]
    return [(rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice(names[:rng.randint(2, len(names))]) + rng.choice(marks) for _ in range(rng.randint(0, 80))))
            for _ in range(n)]


@pytest.mark.parametrize("mass,flush", [(8_000_000, 1_800_000), (500, 1_800_000), (300, 17)])
def test_random_texts(spark, rng, mass, flush):
    """Any number of partitions and any size of the counted pieces."""
    rows = _random(rng, 120)
    got = _got(co.collocations(_frame(spark, rows), partition_mass=mass, flush=flush))
    assert got == _brute(rows) and len(got) > 30


def test_top_and_two_word_phrases(spark, rng):
    rows = _random(rng, 60, 6)
    assert _got(co.collocations(_frame(spark, rows), top=7)) == _brute(rows, top=7)
    pairs = _got(co.collocations(_frame(spark, rows), max_words=2, min_count=3))
    assert pairs and all(len(r[2].split(" ")) == 2 for r in pairs)


def test_exact_products(spark):
    """Counts whose products pass 64 bits."""
    big = 3_000_000_000
    grams = spark.createDataFrame([("en", ["a"], 5 * big), ("en", ["b"], 4 * big + 1), ("en", ["a", "b"], 3 * big - 7)],
                                  "lang string, words array<string>, n long").withColumn("phrase", F.array_join("words", " "))
    r = co._scored(grams.where("size(words) = 2").withColumnRenamed("n", "a"), grams).first()
    a = 3 * big - 7
    assert (r.a, r.l, r.r, r.score) == (a, 5 * big, 4 * big + 1, 1000000 * a * a // (5 * big * (4 * big + 1)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=120), min_size=1, max_size=8), st.integers(2, 9))
def test_every_frequent_key_survives(streams, threshold):
    """Any split into summaries, merged in any grouping, pruned often."""
    mass = sum(map(len, streams))
    total = Counter(x for s in streams for x in s)
    whole = co.MisraGries(mass // threshold + 1)
    for s in streams:
        part = co.MisraGries(mass // threshold + 1)
        for x in s:
            part.add(np.array([x], co.U64), np.array([1]))
            part.settle()
        whole.add(part.keys, part.counts)
        whole.settle()
    kept = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
    assert len(kept) <= whole.capacity
    assert all(x in kept for x, n in total.items() if n >= threshold)
    assert all(n <= total[x] for x, n in kept.items())


def test_blobs_round_trip():
    words = pa.array(["a", "é", "", "long word"])
    codes = np.array([[1, 0, 0], [1, 2, 4], [3, 1, 0], [70000, 2, 1]])
    counts = np.array([1, 254, 255, 3_000_000_000])
    w, c, n = co.unpack(co.pack(words, codes, counts))
    assert w.equals(words) and (c == codes).all() and (n == counts).all()


def test_phrases_that_share_a_hash(rng, monkeypatch):
    """All phrases of a language have one first hash: the second tells them apart."""
    monkeypatch.setattr(co, "word_hashes", lambda words, f=co.word_hashes: (np.zeros(len(words), co.U64), f(words)[1]))
    rows = [(lang or "und", text) for lang, text in _random(rng, 40, 4)]
    batch = pa.record_batch({"lang": pa.array([r[0] for r in rows]), "text": pa.array([r[1] for r in rows])})
    dealt = pa.Table.from_batches(co._dealt(1, 3, 200)(iter([batch]))).sort_by("kind").to_batches()
    got = {(l, " ".join(w)): n for b in co._counted(10)(iter(dealt)) for l, w, n in zip(*(c.to_pylist() for c in b.columns)) if w}
    want: Counter = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower_az(text)):
            words = re.findall("[^\x20\x09]+", piece)
            want.update((lang, " ".join(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    assert got == {k: n for k, n in want.items() if n >= 10} and len(got) > 20


def test_long_text_and_hot_phrase(spark):
    """One document of many words, counted in overlapping pieces."""
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choice("abcde") for _ in range(30000))), ("en", "of the " * 5000), (None, "of the, " * 20)]
    assert _got(co.collocations(_frame(spark, rows), flush=1000, partition_mass=20000)) == _brute(rows)


def test_query_matches_brute_force(spark, docs):
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert _got(QUERIES["op11_phrase_collocations"](spark, SF)) == _brute(rows)


def test_edge_rows(spark, edge, nothing):
    rows = [(r.lang, r.text) for r in edge.select("lang", "text").collect()]
    more = edge.select("*", *[F.lit(0).alias(c) for c in ("p", "kind", "mass", "words2", "n", "phrase") if c not in CLASHING])
    assert _got(co.collocations(more)) == _brute(rows) == [("en", 1, "word word word", 29998, 30000, 29999, _words(rows), 999900)]
    assert co.collocations(nothing).count() == 0


def _words(rows):
    return sum(len(re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", t or "")) for _, t in rows)
