"""op6: repeated word windows against brute force."""
import hashlib

import brute
import pytest
from llm_helpers import EDGE_ROWS, SF, frame

from tessera.llm import common, window_dedup
from tessera.llm.queries import QUERIES


def _same(df, rows):
    want = brute.word_dedup(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in window_dedup.window_dedup(df).collect()}
    assert got == want


def _random(rng, n, words, pieces):
    parts = [" \n"[rng.randint(0, 1)].join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(pieces)]
    return [(i, " ".join(" ".join(rng.choice(parts).split(" ")[rng.randint(0, 30):])
                         for _ in range(rng.randint(0, 5)))) for i in range(n)]


@pytest.mark.parametrize("words,pieces", [("ab", 10), ("a", 3), (("über", "x", "\xa0y"), 20)])
def test_random_texts(spark, rng, words, pieces):
    rows = _random(rng, 60, words, pieces)
    _same(frame(spark, rows, 4), rows)


def test_without_broadcasts(spark, rng, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = _random(rng, 60, "abc", 10)
    _same(frame(spark, rows, 4), rows)


def test_query_matches_brute_force(spark, pairs):
    want = brute.word_dedup(pairs)
    for r in QUERIES["op6_rabin_karp_dedup"](spark, SF).collect():
        assert (r.n_words, r.n_removed) == want[r.doc_id][:2]
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id][2].encode()).hexdigest()


def test_rows_without_id_are_told_apart(spark, rng):
    from pyspark.sql import functions as F
    words = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.substring(F.md5(F.concat("id", i)), 1, 5))
    texts = spark.range(300000).select(F.array_join(words, " ").alias("t"))
    twins = texts.groupBy(F.hash("t").alias("h")).agg(F.collect_set("t").alias("ts")).where("size(ts) > 1")
    a, b = twins.first().ts[:2]
    got = window_dedup.window_dedup(frame(spark, [(1, a), (None, a), (None, b)])).collect()
    assert sorted((r.doc_id or 0, r.kept, r.n_removed) for r in got) == sorted([(1, a, 0), (0, b, 0), (0, "", 60)])


def test_edge_rows(spark, edge, nothing):
    got = window_dedup.window_dedup(edge).collect()
    assert len(got) == len(EDGE_ROWS) and sum(r.n_removed for r in got) == 0
    assert window_dedup.window_dedup(nothing).count() == 0
