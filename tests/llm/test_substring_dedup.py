"""op4: LCP merge and substring removal against brute force."""
import hashlib

import brute
import pytest
from llm_helpers import EDGE_ROWS, SF, frame

from tessera.llm import suffix_dedup as sd
from tessera.llm.queries import QUERIES


def _same(df, rows):
    want = brute.byte_dedup(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.substring_dedup(df).collect()}
    assert got == want


def _random(rng, n, letters, pieces):
    parts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 260))) for _ in range(pieces)]
    return [(i, "".join(rng.choice(parts)[rng.randint(0, 30):] for _ in range(rng.randint(0, 5)))) for i in range(n)]


def test_loser_tree_merges_with_lcps(rng):
    for k in (1, 2, 3, 7, 16):
        runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode()
                       for _ in range(rng.randint(0, 40))) for _ in range(k)]
        coded = [(r, sd._prefixes(r).tolist()) for r in runs]
        got = [(runs[w][i], lcp) for w, i, lcp in sd.merge_runs(coded)]
        assert [x for x, _ in got] == sorted(sum(runs, []))
        for (x, _), (y, lcp) in zip(got, got[1:]):
            n = 0
            while n < min(len(x), len(y)) and x[n] == y[n]:
                n += 1
            assert lcp == n


def test_front_coding_round_trip(rng):
    import numpy as np
    keys = sorted(bytes(rng.randint(97, 99) for _ in range(rng.randint(1, 150))) for _ in range(300))
    places = np.zeros(300, sd.PLACE)
    got, prefixes, _ = sd.decode_run(sd.encode_run(keys, sd._prefixes(keys), places))
    assert got == keys and prefixes == sd._prefixes(keys).tolist()


@pytest.mark.parametrize("letters,pieces", [("ab", 12), ("a", 4), ("abcé", 25), ("abcdefgh ", 3)])
def test_random_texts(spark, rng, letters, pieces):
    rows = _random(rng, 60, letters, pieces)
    _same(frame(spark, rows, 4), rows)


def test_without_a_gram_filter(spark, rng, monkeypatch):
    monkeypatch.setattr(sd, "FILTER_BYTES", -1)
    rows = _random(rng, 50, "abcd", 12)
    _same(frame(spark, rows, 4), rows)


@pytest.mark.parametrize("before,after", [(60, 60), (0, 70)])
def test_hot_line_in_differing_contexts(spark, rng, before, after):
    hot = "All rights reserved by the authors of this document, whoever they may be. "
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, before))) + hot
             + "".join(rng.choice("ab") for _ in range(rng.randint(0, after)))) for i in range(300)]
    _same(frame(spark, rows, 4), rows)


def test_query_matches_brute_force(spark, pairs):
    want = brute.byte_dedup(pairs)
    for r in QUERIES["op4_suffix_array_dedup"](spark, SF).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans) == want[r.doc_id][:3]
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id][3]).hexdigest()


def hash_twins(spark):
    """Two different texts with one 32-bit hash."""
    from pyspark.sql import functions as F
    texts = spark.range(300000).select(F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(5)]).alias("t"))
    twins = texts.groupBy(F.hash("t").alias("h")).agg(F.collect_set("t").alias("ts")).where("size(ts) > 1")
    return twins.first().ts[:2]


def test_rows_without_id_are_told_apart(spark):
    """Three null-id rows, two of them copies; the third shares their 32-bit hash."""
    a, b = hash_twins(spark)
    rows = [(1, a), (None, a), (None, b)]
    got = sorted((r.doc_id or 0, r.kept_text, r.n_removed) for r in sd.substring_dedup(frame(spark, rows)).collect())
    assert got == sorted([(1, a, 0), (0, b, 0), (0, "", len(a))])


def test_edge_rows(spark, edge, nothing):
    got = sd.substring_dedup(edge, keep=("k", "spans")).collect()
    assert len(got) == len(EDGE_ROWS)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].kept_text is None and by_id[2].kept_text == ""
    assert by_id[9].n_removed == 20000 - 100 + 0 or by_id[9].n_removed == 19999
    assert by_id[5].n_removed == 0
    assert sd.substring_dedup(nothing).count() == 0
