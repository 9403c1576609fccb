"""op8: near-duplicate components against comparing every pair."""
import brute
import numpy as np
import pytest
from llm_helpers import EDGE_ROWS, SF, frame

from tessera.llm import components, hyperminhash as hm
from tessera.llm.queries import QUERIES


def _same(got, rows):
    want = brute.near_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


def _families(rng, plan):
    vocabulary, rows = [f"w{i}" for i in range(2000)], []
    for members, words, p in plan:
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(members):
            rows.append((len(rows), " ".join(rng.choice(vocabulary) if rng.random() < p else w for w in base)))
    return rows


@pytest.mark.parametrize("block", [256, 16])
def test_families_near_the_threshold(spark, rng, monkeypatch, block):
    monkeypatch.setattr(hm, "BLOCK_ROWS", block)
    rows = _families(rng, [(60, 200, .03), (50, 60, .04), (40, 12, .08), (20, 3, .2), (30, 400, .045)])
    _same(hm.near_duplicates(frame(spark, rows, 5)).collect(), rows)


def test_estimate_is_close_to_jaccard():
    rng = np.random.RandomState(3)
    off = []
    for j in (0.2, 0.5, 0.85, 0.95):
        for _ in range(10):
            n = 2000
            both = int(n * j)
            a = rng.randint(0, 2**63, both + (n - both) // 2, dtype=np.int64).astype(np.uint64)
            b = np.concatenate([a[:both], rng.randint(0, 2**63, (n - both) // 2, dtype=np.int64).astype(np.uint64)])
            s = hm.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            off.append(hm.likeness(s[0], s[1]) - both / (len(a) + len(b) - both))
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.18


def test_components_of_chains_and_cycles(spark, rng):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}}


def test_query_matches_brute_force(spark, pairs):
    _same(QUERIES["op8_hyperminhash_dedup"](spark, SF).collect(), pairs)


def test_edge_rows(spark, edge, nothing):
    got = hm.near_duplicates(edge).collect()
    assert len(got) == len(EDGE_ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_shingles == 0 and by_id[1].kept and by_id[5].component_id == 4 and not by_id[5].kept
    assert by_id[None].component_id is None
    assert hm.near_duplicates(nothing).count() == 0
