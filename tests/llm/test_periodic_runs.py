"""op12: periodic runs against brute force."""
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import EDGE_ROWS, SF, frame

import brute
from tessera.llm.periodic_runs import collapse, find_runs, periodic_runs, planted, runs_digest, surviving_segments
from tessera.llm.queries import QUERIES


def _smallest_period(x):
    return next(q for q in range(1, len(x) + 1) if all(x[i] == x[i + q] for i in range(len(x) - q)))


def _brute(words):
    """Every maximal stretch of every period, kept if that is its smallest."""
    runs, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and _smallest_period(words[i:j + q]) == q:
                runs.append((i, length, q))
            i = j + 1
    return sorted(runs)


def _brute_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]


PIECE = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 9))


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECE, max_size=8))
def test_runs_of_random_words(pieces):
    words = [w for part, n in pieces for w in part * n]
    runs = find_runs(words)
    assert runs == _brute(words)
    assert collapse(words, runs) == _brute_collapsed(words, runs)


def test_runs_of_fibonacci_and_random_words():
    a, b = ["x"], ["x", "y"]
    while len(b) < 400:
        a, b = b, b + a
    rng = np.random.default_rng(5)
    for words in (b, list(rng.choice(["a", "b"], 600)), list(rng.choice(["a", "b"], 600, p=[.9, .1]))):
        assert find_runs(words) == _brute(words)


def test_segments_are_stable():
    codes = np.array([0, 0, 0, 0, 0, 0, 9, 1, 2, 1, 2, 1, 2, 1, 2, 8, 0, 1, 0, 1, 0])
    assert surviving_segments(codes) == [(0, 6), (7, 15)]
    assert surviving_segments(np.arange(50)) == [] == surviving_segments(np.zeros(0, int))


def test_long_texts():
    """A million words: one period, one word, and none."""
    part = [str(i) for i in range(1000)]
    assert find_runs(part * 1000) == [(0, 1000000, 1000)]
    assert find_runs(["w"] * 1000000) == [(0, 1000000, 1)]
    assert find_runs([str(i // 2) for i in range(1000000)]) == []


def test_query_matches_brute_force(spark, pairs):
    want = {}
    for d, text in pairs:
        words = planted(brute.SPACE.findall(text or ""), d)
        if len(words) > 2500:  # too long for the brute version
            continue
        runs = _brute(words)
        s, m, q = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        want[d] = (len(runs), s, m, q, m and 1000 * m // q, runs_digest(runs),
                   hashlib.sha256(" ".join(_brute_collapsed(words, runs)).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(pairs) and len(want) > 150 and any(w[0] for w in want.values())
    assert {d: got[d] for d in want} == want


@pytest.mark.parametrize("doc_id", [3, 20, None])
def test_planting(doc_id):
    from zlib import crc32
    words = [str(i) for i in range(97)]
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    want = list(words)
    if h % 10 == 0:
        a, n = h // 10 % 97, 97
        p = 1 + (n - a) // (3 + h // 10 % 8)
        want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    assert planted(words, doc_id) == want and planted([], doc_id) == []
    assert any(planted(words, d) != words for d in range(50))


def test_edge_rows(spark, edge, nothing):
    got = periodic_runs(edge).collect()
    assert len(got) == len(EDGE_ROWS)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[8].n_words, by_id[8].start, by_id[8].length, by_id[8].period) == (30000, 0, 30000, 1)
    assert by_id[8].collapsed == "word" and by_id[8].exponent_milli == 30000000
    for d in (1, 2, 3):
        assert (by_id[d].n_words, by_id[d].n_runs, by_id[d].start, by_id[d].runs, by_id[d].collapsed) == (0, 0, None, [], "")
    assert by_id[10].collapsed == "a1 🙂 ß Σ\x00"
    assert periodic_runs(nothing).count() == 0


def test_words_split_at_ascii_blanks_only(spark):
    row = periodic_runs(frame(spark, [(1, "a\xa0b\x1cc\x85d\ve\ff")])).first()
    assert (row.n_words, row.collapsed) == (3, "a\xa0b\x1cc\x85d e f")
