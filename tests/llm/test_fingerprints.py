"""op1: fingerprints against exact Jaccard similarity."""
import hashlib

import brute
import pytest
from llm_helpers import EDGE_ROWS, frame

from tessera.llm import minhash
from tessera.llm.queries import QUERIES

from llm_helpers import SF


def _exact(a, b, k=5):
    def sets(t):
        w = brute.SPACE.findall(t or "")
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    a, b = sets(a), sets(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def test_query_matches_brute_force(spark, pairs):
    got = {r.doc_id: r for r in QUERIES["op1_minhash_fingerprints"](spark, SF).collect()}
    edited, by_text, off = brute.edited(pairs), {}, []
    assert len(got) == len(pairs)
    ids = sorted(i for i, _ in pairs)
    text = dict(pairs)
    for n, i in enumerate(ids):
        g = got[i]
        assert g.n_chars == len(text[i])
        assert g.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert by_text.setdefault(text[i], g.fingerprint) == g.fingerprint
        off.append(abs(g.near_edited - _exact(text[i], edited[i])))
        off.append(abs(g.near_next - _exact(text[i], text[ids[(n + 1) % len(ids)]])))
    assert max(off) < 0.22 and sum(off) / len(off) < 0.04     # 128 registers: standard error up to 0.044


def test_edge_rows(spark, edge, nothing):
    got = minhash.edit_fingerprints(edge).collect()
    assert len(got) == len(EDGE_ROWS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert minhash.edit_fingerprints(nothing).count() == 0
    assert minhash.fingerprints(edge).count() == len(EDGE_ROWS)


def test_single_document_follows_itself(spark):
    r = minhash.edit_fingerprints(frame(spark, [(1, "abcdefgh")])).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0


@pytest.mark.parametrize("block", [256, 16])
def test_near_pairs_match_brute_force(spark, rng, monkeypatch, block):
    """Copies, near copies and chance pairs anywhere in the table; null and repeated ids."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    words = [f"w{i}" for i in range(500)]
    bases = [[rng.choice(words) for _ in range(n)] for n in (200, 60, 12, 3)]
    texts = [" ".join(bases[0])] * 80 + [None, "", "one"]
    for base in bases:
        for _ in range(30):
            w = list(base)
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, max(1, len(w) // 12))] = [rng.choice(words)]
            texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = [(None if n % 9 == 0 else n // 2, t) for n, t in enumerate(texts)]
    sets = [brute.shingle_set(t, 5) for _, t in rows]
    want = []
    for n, (i, _) in enumerate(rows):
        same = [j for m, (j, _) in enumerate(rows) if sets[m] == sets[n] and j is not None]
        links = sum(1 for m, s in enumerate(sets) if m != n and s and sets[n] and 10 * len(s & sets[n]) >= 8 * len(s | sets[n]))
        want.append((i, len(sets[n]), min(same, default=None) if sets[n] else i, links))
    got = [tuple(r) for r in minhash.near_pairs(frame(spark, rows, 5)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_near_pairs_of_an_empty_table(spark, nothing):
    assert minhash.near_pairs(nothing).count() == 0
