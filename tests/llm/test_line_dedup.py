"""op13: repeated lines against brute force."""
import hashlib
import re
from collections import defaultdict

import pytest
from llm_helpers import EDGE_ROWS, SF, frame
from pyspark.sql import functions as F

import brute
from tessera.llm import common, line_dedup
from tessera.llm.queries import QUERIES


def _key(line):
    return brute.lower_az(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line))


def _brute(rows, min_chars, min_docs):
    """Per row (n_lines, n_dropped, kept); documents in order of id, null last."""
    where = defaultdict(set)
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(_key(line)) >= min_chars:
                where[_key(line)].add(i)
    last = {k: max(rows[i][0] for i in s) for k, s in where.items() if len(s) >= min_docs}
    out = {}
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(_key(x), d) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def _got(df, **options):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.line_dedup(df, **options).collect()}


def _random(rng, n, lines):
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 200)))) for i in range(n)]


LINES = ["", " ", "a long line", "A Long Line ", "\ta LONG line\r", "Étoile ÉTOILE x", "étoile Étoile x", "unique", "b" * 50]


@pytest.mark.parametrize("segment", [20000, 3])
def test_random_lines(spark, rng, monkeypatch, segment):
    monkeypatch.setattr(line_dedup, "SEGMENT", segment)
    rows = _random(rng, 60, LINES + [f"line of number {i}" for i in range(300)])
    assert _got(frame(spark, rows, 4), min_chars=8, min_docs=5) == _brute(rows, 8, 5)


def test_without_broadcasts(spark, rng, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = _random(rng, 40, LINES)
    assert _got(frame(spark, rows, 4), min_chars=6, min_docs=3) == _brute(rows, 6, 3)


def test_thresholds(spark):
    """39 or 40 code points (not bytes), 4 or 5 documents."""
    rows = [(i, "\n".join(["é" * 40, "é" * 39] + ["x" * 60] * (i < 4))) for i in range(5)]
    got = _got(frame(spark, rows))
    assert got[4] == (2, 0, rows[4][1]) and got[0] == (3, 1, "\n".join(["é" * 39, "x" * 60]))


def test_null_and_repeated_ids(spark):
    """Rows without an id are documents of their own; a line stays in one text."""
    same = "the same line of at least forty code points"
    rows = [(None, f"{same}\nown {i}") for i in range(6)] + [(3, f"{same}\nfirst"), (3, f"{same}\nsecond"), (3, f"{same}\nsecond")]
    got = [(r.doc_id, r.n_dropped, r.kept) for r in line_dedup.line_dedup(frame(spark, rows)).collect()]
    assert len(got) == 9 and sum(same in kept for _, _, kept in got) == 1
    assert [d for d, n, _ in got if not n] == [None]
    assert sorted(kept for d, _, kept in got if d == 3) == ["first", "second", "second"]


def test_hot_line_and_long_text(spark):
    hot = "a line that a third of all the documents hold"
    rows = [(i, "\n".join([f"number {i}", hot, "end"])) for i in range(2000)] + [(9999, "\n".join([hot] * 50000))]
    got = _got(frame(spark, rows))
    assert got[9999][:2] == (50000, 0) and all(got[i][1:] == (1, f"number {i}\nend") for i in range(2000))


def test_bitmaps_hold_only_words_that_lose_lines(spark):
    shared = "x" * 45
    rows = [(i, "\n".join([f"{i}-{k}" for k in range(130)] + [shared])) for i in range(6)]
    keep = {r.doc_id: r.keep for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert keep[5] == [] and [(w.word, w.bits) for w in keep[0]] == [(2, ~(1 << 2))]


def test_no_python_on_executors(docs):
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_matches_brute_force(spark, pairs):
    want = _brute(pairs, 40, 5)
    for r in QUERIES["op13_line_dedup"](spark, SF).collect():
        assert (r.n_lines, r.n_dropped) == want[r.doc_id][:2]
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id][2].encode()).hexdigest()


def test_edge_rows(edge, nothing):
    got = line_dedup.line_dedup(edge.select("*", F.lit(0).alias("h1"), F.lit(0).alias("keep"))).collect()
    assert len(got) == len(EDGE_ROWS) and all(r.n_dropped == 0 and r.keep == [] for r in got)
    assert {(r.n_lines, r.kept) for r in got if r.doc_id in (1, 2)} == {(1, "")}
    assert line_dedup.line_dedup(nothing).count() == 0
