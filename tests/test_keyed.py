"""Keyed table: partial rewrites, key-pruned reads, concurrent writers, streams."""
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.keyed import BUCKET, ConcurrentWrite, KeyedTable
from tessera.session import local_path
from tessera.streaming.upserts import merge_batches, upsert_file_stream

from conftest import rows

SCHEMA = "host string, id string, ver int, payload string"


def _frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _table(spark, path, buckets=16):
    return KeyedTable.create(spark, str(path), _frame(spark, []).schema, ["host", "id"], ["ver"], buckets)


def _files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in (root / "data").rglob("*.parquet")}


def _many(n=400, ver=1):
    return [(f"h{i % 7}", f"k{i}", ver, f"p{i}-{ver}") for i in range(n)]


def test_two_upserts_and_a_rerun(spark, tmp_path):
    t = _table(spark, tmp_path / "t")
    assert t.read().count() == 0
    assert t.upsert(_frame(spark, _many()))
    newer = [("h1", "k1", 3, "a"), ("h1", "k1", 2, "b"), ("h2", "k2", 0, "too old"), ("h0", "new", 1, "x"), (None, "n", 1, "y")]
    for _ in range(2):
        t.upsert(_frame(spark, newer))
        want = {(h, k): (h, k, v, p) for h, k, v, p in _many()}
        want.update({("h1", "k1"): ("h1", "k1", 3, "a"), ("h0", "new"): ("h0", "new", 1, "x"), (None, "n"): (None, "n", 1, "y")})
        assert rows(t.read()) == sorted(want.values(), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_untouched_files_stay(spark, tmp_path):
    t = _table(spark, tmp_path / "t")
    t.upsert(_frame(spark, _many()))
    before, files = _files(tmp_path / "t"), t.manifest()["files"]
    t.upsert(_frame(spark, [("h1", "k1", 2, "new")]))
    after, now = _files(tmp_path / "t"), t.manifest()["files"]
    assert {k: after[k] for k in before} == before            # nothing is rewritten in place
    assert len(after) == len(before) + 1                       # and one bucket is written anew
    assert len(files) == 16 and sum(files[b] != now[b] for b in files) == 1


def test_reads_only_the_buckets_of_the_keys(spark, tmp_path):
    t = _table(spark, tmp_path / "t")
    t.upsert(_frame(spark, _many()))
    one = t.get("h1", "k1")
    assert len(one.inputFiles()) == 1 and rows(one) == [("h1", "k1", 1, "p1-1")]
    assert "EqualNullSafe(host,h1)" in one._jdf.queryExecution().toString()  # and row groups by the sorted key
    some = t.lookup(_frame(spark, [("h1", "k1", 0, ""), ("h1", "k1", 0, ""), ("h3", "k3", 0, ""), ("h3", "none", 0, "")]))
    assert len(some.inputFiles()) <= 3 and rows(some, "id") == [("k1",), ("k3",)]
    assert t.lookup(_frame(spark, [])).count() == 0 and t.get("h1", None).count() == 0


def test_one_file_sorted_by_key_in_each_bucket(spark, tmp_path):
    t = _table(spark, tmp_path / "t", 4)
    t.upsert(_frame(spark, random.Random(1).sample(_many(1000), 1000)))
    for b in range(4):
        folder = local_path(f"{t.root}/data/{t.manifest()['files'][str(b)]}/{BUCKET}={b}")
        keys = [(r.host, r.id) for r in spark.read.parquet(folder).coalesce(1).collect()]
        assert keys == sorted(keys) and len(spark.read.parquet(folder).inputFiles()) == 1


def test_second_of_two_writers_fails_and_changes_nothing(spark, tmp_path, monkeypatch):
    t, other = _table(spark, tmp_path / "t"), KeyedTable(spark, str(tmp_path / "t"))
    t.upsert(_frame(spark, _many(20)))
    late = other.version()
    t.upsert(_frame(spark, [("h1", "k1", 5, "first")]))
    monkeypatch.setattr(other, "version", lambda: late)  # it started before the other one's commit
    with pytest.raises(ConcurrentWrite):
        other.upsert(_frame(spark, [("h1", "k1", 9, "lost")]))
    assert rows(t.get("h1", "k1"), "payload") == [("first",)]
    assert not list((tmp_path / "t" / "manifest").glob(".0*[!c]"))


def test_overwrite_needs_confirmation(spark, tmp_path):
    t = _table(spark, tmp_path / "t")
    t.upsert(_frame(spark, _many(50)))
    with pytest.raises(ValueError):
        t.overwrite(_frame(spark, _many(3)))
    t.overwrite(_frame(spark, _many(3) + _many(3, 2)), confirm_truncate=True)
    assert rows(t.read(), "id", "ver") == [("k0", 2), ("k1", 2), ("k2", 2)]
    t.overwrite(_frame(spark, []), confirm_truncate=True)
    assert t.read().count() == 0 and t.read(version=1).count() == 50


def test_vacuum_keeps_what_the_table_needs(spark, tmp_path):
    t = _table(spark, tmp_path / "t", 2)
    for ver in (1, 2, 3):
        t.upsert(_frame(spark, _many(50, ver)))
    before = rows(t.read())
    assert len(t.vacuum()) == 2 and t.vacuum() == []
    assert rows(t.read()) == before


def test_definition_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable.create(spark, str(tmp_path / "t"), _frame(spark, []).schema, ["nokey"], ["ver"])
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, str(tmp_path / "t")).read()
    _table(spark, tmp_path / "t")
    with pytest.raises(FileExistsError):
        _table(spark, tmp_path / "t")


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    t = _table(spark, tmp_path / "t")
    merge = merge_batches(t.root, "loader")
    merge(_frame(spark, _many(30)), 0)
    merge(_frame(spark, [("h1", "k1", 2, "new")]), 1)
    version, want = t.version(), rows(t.read())
    merge(_frame(spark, [("h1", "k1", 9, "replayed")]), 1)
    merge(_frame(spark, [("h1", "k1", 9, "replayed")]), 0)
    assert t.version() == version and rows(t.read()) == want
    merge_batches(t.root, "other")(_frame(spark, [("h1", "k1", 9, "other writer")]), 0)
    assert rows(t.get("h1", "k1"), "payload") == [("other writer",)]


def test_stream_restarted_without_its_progress(spark, tmp_path):
    """The stream's own checkpoint is lost after the table's commit: all files
    come again under the same batch ids, and the table stays as it is."""
    t = _table(spark, tmp_path / "t")
    _frame(spark, _many(100)).repartition(5).write.parquet(str(tmp_path / "in"))
    schema = _frame(spark, []).schema
    first = rows(upsert_file_stream(spark, str(tmp_path / "in"), schema, t.root, "w", str(tmp_path / "c1"), 2))
    version = t.version()
    assert first == sorted(_many(100)) and version == 3
    assert rows(upsert_file_stream(spark, str(tmp_path / "in"), schema, t.root, "w", str(tmp_path / "c2"), 2)) == first
    assert t.version() == version
    _frame(spark, _many(10, 2)).write.mode("append").parquet(str(tmp_path / "in"))
    again = upsert_file_stream(spark, str(tmp_path / "in"), schema, t.root, "w", str(tmp_path / "c1"), 2)
    assert sum(r.ver == 2 for r in again.collect()) == 10


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from("xyz"), st.integers(0, 4),
                                   st.sampled_from("pq")), max_size=15), min_size=1, max_size=3))
def test_any_batches_equal_last_write_wins(spark, tmp_path_factory, batches):
    t = _table(spark, tmp_path_factory.mktemp("k") / "t", 3)
    best = {}
    for batch in batches:
        t.upsert(_frame(spark, batch))
        for r in batch:
            if r[:2] not in best or r[2:] > best[r[:2]][2:]:
                best[r[:2]] = r
    assert rows(t.read()) == sorted(best.values(), key=lambda r: tuple((x is None, str(x)) for x in r))
