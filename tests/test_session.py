"""Shared-folder handling: checkpoints and written tables go under spark.checkpoint.dir."""
from tessera.session import ensure_checkpoint_dir, local_path, scratch_path


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base.rstrip("/")) and a != b
    assert not local_path("file:/tmp/a").startswith("file:")


def test_checkpoint_cuts_lineage(spark):
    from tessera.operators.joins import materialize
    df = spark.range(10).selectExpr("id * 2 AS v")
    m = materialize(df)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and sorted(r.v for r in m.collect()) == list(range(0, 20, 2))
