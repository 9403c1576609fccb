"""Streaming regression: several files, one micro-batch each; restart from
the checkpoint processes only new files (no double counting)."""
import os

import pytest

from tessera.streaming.regression import (latest_result, parse_points, running_fit,
                                          run_file_stream)


def _write(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


def _batch(spark, src):
    return running_fit(parse_points(spark.read.text(src))).collect()[0]


def test_stream_equals_batch_and_restart_does_not_double_count(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src, "a.txt", ["1 3", "2 5", "3 7.5"])
    _write(src, "b.txt", ["4 9", "oops", "5 x"])        # malformed text is skipped
    _write(src, "c.txt", [])                             # empty file
    res = run_file_stream(spark, src, out, ckpt, files_per_batch=1).collect()[0]
    exp = _batch(spark, src)
    assert res.n == 4 == exp.n
    assert res.slope == pytest.approx(exp.slope) and res.intercept == pytest.approx(exp.intercept)
    batches = {int(p.split("=")[1]) for p in os.listdir(out) if p.startswith("batch_id=")}
    assert len(batches) >= 2
    _write(src, "d.txt", ["6 13"])
    res2 = run_file_stream(spark, src, out, ckpt).collect()[0]
    exp2 = _batch(spark, src)
    assert res2.n == 5 == exp2.n
    assert res2.slope == pytest.approx(exp2.slope)


def test_constant_x_gives_null_slope(spark):
    df = spark.createDataFrame([("2 1",), ("2 5",)], "value string")
    r = running_fit(parse_points(df)).collect()[0]
    assert r.n == 2 and r.slope is None and r.intercept is None


def test_memory_sink_update_mode(spark, tmp_path):
    from tessera.streaming.regression import start_regression_stream
    src = str(tmp_path / "in")
    _write(src, "a.txt", ["1 2", "2 4", "3 6"])
    q = start_regression_stream(spark, "text", {}, None, str(tmp_path / "ck"), path=src, sink="memory")
    q.awaitTermination(120)
    r = spark.sql("SELECT * FROM regression").collect()[-1]
    assert r.n == 3 and r.slope == pytest.approx(2.0) and r.intercept == pytest.approx(0.0)


def test_timeout_raises_instead_of_a_partial_fit(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(40):
        _write(src, f"{i}.txt", [f"{i} {2 * i}"])
    with pytest.raises(TimeoutError):
        run_file_stream(spark, src, str(tmp_path / "out"), str(tmp_path / "ck"), files_per_batch=1, timeout_s=1)


def test_fit_far_from_the_origin(spark):
    """x near 1e9: exact integer arithmetic against the running moments."""
    from fractions import Fraction
    df = spark.range(20000).selectExpr("cast(id + 1000000000 AS double) AS x",
                                       "cast(3 * (id + 1000000000) + id % 7 AS double) AS y").repartition(5)
    n, sx, sy, sxx, sxy = 20000, 0, 0, 0, 0
    for i in range(n):
        x, y = i + 10**9, 3 * (i + 10**9) + i % 7
        sx, sy, sxx, sxy = sx + x, sy + y, sxx + x * x, sxy + x * y
    slope = Fraction(n * sxy - sx * sy, n * sxx - sx * sx)
    r = running_fit(df).first()
    assert r.slope == pytest.approx(float(slope), rel=5e-9)
    # 1e9 away from the data: one part in 1e9 of the slope is worth 1 here
    assert r.intercept == pytest.approx(float((sy - slope * sx) / n), abs=1.0)


def test_correlation_of_huge_values(spark):
    """Sums of squares past 1e38 neither overflow nor fail."""
    from tessera.functions.stats import pearson
    df = spark.range(1000).selectExpr("id AS x", "cast(id AS decimal(38,0)) * 500000000000000000 + id % 3 AS y")
    r = pearson(df, "x", "y").first()
    assert r.n == 1000 and r.r == pytest.approx(1.0)
    assert pearson(df.selectExpr("x", "1 AS y"), "x", "y").first().r is None
