"""RGB -> LAB / HSV expressions, LAB -> RGB inverse, colour lookup (fixture X17)."""
import colorsys

import pytest
from pyspark.sql import functions as F

from tessera.functions.colour import (COLOUR_RGB, colour_table, lab_to_rgb_cols, rgb_to_hsv,
                                      rgb_to_lab)


def _rgb(spark, data):
    return spark.createDataFrame(data, "R int, G int, B int")


def test_black_white_grey_lab(spark):
    out = rgb_to_lab(_rgb(spark, [(0, 0, 0), (255, 255, 255), (128, 128, 128)])).collect()
    by = {(r.R, r.G, r.B): (r.labL, r.labA, r.labB) for r in out}
    assert by[(0, 0, 0)] == pytest.approx((0.0, 0.0, 0.0), abs=1e-9)     # double 16/116, not decimal
    assert by[(255, 255, 255)] == pytest.approx((100.0, 0.0, 0.0), abs=5e-3)
    assert by[(128, 128, 128)][1:] == pytest.approx((0.0, 0.0), abs=5e-3)


def test_hsv_matches_colorsys_including_ties(spark):
    data = [(255, 0, 0), (255, 255, 0), (255, 0, 255), (0, 255, 255), (10, 200, 30),
            (200, 10, 30), (30, 10, 200), (90, 90, 90), (0, 0, 0), (255, 255, 255), (120, 120, 30)]
    out = rgb_to_hsv(_rgb(spark, data)).collect()
    for r in out:
        exp = colorsys.rgb_to_hsv(r.R / 255, r.G / 255, r.B / 255)
        assert (r.H, r.S, r.V) == pytest.approx(exp, abs=1e-12), (r.R, r.G, r.B)


def test_lab_round_trip(spark):
    data = [(255, 0, 0), (0, 230, 0), (0, 0, 255), (117, 60, 0), (150, 150, 150), (10, 20, 30)]
    lab = rgb_to_lab(_rgb(spark, data))
    back = lab.select("R", "G", "B", *[(c * 255).alias(n) for c, n in
                                     zip(lab_to_rgb_cols(F.col("labL"), F.col("labA"), F.col("labB")),
                                         ("r2", "g2", "b2"))])
    for r in back.collect():
        assert (r.r2, r.g2, r.b2) == pytest.approx((r.R, r.G, r.B), abs=0.05)


def test_lookup_table_has_all_eleven_words(spark):
    t = colour_table(spark)
    assert t.count() == 11 and sorted(r.word for r in t.collect()) == sorted(COLOUR_RGB)
