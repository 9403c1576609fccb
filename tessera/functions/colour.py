"""RGB <-> CIE LAB (D65, 2 degree observer) and RGB -> HSV as column expressions.

All constants are doubles (a decimal ``16./116`` would be cut to 6 digits
and push black off L=0).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# sRGB linearisation threshold/offset/slope, gamma 2.4.
LIN_THRESHOLD, LIN_OFFSET, LIN_SCALE, LIN_SLOPE, GAMMA = 0.04045, 0.055, 1.055, 12.92, 2.4
# Linear RGB -> XYZ matrix (rows X, Y, Z).
XYZ_FROM_RGB = ((0.412453, 0.357580, 0.180423),
                (0.212671, 0.715160, 0.072169),
                (0.019334, 0.119193, 0.950227))
# D65 reference white, 2 degree observer (Y = 1).
WHITE_X, WHITE_Z = 0.95047, 1.08883
# LAB companding: t > 0.008856 -> t^(1/3), else 7.787 t + 16/116;
# inverse threshold 0.2068966; output sRGB threshold 0.0031308.
LAB_EPS, LAB_KAPPA, INV_EPS, OUT_THRESHOLD = 0.008856, 7.787, 0.2068966, 0.0031308
# Representative RGB for each of the 11 colour words.
COLOUR_RGB = {
    "red": (255, 0, 0),
    "orange": (255, 114, 0),
    "yellow": (255, 255, 0),
    "green": (0, 230, 0),
    "blue": (0, 0, 255),
    "purple": (187, 0, 187),
    "brown": (117, 60, 0),
    "pink": (255, 187, 187),
    "black": (0, 0, 0),
    "grey": (150, 150, 150),
    "white": (255, 255, 255),
}
# ---------------------------------------------------------------------------

# XYZ -> linear RGB is the inverse of the matrix above (computed, not typed).
RGB_FROM_XYZ = tuple(tuple(float(v) for v in row) for row in np.linalg.inv(np.array(XYZ_FROM_RGB)))


def _lit(x: float) -> Column:
    return F.lit(float(x))


def _linearise(c: Column) -> Column:
    return F.when(c > LIN_THRESHOLD, F.pow((c + _lit(LIN_OFFSET)) / _lit(LIN_SCALE), _lit(GAMMA))) \
            .otherwise(c / _lit(LIN_SLOPE))


def _lab_f(t: Column) -> Column:
    return F.when(t > LAB_EPS, F.pow(t, _lit(1.0 / 3))) \
            .otherwise(_lit(LAB_KAPPA) * t + _lit(16.0 / 116))


def rgb_to_lab_cols(r: Column, g: Column, b: Column, input_bytes: bool = True):
    """(L, a, b) columns from R, G, B (0-255 ints, or 0-1 floats)."""
    if input_bytes:
        r, g, b = (c / _lit(255.0) for c in (r, g, b))
    r2, g2, b2 = _linearise(r), _linearise(g), _linearise(b)
    m = XYZ_FROM_RGB
    x1 = (r2 * m[0][0] + g2 * m[0][1] + b2 * m[0][2]) / _lit(WHITE_X)
    y1 = (r2 * m[1][0] + g2 * m[1][1] + b2 * m[1][2])
    z1 = (r2 * m[2][0] + g2 * m[2][1] + b2 * m[2][2]) / _lit(WHITE_Z)
    x2, y2, z2 = _lab_f(x1), _lab_f(y1), _lab_f(z1)
    return (_lit(116.0) * y2 - _lit(16.0), _lit(500.0) * (x2 - y2), _lit(200.0) * (y2 - z2))


def rgb_to_lab(df: DataFrame, r: str = "R", g: str = "G", b: str = "B",
               out_l: str = "labL", out_a: str = "labA", out_b: str = "labB",
               input_bytes: bool = True) -> DataFrame:
    """Append LAB columns (all other columns pass through)."""
    lab = rgb_to_lab_cols(F.col(r), F.col(g), F.col(b), input_bytes)
    return df.withColumns({out_l: lab[0], out_a: lab[1], out_b: lab[2]})


def lab_statement(passthrough: tuple[str, ...] = (), r: str = "R", g: str = "G", b: str = "B",
                  source: str = "__THIS__") -> str:
    """The same conversion as SQL text over ``source``: labL, labA, labB and
    the passed-through columns.  ``__THIS__`` is the input of a SQL stage."""
    def num(x: float) -> str:
        return f"{float(x)!r}D"

    def linear(c: str) -> str:
        c = f"(`{c}` / {num(255)})"
        return (f"CASE WHEN {c} > {num(LIN_THRESHOLD)} THEN power(({c} + {num(LIN_OFFSET)}) / {num(LIN_SCALE)}, {num(GAMMA)}) "
                f"ELSE {c} / {num(LIN_SLOPE)} END")

    def mixed(row, white: float) -> str:
        return f"({' + '.join(f'{c} * {num(v)}' for c, v in zip(('_r', '_g', '_b'), row))}) / {num(white)}"

    def companded(t: str) -> str:
        return f"CASE WHEN {t} > {num(LAB_EPS)} THEN power({t}, {num(1.0 / 3)}) ELSE {num(LAB_KAPPA)} * {t} + {num(16.0 / 116)} END"

    kept = "".join(f"`{c}`, " for c in passthrough)
    steps = [", ".join(f"{linear(c)} AS {n}" for c, n in ((r, "_r"), (g, "_g"), (b, "_b"))),
             ", ".join(f"{mixed(row, w)} AS {n}" for row, w, n in zip(XYZ_FROM_RGB, (WHITE_X, 1.0, WHITE_Z), ("_x", "_y", "_z"))),
             ", ".join(f"{companded(c)} AS {c}" for c in ("_x", "_y", "_z")),
             f"{num(116)} * _y - {num(16)} AS labL, {num(500)} * (_x - _y) AS labA, {num(200)} * (_y - _z) AS labB"]
    for step in steps:
        source = f"(SELECT {kept}{step} FROM {source})"
    return source[1:-1]


def rgb_to_hsv_cols(r: Column, g: Column, b: Column, input_bytes: bool = True):
    """(H, S, V) in [0, 1]; a grey (delta 0) has H = S = 0.

    Hue sector from whichever channel holds the maximum (red first, then
    green), as sixths of a turn, wrapped into [0, 1).
    """
    if input_bytes:
        r, g, b = (c / _lit(255.0) for c in (r, g, b))
    mx = F.greatest(r, g, b)
    delta = mx - F.least(r, g, b)
    sector = (F.when(delta == 0, _lit(0.0))
               .when(mx == r, (g - b) / delta)
               .when(mx == g, _lit(2.0) + (b - r) / delta)
               .otherwise(_lit(4.0) + (r - g) / delta))
    hue = sector / _lit(6.0)
    h = F.when(hue < 0, hue + _lit(1.0)).otherwise(hue)
    s = F.when(delta == 0, _lit(0.0)).otherwise(delta / mx)
    return h, s, mx


def rgb_to_hsv(df: DataFrame, r: str = "R", g: str = "G", b: str = "B",
               h: str = "H", s: str = "S", v: str = "V", input_bytes: bool = True) -> DataFrame:
    hsv = rgb_to_hsv_cols(F.col(r), F.col(g), F.col(b), input_bytes)
    return df.withColumns({h: hsv[0], s: hsv[1], v: hsv[2]})


def _lab_f_inv(t: Column) -> Column:
    return F.when(t > INV_EPS, F.pow(t, _lit(3.0))) \
            .otherwise((t - _lit(16.0 / 116)) / _lit(LAB_KAPPA))


def _gamma_out(c: Column) -> Column:
    v = F.when(c > OUT_THRESHOLD, _lit(LIN_SCALE) * F.pow(c, _lit(1 / GAMMA)) - _lit(LIN_OFFSET)) \
         .otherwise(c * _lit(LIN_SLOPE))
    return F.least(F.greatest(v, _lit(0.0)), _lit(1.0))


def lab_to_rgb_cols(l: Column, a: Column, b: Column):
    """(R, G, B) in [0, 1] from LAB; negative z is clipped to 0 and the
    result to [0, 1]."""
    y = (l + _lit(16.0)) / _lit(116.0)
    x = a / _lit(500.0) + y
    z = y - b / _lit(200.0)
    z = F.when(z < 0, _lit(0.0)).otherwise(z)
    X = _lab_f_inv(x) * _lit(WHITE_X)
    Y = _lab_f_inv(y)
    Z = _lab_f_inv(z) * _lit(WHITE_Z)
    m = RGB_FROM_XYZ
    lin = [X * _lit(m[i][0]) + Y * _lit(m[i][1]) + Z * _lit(m[i][2]) for i in range(3)]
    return tuple(_gamma_out(c) for c in lin)


def colour_table(spark):
    """The 11-row (word, R, G, B) lookup table."""
    return spark.createDataFrame([(w, *rgb) for w, rgb in COLOUR_RGB.items()],
                                 "word string, R int, G int, B int")
