"""Rotations of vectors and positions on orbits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Vector = tuple[Column, Column, Column]
ARC = float(np.pi / 180 / 3600)


def turn(axis: int, angle: Column, v: Vector) -> Vector:
    """Components of a vector in axes turned about one of them (0, 1, 2) by an angle."""
    c, s = F.cos(angle), F.sin(angle)
    a, b = v[(axis + 1) % 3], v[(axis + 2) % 3]
    out = list(v)
    out[(axis + 1) % 3], out[(axis + 2) % 3] = c * a + s * b, c * b - s * a
    return tuple(out)


def precess(v: Vector, jd_tdb: Column) -> Vector:
    """A vector of J2000 in the axes of a date."""
    t = (jd_tdb - 2451545.0) / 36525.0
    # Polynomials of the three precession angles, arc seconds.
    psi = ((((-0.0000000951 * t + 0.000132851) * t - 0.00114045) * t - 1.0790069) * t + 5038.481507) * t
    omega = ((((0.0000003337 * t - 0.000000467) * t - 0.00772503) * t + 0.0512623) * t - 0.025754) * t + 84381.406
    chi = ((((-0.0000000560 * t + 0.000170663) * t - 0.00121197) * t - 2.3814292) * t + 10.556403) * t
    v = turn(0, F.lit(84381.406 * ARC), v)
    v = turn(2, -psi * ARC, v)
    v = turn(0, -omega * ARC, v)
    return turn(2, chi * ARC, v)


def gmst82(jd_ut1: Column) -> Column:
    """Sidereal angle of 1982 in radians."""
    t = (jd_ut1 - 2451545.0) / 36525.0
    # The polynomial of 1982, in seconds.
    g = 67310.54841 + (8640184.812866 + (0.093104 - 6.2e-6 * t) * t) * t
    return F.pmod(F.pmod(jd_ut1, F.lit(1.0)) + F.pmod(g / 86400.0, F.lit(1.0)), F.lit(1.0)) * 2 * F.pi()


def teme_to_earth(v: Vector, jd_ut1: Column, xp: Column | float = 0.0, yp: Column | float = 0.0) -> Vector:
    """An inertial satellite vector in Earth-fixed axes; xp and yp (radians) are the pole's place."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return turn(0, -lit(yp), turn(1, -lit(xp), turn(2, gmst82(jd_ut1), v)))


def teme_velocity_to_earth(r: Vector, v: Vector, jd_ut1: Column, xp: Column | float = 0.0, yp: Column | float = 0.0) -> Vector:
    """A velocity (length a day) in Earth-fixed axes, which turn under the place r."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    t = (jd_ut1 - 2451545.0) / 36525.0
    # The rate of the sidereal angle of 1982, in radians a day.
    rate = (1 + (8640184.812866 + (0.093104 * 2 - 6.2e-6 * 3 * t) * t) / 86400.0 / 36525.0) * 2 * F.pi()
    x, y, _ = turn(2, gmst82(jd_ut1), r)
    p, q, w = turn(2, gmst82(jd_ut1), v)
    return turn(0, -lit(yp), turn(1, -lit(xp), (p + rate * y, q - rate * x, w)))


@F.pandas_udf(T.DoubleType())
def eccentric_anomaly(mean: pd.Series, ecc: pd.Series) -> pd.Series:
    """Root E of E - e sin E = M (radians, taken within one turn), by at most 30 Newton steps on the whole column."""
    m, e = np.mod(mean.to_numpy(float), 2 * np.pi), ecc.to_numpy(float)
    x = np.where(e < 0.8, m, np.pi)
    for _ in range(30):
        step = (x - e * np.sin(x) - m) / (1 - e * np.cos(x))
        x = x - step
        if not len(x) or np.nanmax(np.abs(step)) < 1e-13:
            break
    return pd.Series(x)


def ecliptic_position(axis: Column, ecc: Column, incl: Column, node: Column, peri: Column, anomaly: Column) -> Vector:
    """Ecliptic x, y, z on an ellipse; angles in radians, anomaly the eccentric one."""
    xv, yv = axis * (F.cos(anomaly) - ecc), axis * F.sqrt(1 - ecc * ecc) * F.sin(anomaly)
    x1, y1 = xv * F.cos(peri) - yv * F.sin(peri), xv * F.sin(peri) + yv * F.cos(peri)
    return x1 * F.cos(node) - y1 * F.cos(incl) * F.sin(node), x1 * F.sin(node) + y1 * F.cos(incl) * F.cos(node), y1 * F.sin(incl)


def chebyshev(coefficients: Column, s: Column) -> Column:
    """Sum of c_k T_k(s), by the recurrence from the highest coefficient down."""
    start = F.struct(F.lit(0.0).alias("b1"), F.lit(0.0).alias("b2"))
    step = lambda acc, c: F.struct((2 * s * acc["b1"] - acc["b2"] + c).alias("b1"), acc["b1"].alias("b2"))
    b = F.aggregate(F.reverse(F.slice(coefficients, 2, F.greatest(F.size(coefficients) - 1, F.lit(0)))), start, step)
    return F.get(coefficients, F.lit(0)) + s * b["b1"] - b["b2"]


def segment_of(t: Column, t0: float, length: float) -> tuple[Column, Column]:
    """Number of the segment that holds a time, and the time within it from -1 to 1."""
    n = F.floor((t - t0) / length)
    return n, 2 * (t - t0 - n * length) / length - 1
