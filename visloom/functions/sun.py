"""Solar position and angles of a Julian date, from the truncated theory of the Sun's motion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUN_RADIUS_M, AU_M = 6.955e8, 1.495978707e11

# Fixed values. Mean angles in degrees: at 1900, and degrees a century.
EARTH, VENUS, MARS, JUPITER, MOON = (358.475844, 35999.04975), (212.603219, 58517.803875), (319.529425, 19139.8585), (225.328328, 3034.6920239), (350.7376814, 445267.11422)
# Planetary terms of the longitude, arc seconds: amplitude, phase, and multiples of the planet's and the Earth's angle.
TERMS = {
    VENUS: ((4.8, 299.1017, 1, -1), (5.5, 148.3133, 2, -2), (2.5, 315.9433, 2, -3), (1.6, 345.2533, 3, -4), (1.0, 318.15, 3, -5)),
    MARS: ((2.0, 343.8883, -2, 2), (1.8, 200.4017, -2, 1)),
    JUPITER: ((7.2, 179.5317, -1, 1), (2.6, 263.2167, -1, 0), (2.7, 87.145, -2, 2), (1.6, 109.4933, -2, 1)),
}


def _angle(at_1900_and_rate: tuple[float, float], t: Column) -> Column:
    a, rate = at_1900_and_rate
    return a + F.pmod(rate * t, F.lit(360.0))


def _sin(deg: Column) -> Column:
    return F.sin(F.radians(deg))


def _cos(deg: Column) -> Column:
    return F.cos(F.radians(deg))


def sun_position(jd: Column) -> dict[str, Column]:
    """Mean longitude, apparent longitude, obliquity, right ascension and declination, degrees."""
    t = (jd - 2415020.0) / 36525.0
    me = _angle(EARTH, t)
    arc = (279.696678 + F.pmod(36000.768925 * t, F.lit(360.0))) * 3600.0 + (6910.1 - 17.2 * t) * _sin(me) + 72.3 * _sin(2.0 * me)
    for planet, terms in TERMS.items():
        p = _angle(planet, t)
        for amplitude, angle, mp, m in terms:
            arc = arc + amplitude * _cos(angle + mp * p + m * me)
    arc = arc + 6.5 * _sin(_angle(MOON, t)) + 6.4 * _sin(231.19 + 20.2 * t)
    arc = F.pmod(arc + 2592000.0, F.lit(1296000.0))
    omega = 259.183275 - F.pmod(1934.142008 * t, F.lit(360.0))
    apparent = (arc - 20.5 - 17.2 * _sin(omega)) / 3600.0
    obliquity = 23.452294 - 0.0130125 * t + 9.2 * _cos(omega) / 3600.0
    ra = F.degrees(F.atan2(_sin(apparent) * _cos(obliquity), _cos(apparent)))
    return {"longitude": arc / 3600.0, "app_long": apparent, "obliq": obliquity, "ra": F.when(ra < 0, ra + 360.0).otherwise(ra), "dec": F.degrees(F.asin(_sin(apparent) * _sin(obliquity)))}


def solar_angles(jd: Column) -> dict[str, Column]:
    """Position angle of the pole, latitude of the disk centre (degrees) and semi-diameter (arc minutes)."""
    sun, de = sun_position(jd), jd - 2415020.0
    t = de / 36525.0
    node = 73.666666 + (50.25 / 3600.0) * (de / 365.25 + 50.0)
    arg = sun["longitude"] - 20.5 / 3600.0 - node
    p = F.degrees(F.atan(-F.tan(F.radians(sun["obliq"])) * _cos(sun["app_long"])) + F.atan(-0.12722 * _cos(arg)))
    mv, me, mm, mj, d = (_angle(x, t) for x in ((212.6, 58517.8), (358.476, 35999.0498), (319.5, 19139.86), (225.3, 3034.69), (350.7, 445267.11)))
    # Distance in astronomical units.
    r = 1.000141 - (0.016748 - 0.0000418 * t) * _cos(me) - 0.00014 * _cos(2.0 * me)
    for amplitude, angle in ((0.000016, 58.3 + 2.0 * mv - 2.0 * me), (0.000005, 209.1 + mv - me), (0.000005, 253.8 - 2.0 * mm + 2.0 * me), (0.000016, 89.5 - mj + me), (0.000009, 357.1 - 2.0 * mj + 2.0 * me), (0.000031, d)):
        r = r + amplitude * _cos(angle)
    return {"p": p, "b0": F.degrees(F.asin(0.1262 * _sin(arg))), "sd": F.degrees(F.asin(SUN_RADIUS_M / AU_M / r)) * 60.0}
