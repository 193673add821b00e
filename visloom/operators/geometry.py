"""Antennas, baselines and their projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = 299792458.0
#: WGS84 semi-axes in metres.
A_EARTH, B_EARTH = 6378137.0, 6356752.3142


def baseline_index(ant1: Column, ant2: Column, antennas: int) -> Column:
    """Row-major place of the pair ant1 < ant2 among all pairs of so many antennas, from 0."""
    return (ant1 * antennas - F.floor(ant1 * (ant1 + 1) / 2) + (ant2 - ant1 - 1)).cast("int")


def baseline_id(ant1: Column, ant2: Column) -> Column:
    """256 a1 + a2 of antennas counted from 1; beyond 255 antennas 2048 a1 + a2 + 65536."""
    return F.when(ant2 > 255, ant1 * 2048 + ant2 + 65536).otherwise(ant1 * 256 + ant2).cast("int")


def antennas_of(baseline: Column) -> tuple[Column, Column]:
    """The antennas of an id, counted from 1."""
    wide = baseline > 65536
    rest = baseline - 65536
    return F.when(wide, F.floor(rest / 2048)).otherwise(F.floor(baseline / 256)).cast("int"), F.when(wide, rest % 2048).otherwise(baseline % 256).cast("int")


def spiral_antennas(ants: DataFrame) -> DataFrame:
    """Local east, north, up of antennas (ant) on a log spiral."""
    r = 8.0 * F.pow(F.lit(1.1), F.col("ant"))
    return ants.select("ant", (r * F.cos(2.1 * F.col("ant"))).alias("e"), (r * F.sin(2.1 * F.col("ant"))).alias("n"), F.lit(0.0).alias("u"))


def unique_baselines(ants: DataFrame, count: int) -> DataFrame:
    """All pairs ant1 < ant2 with their index, id and vector. The antennas of an array are a small fixed table."""
    a = ants.select(F.col("ant").alias("ant1"), F.col("e").alias("e1"), F.col("n").alias("n1"), F.col("u").alias("u1"))
    b = ants.select(F.col("ant").alias("ant2"), F.col("e").alias("e2"), F.col("n").alias("n2"), F.col("u").alias("u2"))
    pairs = a.join(b, F.col("ant1") < F.col("ant2"))
    return pairs.select(
        "ant1", "ant2", baseline_index(F.col("ant1"), F.col("ant2"), count).alias("bl"), baseline_id(F.col("ant1") + 1, F.col("ant2") + 1).alias("baseline_id"),
        (F.col("e2") - F.col("e1")).alias("be"), (F.col("n2") - F.col("n1")).alias("bn"), (F.col("u2") - F.col("u1")).alias("bu"),
    )


def earth_fixed(lat: float, lon: Column, e: Column, n: Column, u: Column) -> tuple[Column, Column, Column]:
    """Earth-fixed x, y, z of a point east, north and up of geodetic (lat, lon in degrees) on the ellipsoid."""
    phi, lam = F.radians(F.lit(lat)), F.radians(lon)
    flat2 = 1 - (B_EARTH / A_EARTH) ** 2
    normal = A_EARTH / F.sqrt(1 - flat2 * F.sin(phi) * F.sin(phi))
    across = (normal + u) * F.cos(phi) - n * F.sin(phi)
    return across * F.cos(lam) - e * F.sin(lam), across * F.sin(lam) + e * F.cos(lam), (normal * (1 - flat2) + u) * F.sin(phi) + n * F.cos(phi)


def uvw_seconds(x: Column, y: Column, z: Column, hour_deg: Column, dec_deg: Column) -> tuple[Column, Column, Column]:
    """Baseline vector (metres) towards hour angle and declination, in light seconds."""
    h, d = F.radians(hour_deg), F.radians(dec_deg)
    u = F.sin(h) * x + F.cos(h) * y
    v = -F.sin(d) * F.cos(h) * x + F.sin(d) * F.sin(h) * y + F.cos(d) * z
    w = F.cos(d) * F.cos(h) * x - F.cos(d) * F.sin(h) * y + F.sin(d) * z
    return u / C, v / C, w / C


def to_polar(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Length, elevation and azimuth in [0, 2 pi) of a vector; a null vector has angles 0."""
    r = F.sqrt(x * x + y * y + z * z)
    azimuth = F.atan2(y, x)
    return r, F.when(r > 0, F.asin(z / r)).otherwise(0.0), F.when(azimuth < 0, azimuth + 2 * F.pi()).otherwise(azimuth)


def from_polar(r: Column, elevation: Column, azimuth: Column) -> tuple[Column, Column, Column]:
    return r * F.cos(azimuth) * F.cos(elevation), r * F.sin(azimuth) * F.cos(elevation), r * F.sin(elevation)


def baseline_order_errors(vis: DataFrame, antennas: int) -> DataFrame:
    """Rows of each dump (frame_id, seq, ant1, ant2) whose place is not that of the triangular order."""
    wrong = F.col("seq") != baseline_index(F.col("ant1"), F.col("ant2"), antennas)
    return vis.groupBy("frame_id").agg(F.count_if(wrong).alias("n_wrong"), F.count("*").alias("n_rows"))
