"""Fringe stopping and phase calibration of visibilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visloom.functions.signal import rotate, rotate_by

def calibrate(vis: DataFrame, cal: DataFrame, keys: list[str]) -> DataFrame:
    """vis (.., re, im) turned back by the phases of cal (keys, re, im); what has no calibration stays as it is.

    Adaptive execution broadcasts the calibration where its measured size is below Spark's threshold.
    """
    side = cal.select(*keys, F.col("re").alias("cal_re"), F.col("im").alias("cal_im"))
    joined = vis.join(side, keys, "left")
    re, im = rotate_by(F.col("re"), F.col("im"), F.col("cal_re"), F.col("cal_im"))
    known = F.col("cal_re").isNotNull()
    return joined.select(*(c for c in vis.columns if c not in ("re", "im")), F.when(known, re).otherwise(F.col("re")).alias("re"), F.when(known, im).otherwise(F.col("im")).alias("im"))


def fringe_phase(d1: Column, d2: Column, freq_hz: Column, chan: Column, sub_array: Column, offset_mhz: float = 12.5) -> Column:
    """Phase from the delays (ns) of both antennas: the sky part turns with the radio, the corrected whole
    nanoseconds with the intermediate frequency. The second array's channels run downwards and turn back."""
    tg, tg0 = d2 - d1, d2.cast("int") - d1.cast("int")
    up = sub_array == 1
    radio = (freq_hz * 1e-6 + F.when(up, chan).otherwise(15 - chan) * 25 + offset_mhz) / 1000.0
    middle = (chan * 25 + offset_mhz + 50.0) / 1000.0
    return 2 * F.pi() * (F.when(up, radio).otherwise(-radio) * tg - middle * tg0)


def stop_fringes(vis: DataFrame, delays: DataFrame, gate: Column) -> DataFrame:
    """vis (frame_id, ant1, ant2, chan, re, im, freq_hz, sub_array) freed of fringes where the gate is open.

    delays (frame_id, delay array<double> by antenna) travel in the frame's row, so one join of frames
    brings both antennas' values; a frame without delays stays as it is.
    """
    joined = vis.join(delays, "frame_id", "left")
    phi = fringe_phase(F.get("delay", F.col("ant1")), F.get("delay", F.col("ant2")), F.col("freq_hz"), F.col("chan"), F.col("sub_array"))
    re, im = rotate(F.col("re"), F.col("im"), phi)
    im = F.when(F.col("sub_array") == 1, im).otherwise(-im)
    turn = gate & phi.isNotNull()
    return joined.select(*(c for c in vis.columns if c not in ("re", "im")), F.when(turn, re).otherwise(F.col("re")).alias("re"), F.when(turn, im).otherwise(F.col("im")).alias("im"))


def reference_phases(target: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Phases of the target less those of the reference source on the same antennas and channel."""
    r = reference.select(*keys, F.atan2("im", "re").alias("ref_phase"))
    return target.join(r, keys).select(*keys, F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("amp"), (F.atan2("im", "re") - F.col("ref_phase")).alias("phase"))


def calibration_table(vis: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last value of each key, by `order`."""
    return vis.groupBy(*keys).agg(F.max_by(F.struct("re", "im"), F.col(order)).alias("v")).select(*keys, "v.re", "v.im")
