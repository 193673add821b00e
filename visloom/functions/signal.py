"""Complex visibilities and frame codes as column expressions. A complex value is always two columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = 299792458.0


def signed24(low: Column, mid: Column, high: Column) -> Column:
    """Two's complement value of three bytes."""
    raw = low + mid * 256 + high * 65536
    return F.when(raw >= 1 << 23, raw - (1 << 24)).otherwise(raw)


def amplitude(re: Column, im: Column) -> Column:
    return F.sqrt(re * re + im * im)


def phase(re: Column, im: Column) -> Column:
    return F.atan2(im, re)


def rotate(re: Column, im: Column, phi: Column) -> tuple[Column, Column]:
    """The value turned back by phi: its amplitude stays, its phase loses phi."""
    return re * F.cos(phi) + im * F.sin(phi), im * F.cos(phi) - re * F.sin(phi)


def rotate_by(re: Column, im: Column, cal_re: Column, cal_im: Column) -> tuple[Column, Column]:
    """The value turned back by the phase of a calibration value, without any angle: amplitude stays."""
    size = F.sqrt(cal_re * cal_re + cal_im * cal_im)
    good = size > 0
    return F.when(good, (re * cal_re + im * cal_im) / size).otherwise(re), F.when(good, (im * cal_re - re * cal_im) / size).otherwise(im)


def channel_hz(freq_hz: Column, chan: Column, sub_array: Column) -> Column:
    """Centre of a 25 MHz channel; the second array counts channels downwards."""
    return freq_hz + F.when(sub_array == 1, chan).otherwise(15 - chan) * 25e6 + 12.5e6


def image_geometry(freq_hz: Column, sub_array: Column) -> dict[str, Column]:
    """Resolution and cell in arc seconds of 3 km baselines, image size by band, field of view."""
    resolution = F.degrees(C / freq_hz / 3000.0) * 3600
    # Image sizes by band.
    low = F.when(freq_hz < 800e6, 256).when(freq_hz < 1200e6, 512).otherwise(1024)
    high = F.when(freq_hz < 4000e6, 1280).when(freq_hz < 8000e6, 2560).otherwise(5120)
    size = F.when(sub_array == 1, low).otherwise(high)
    return {"resolution": resolution, "cell": resolution / 3, "imsize": size, "fov": size * resolution / 3}


def mode_codes(spark: SparkSession) -> DataFrame:
    """Frame codes: (table, code) -> polarization, channel group, frequency and its id. Bands go up by 400 MHz,
    the last one of the second array ends at 14.6 GHz; polarization is fixed only in loop mode."""
    high = lambda k: min(2_000_000_000 + 400_000_000 * k, 14_600_000_000)
    rows = [("loop_low", k, k % 2, 16 * (k // 2), 400_000_000 * (k // 2 + 1), k // 2 + 1) for k in range(8)]
    rows += [("fixed_low", c, None, 16 * k, 400_000_000 * (k + 1), k + 1) for k, c in enumerate((0x3333, 0x7777, 0xBBBB, 0xCCCC))]
    rows += [("loop_high", k, k % 2, 16 * (k // 2), high(k // 2), k // 2 + 1) for k in range(66)]
    rows += [("fixed_high", 0x101 * k, None, 16 * k, high(k), k + 1) for k in range(33)]
    return spark.createDataFrame(rows, "mode string, code int, pol int, channel_group int, freq_hz long, freqid int")


def resolve_modes(frames: DataFrame, codes: DataFrame) -> DataFrame:
    """Band, polarization and frequency of frames (mode, code, frame_pol); codes are a fixed small table."""
    out = frames.join(F.broadcast(codes), ["mode", "code"], "left")
    return out.withColumn("pol", F.coalesce("pol", "frame_pol")).withColumn("sub_band", F.floor(F.col("channel_group") / 16).cast("int"))


def pol_label(pol: Column) -> Column:
    return F.when(pol == 0, "LL").otherwise("RR")


def target_label(code: Column) -> Column:
    return F.when(code == 0, "sun").when(code == 0x0101, "satellite").when(code == 0x0202, "swan").otherwise("other")


def drifting_phase(u: Column, v: Column, hz: Column, n: Column) -> Column:
    """Phase that the n-th integration of a drifting pointing is turned forward by; u and v in light seconds."""
    # Degrees of right ascension, of declination at the start, and of its change with each integration.
    ra, dec = F.radians(F.lit(0.14)), F.radians(F.lit(-0.1) + F.lit(0.02) * n)
    return 2 * F.pi() * hz * (u * ra + v * dec)


def offset_phase(u: Column, v: Column, x: Column, y: Column) -> Column:
    """Phase of a source off the centre, for u, v in wavelengths and x, y in radians."""
    return 2 * F.pi() * (u * x + v * y)
