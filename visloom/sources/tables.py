"""Text tables in, products out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visloom.operators.geometry import C, baseline_id
from visloom.operators.params import numbers

# Sizes of a minute's file of each array.
MINUTE_BYTES = {1: 1_920_000_000, 2: 3_932_160_000}


def antenna_positions(lines: DataFrame) -> DataFrame:
    """ant, x, y, z of text lines (line_no, value) of three numbers each; other lines are left out."""
    parts = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.try_cast("double"))
    p = lines.select("line_no", parts.alias("p")).where(F.size("p") == 3)
    return p.select(F.col("line_no").cast("int").alias("ant"), *(F.get("p", F.lit(i)).alias(c) for i, c in enumerate("xyz")))


def earth_orientation(lines: DataFrame) -> DataFrame:
    """mjd, x, y, ut1_utc of text lines."""
    parts = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.try_cast("double"))
    p = lines.select(parts.alias("p")).where((F.size("p") == 4) & F.get("p", F.lit(0)).isNotNull())
    return p.select(*(F.get("p", F.lit(i)).alias(c) for i, c in enumerate(("mjd", "x", "y", "ut1_utc"))))


ORIENTATION = np.dtype([("y", "<u2"), ("m", "u1"), ("day", "u1"), ("mjd", "<u4"), ("x", "<f8"), ("y_pole", "<f8"), ("ut1_utc", "<f8")])
ORIENTATION_SCHEMA = "y int, m int, day int, mjd int, x double, y_pole double, ut1_utc double"


def orientation_records(rows: DataFrame) -> DataFrame:
    """y, m, day, mjd, x, y_pole, ut1_utc of binary records of 32 bytes (record), one or several to a row; a last part of a record is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join((r or b"")[: len(r or b"") // 32 * 32] for r in batch.column(0).to_pylist())
            found = np.frombuffer(raw, ORIENTATION)
            cols = [pa.array(found[n].astype("f8" if found[n].dtype.kind == "f" else "i4")) for n in ORIENTATION.names]
            yield pa.RecordBatch.from_arrays(cols, names=list(ORIENTATION.names))

    return rows.select("record").mapInArrow(run, ORIENTATION_SCHEMA)


def orientation_bytes(rows: DataFrame) -> DataFrame:
    """record: the same rows as binary records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, ORIENTATION)
            for i, n in enumerate(ORIENTATION.names):
                out[n] = batch.column(i).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in out], pa.binary())], names=["record"])

    return rows.select(*ORIENTATION.names).mapInArrow(run, "record binary")


def dated_parameters(rows: DataFrame) -> DataFrame:
    """freq, ref_time, value array<double> of rows whose value is a comma-separated cell."""
    return rows.select("freq", "ref_time", numbers(F.col("value")).alias("value"))


def radial_profiles(lines: DataFrame) -> DataFrame:
    """freq, i, brightness of alternating lines (line_no, value): a frequency, then its comma-separated profile."""
    pair = lines.groupBy(F.floor(F.col("line_no") / 2).alias("n")).agg(F.max(F.when(F.col("line_no") % 2 == 0, F.col("value"))).alias("freq"), F.max(F.when(F.col("line_no") % 2 == 1, F.col("value"))).alias("profile"))
    return pair.select(F.col("freq").try_cast("double").alias("freq"), F.posexplode(numbers(F.col("profile"))).alias("i", "brightness"))


def header_list(headers: DataFrame, n: int) -> DataFrame:
    """The first n frames; a listing, so the limit is its point."""
    return headers.orderBy("frame_no").limit(n)


def archive_catalogue(headers: DataFrame, file: Column) -> DataFrame:
    """A row a file: frames, first and last time, and what the first frame says."""
    return headers.groupBy(file.alias("file")).agg(F.count("*").alias("frames"), F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us"), F.min_by("pol", "t_us").alias("pol"), F.min_by("sub_band", "t_us").alias("sub_band"))


def array_of_size(size: Column) -> Column:
    return F.when(size == MINUTE_BYTES[1], 1).when(size == MINUTE_BYTES[2], 2)


def write_archive(frames: DataFrame, path: str) -> None:
    """Frames into folders by day and array."""
    frames.write.partitionBy("obs_day", "sub_array").mode("append").parquet(path)


def write_calibration(cal: DataFrame, path: str) -> None:
    """Calibration into folders by day, array and priority; a day and priority written again takes the old one's place."""
    cal.write.option("partitionOverwriteMode", "dynamic").partitionBy("obs_day", "sub_array", "priority").mode("overwrite").parquet(path)


def read_calibration(spark: SparkSession, path: str, day: str, sub_array: int, priority: int) -> DataFrame:
    return spark.read.parquet(path).where((F.col("obs_day") == day) & (F.col("sub_array") == sub_array) & (F.col("priority") == priority))


def antenna_table(antennas: DataFrame) -> DataFrame:
    """The AN table of antennas (ant from 0, e, n, u): names, places, numbers from 1, mounts and feeds."""
    zero = F.lit(0.0)
    return antennas.select(
        F.concat(F.lit("A"), (F.col("ant") + 1).cast("string")).alias("anname"), F.array("e", "n", "u").alias("stabxyz"), (F.col("ant") + 1).cast("int").alias("nosta"), F.lit(0).alias("mntsta"), zero.alias("staxof"),
        F.lit("L").alias("poltya"), zero.alias("polaa"), F.array(zero, zero).alias("polcala"), F.lit("R").alias("poltyb"), zero.alias("polab"), F.array(zero, zero).alias("polcalb"),
    )


def frequency_table(bands: DataFrame, width: float = 25e6, channels: int = 16) -> DataFrame:
    """The FQ table of bands (freqsel from 0, hz)."""
    return bands.select((F.col("freqsel") + 1).cast("int").alias("frqsel"), F.array("hz").alias("if_freq"), F.array(F.lit(width)).alias("ch_width"), F.array(F.lit(width * channels)).alias("total_bandwidth"), F.array(F.lit(1)).alias("sideband"))


def source_table(sources: DataFrame) -> DataFrame:
    """The SU table of sources (source_id, source, ra, dec in degrees)."""
    zero = F.lit(0.0)
    flux = [F.array(zero).alias(f"{x}flux") for x in "iquv"]
    return sources.select(
        F.col("source_id").cast("int").alias("id"), "source", F.lit(1).alias("qual"), F.lit("").alias("calcode"), *flux, F.array(zero).alias("freqoff"), zero.alias("bandwidth"), F.col("ra").alias("raepo"), F.col("dec").alias("decepo"), F.lit(2000.0).alias("epoch"),
        F.col("ra").alias("raapp"), F.col("dec").alias("decapp"), F.array(zero).alias("lsrvel"), F.array(zero).alias("restfreq"), zero.alias("pmra"), zero.alias("pmdec"),
    )


def export_tables(vis: DataFrame, antennas: DataFrame, bands: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """The logical tables of a visibility export: groups with channels as arrays, antennas, frequencies, sources.

    vis has frame_id, bl, ant1, ant2, chan, re, im, u and v (metres), pol, freqsel, source_id. Channels absent from a
    group have value 0 and weight 0. uu and vv are light seconds, stokes is -1 for RR and -2 for LL.
    """
    chan = F.sequence(F.lit(0), F.lit(15))
    keys = ["frame_id", "bl", "freqsel", "source_id", "pol"]
    one = [F.max("u").alias("u"), F.max("v").alias("v"), F.max("ant1").alias("ant1"), F.max("ant2").alias("ant2")]
    cells = vis.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("chan", F.struct("re", "im")))).alias("m"), *one)
    at = lambda f: F.transform(chan, lambda c: F.coalesce(F.try_element_at("m", c)[f], F.lit(0.0)))
    weight = F.transform(chan, lambda c: F.try_element_at("m", c).isNotNull().cast("double"))
    groups = cells.select(
        *keys[:4], (F.col("u") / C).alias("uu"), (F.col("v") / C).alias("vv"), F.lit(0.0).alias("ww"), baseline_id(F.col("ant1") + 1, F.col("ant2") + 1).alias("baseline"), F.when(F.col("pol") == 0, -2).otherwise(-1).alias("stokes"),
        F.lit(1).alias("inttim"), at("re").alias("re"), at("im").alias("im"), weight.alias("weight"),
    )
    return {"vis_groups": groups, "antenna": antenna_table(antennas), "frequency": frequency_table(bands), "source": source_table(sources)}


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def exported_products(groups: DataFrame, frequency: DataFrame) -> DataFrame:
    """Polarization, frequency (GHz) and size of each exported band."""
    pol = F.when(F.col("stokes") == -1, "RR").when(F.col("stokes") == -2, "LL").alias("pol")
    bands = frequency.select((F.col("frqsel") - 1).alias("freqsel"), (F.get("if_freq", F.lit(0)) / 1e9).alias("ghz"))
    return groups.groupBy("freqsel", pol).agg(F.count("*").alias("groups"), F.count_distinct("frame_id").alias("frames")).join(bands, "freqsel").select("freqsel", "pol", "groups", "frames", "ghz")


def training_lines(vis: DataFrame, bad: DataFrame) -> DataFrame:
    """Lines `label 1:chan 2:ant1 3:ant2 4:amp 5:phase`; label -1 where an antenna is in the list bad (ant), else +1."""
    b = F.broadcast(bad.agg(F.collect_set("ant").alias("bad")))
    hit = F.array_contains("bad", F.col("ant1")) | F.array_contains("bad", F.col("ant2"))
    amp, phase = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")), F.atan2("im", "re")
    fields = [F.when(hit, "-1").otherwise("+1"), *(F.concat(F.lit(f"{i}:"), x) for i, x in enumerate((F.col("chan").cast("string"), F.col("ant1").cast("string"), F.col("ant2").cast("string"), F.format_string("%.6f", amp), F.format_string("%.6f", phase)), 1))]
    return vis.crossJoin(b).select("frame_id", F.concat_ws(" ", *fields).alias("line"))


def image_product(images: DataFrame, keywords: dict[str, Column]) -> DataFrame:
    """Images with a header of named values."""
    return images.select("*", F.struct(*(v.alias(k) for k, v in keywords.items())).alias("header"))


def flux_rows(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of a visibility file (baseline, data array of re, im, weight by channel) as FLUX arrays without weights.

    keep names columns of the file that stay; integration time, frequency and source are 1 unless they are among them.
    """
    n = F.floor(F.size("data") / 3).cast("int")
    flux = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice("data", i * 3 + 1, 2)))
    same = {"inttim": F.lit(1.0), "freqid": F.lit(1), "source": F.lit(1)}
    return rows.select("row", "baseline", flux.alias("flux"), *(keep or []), *(v.alias(k) for k, v in same.items() if k not in (keep or [])))


def fixed_width_stars(lines: DataFrame) -> DataFrame:
    """hip, ra_deg, dec_deg of catalogue lines, by their columns; lines without numbers there are left out."""
    field = lambda a, n: F.trim(F.substring("value", a, n)).try_cast("double")
    return lines.select(field(3, 12).cast("long").alias("hip"), field(52, 12).alias("ra_deg"), field(65, 12).alias("dec_deg")).where("hip IS NOT NULL AND ra_deg IS NOT NULL AND dec_deg IS NOT NULL")


def orbital_elements(lines: DataFrame) -> DataFrame:
    """Elements of two-line sets: lines (n, value) of which an even one and the next belong together."""
    pair = lines.groupBy(F.floor(F.col("n") / 2).alias("k")).agg(F.max(F.when(F.col("n") % 2 == 0, F.col("value"))).alias("l1"), F.max(F.when(F.col("n") % 2 == 1, F.col("value"))).alias("l2"))
    part = lambda line, a, n: F.trim(F.substring(line, a, n))
    year = part("l1", 19, 2).try_cast("int")
    full = year + F.when(year < 57, 2000).otherwise(1900)
    return pair.select(
        "k", part("l1", 3, 5).try_cast("int").alias("satnum"), full.alias("epoch_year"), part("l1", 21, 12).try_cast("double").alias("epoch_day"),
        part("l2", 9, 8).try_cast("double").alias("inclination"), part("l2", 18, 8).try_cast("double").alias("node"), F.concat(F.lit("0."), part("l2", 27, 7)).try_cast("double").alias("eccentricity"),
        part("l2", 35, 8).try_cast("double").alias("perigee"), part("l2", 44, 8).try_cast("double").alias("anomaly"), part("l2", 53, 11).try_cast("double").alias("motion"),
    )


def numbered_lines(rows: DataFrame, order: str, value: Column, keys: list[str]) -> DataFrame:
    """keys, line_no, value: rows as the lines of files, one a key."""
    return rows.select(*keys, (F.row_number().over(W.partitionBy(*keys).orderBy(order)) - 1).alias("line_no"), value.alias("value"))
