"""Queries of sources, sinks, orbits and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visloom.functions import orbits, timescale
from visloom.operators import imaging as im
from visloom.plans import fixtures as fx
from visloom.plans.scalars import r6
from visloom.plans.tools import _uv
from visloom.registry import register
from visloom.scratch import new_dir
from visloom.sources import rawframes as raw
from visloom.sources import tables as tb
from visloom.sources import uvfiles
from visloom.sources.exports import read_export, write_export
from visloom.streaming import frames as st


def _value(frame: np.ndarray, bl: np.ndarray, chan: np.ndarray, part: int) -> np.ndarray:
    """Whole numbers of 24 bits that a derived frame holds."""
    return (frame * 7919 + bl * 131 + chan * 17 + part * 5) % 20011 - 10005


def raw_records(spark: SparkSession, sf: str, array: int, year: int = 2015, parts: int | None = None) -> DataFrame:
    """A record of each supplier, with contents that follow from its key; made by so many tasks, as the suppliers of all of them are a small file."""
    outs = raw.OUTPUTS[array]
    count = outs * (outs - 1) // 2

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 16):
                n = batch["frame_no"].to_numpy()[lo : lo + 16]
                f, b, c = n[:, None, None], np.arange(count)[None, :, None], np.arange(16)[None, None, :]
                o = np.arange(outs)[None, :]
                header = {k: n * 0 for k in ("frequency_switch", "bandwidth", "quantization", "delay_switch", "array_tag")}
                header |= {"packed_time": raw.packed_times(n, year), "strip_switch": n * 0 + 0xCCCCCCCC, "sub_band_switch": np.where(n % 2 == 0, 0x3333, 0x7777), "target": n % 3 * 0x101, "loop_code": n % (8 if array == 1 else 66), "old_loop_code": n % 4 * 0x5555}
                # Every fifth frame is taken outside of loop mode, in the band of the supplier's key.
                fixed = np.array(raw.FIXED_LOW)[n % 4] if array == 1 else n % 33 * 0x101
                header["sub_band_switch"] = header["sub_band_switch"] | np.where(n % 5 == 0, fixed, 0xEEEE) << 16
                vis = _value(f, b, c, 0) + 1j * _value(f, b, c, 1)
                auto = (f * 31 + o[:, :, None] * 7 + c) % 100003
                records = raw.encode(n, array, header, vis, auto, (n[:, None] + o * 3) % 1000)
                yield pd.DataFrame({"frame_no": n, "record": [r.tobytes() for r in records]})

    numbers = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("frame_no"))
    return (numbers.repartition(parts, "frame_no") if parts else numbers).mapInPandas(run, "frame_no long, record binary")


def _receiver_pairs(outs: int, ants: int) -> str:
    return f"(SELECT a.range::INT AS a1, b.range::INT AS a2, (a.range * {outs} - a.range * (a.range + 1) // 2 + b.range - a.range - 1)::BIGINT AS rb FROM range({ants}) a, range({ants}) b WHERE a.range < b.range)"


def _s01(array: int):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return raw.decode_sums(raw_records(spark, sf, array, parts=4 * spark.sparkContext.defaultParallelism), array)

    sql = f"SELECT a1 AS ant1, a2 AS ant2, chan, count(*) AS n, sum(re)::DOUBLE AS re, sum(im)::DOUBLE AS im, max(re)::DOUBLE AS top FROM (SELECT a1, a2, chan, (s_suppkey * 7919 + rb * 131 + chan * 17) % 20011 - 10005 AS re, (s_suppkey * 7919 + rb * 131 + chan * 17 + 5) % 20011 - 10005 AS im FROM supplier, {_receiver_pairs(raw.OUTPUTS[array], raw.ANTENNAS[array])}, (SELECT range::INT AS chan FROM range(16))) GROUP BY 1, 2, 3"
    return run, sql


for _array in (1, 2):
    register(f"s01_decode_vis_array{_array}", *_s01(_array))


def s01b(spark: SparkSession, sf: str) -> DataFrame:
    r = raw_records(spark, sf, 1)
    auto = raw.decode_table(r, 1, "autocorr").groupBy("frame_no").agg(F.sum("power").alias("power"))
    delays = raw.decode_table(r, 1, "delays").groupBy("frame_no").agg(F.sum("delay_ns").alias("delay_ns"))
    return auto.join(delays, "frame_no")


register("s01_decode_auto_delays", s01b, "SELECT s_suppkey AS frame_no, (SELECT sum((s_suppkey * 31 + o.range * 7 + c.range) % 100003) FROM range(40) o, range(16) c)::DOUBLE AS power, (SELECT sum((s_suppkey + o.range * 3) % 1000) FROM range(40) o)::DOUBLE AS delay_ns FROM supplier")


def _headers(spark: SparkSession, sf: str) -> DataFrame:
    h = raw.decode_table(raw_records(spark, sf, 1), 1, "headers")
    f = timescale.unpack_time(F.col("packed_time"))
    us = ((f["hour"] * 60 + f["minute"]) * 60 + f["second"]) * 1_000_000 + f["ms"] * 1000 + f["us"]
    return h.withColumn("t_us", us)


def s01c(spark: SparkSession, sf: str) -> DataFrame:
    """Bands, polarizations and frequencies as the decoder resolves them, of both arrays and of frames before 2015."""
    parts = [raw.decode_table(raw_records(spark, sf, a, y), a, "headers").withColumn("sub_array", F.lit(a)).withColumn("year", F.lit(y)) for a, y in ((1, 2015), (1, 2014), (2, 2015), (2, 2014))]
    both = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    return both.select("sub_array", "year", "frame_no", "recent", "loop", "pol", "sub_band", "freq_hz", "freqid", "obs_target", "real_sub_array")


register("s01_decode_modes", s01c, """WITH x AS (SELECT a.sub_array, y.year, s_suppkey AS n, s_suppkey % 5 > 0 AS loop FROM supplier, (VALUES (1), (2)) a(sub_array), (VALUES (2015), (2014)) y(year)),
b AS (SELECT *, CASE WHEN loop AND (sub_array = 2 OR year = 2015) THEN n % CASE WHEN sub_array = 1 THEN 8 ELSE 66 END % 2 ELSE n % 2 END AS pol,
CASE WHEN sub_array = 2 THEN CASE WHEN loop THEN floor(n % 66 / 2) ELSE n % 33 END WHEN loop AND year = 2015 THEN floor(n % 8 / 2) ELSE n % 4 END AS band FROM x)
SELECT sub_array, year, n AS frame_no, year = 2015 AS recent, loop, pol::INT AS pol, band::INT AS sub_band, CASE WHEN sub_array = 1 THEN 400000000 * (band + 1) ELSE least(2000000000 + 400000000 * band, 14600000000) END::BIGINT AS freq_hz,
CASE WHEN sub_array = 2 AND loop THEN 1 ELSE band + 1 END::INT AS freqid, CASE WHEN year = 2014 OR n % 3 = 0 THEN 'sun' WHEN n % 3 = 1 THEN 'satellite' ELSE 'swan' END AS obs_target, CASE WHEN year = 2014 THEN sub_array ELSE 1 END AS real_sub_array FROM b""")


def s02(spark: SparkSession, sf: str) -> DataFrame:
    from visloom.functions.signal import pol_label, target_label

    return tb.header_list(_headers(spark, sf), 20).select("frame_no", "t_us", pol_label(F.col("pol")).alias("pol"), target_label(F.col("target")).alias("target"), ((F.col("sub_band") + 1) * 400).cast("int").alias("mhz"))


register("s02_header_list", s02, "SELECT s_suppkey AS frame_no, s_suppkey * 3125 AS t_us, CASE WHEN s_suppkey % 2 = 0 THEN 'LL' ELSE 'RR' END AS pol, CASE s_suppkey % 3 WHEN 0 THEN 'sun' WHEN 1 THEN 'satellite' ELSE 'swan' END AS target, ((CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey % 4 ELSE floor(s_suppkey % 8 / 2) END + 1) * 400)::INT AS mhz FROM supplier ORDER BY s_suppkey LIMIT 20")


def s03(spark: SparkSession, sf: str) -> DataFrame:
    return tb.archive_catalogue(fx.frames(spark, sf), F.concat(F.lit("f"), F.floor(F.col("t_us") / 5_000_000).cast("string")))


register("s03_catalogue", s03, fx.with_views("SELECT 'f' || floor(t_us / 5000000)::BIGINT AS file, count(*) AS frames, min(t_us) AS first_us, max(t_us) AS last_us, arg_min(pol, t_us) AS pol, arg_min(sub_band, t_us) AS sub_band FROM frames GROUP BY 1", "frames"))


def s04(spark: SparkSession, sf: str) -> DataFrame:
    """Frames routed by their day and by the array that the size of their minute's file tells; files of no known size go nowhere."""
    path = new_dir(spark, "archive")
    size = F.element_at(F.array(F.lit(tb.MINUTE_BYTES[1]), F.lit(tb.MINUTE_BYTES[2]), F.lit(4096)), F.col("sub_array")).alias("size")
    f = fx.frames(spark, sf).select("frame_id", "t_us", size, F.date_format("wall_ts", "yyyy-MM-dd").alias("obs_day"))
    tb.write_archive(f.withColumn("sub_array", tb.array_of_size(F.col("size"))).where("sub_array IS NOT NULL").drop("size"), path)
    return spark.read.parquet(path).groupBy(F.col("obs_day").cast("string").alias("obs_day"), "sub_array").agg(F.count("*").alias("n"), F.min("t_us").alias("first_us"))


register("s04_archive_routing", s04, fx.with_views("SELECT strftime(wall_ts, '%Y-%m-%d') AS obs_day, sub_array, count(*) AS n, min(t_us) AS first_us FROM frames WHERE sub_array < 3 GROUP BY 1, 2", "frames"))


def s05(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "cal")
    cal = fx.cal(spark, sf)
    for priority in (0, 1):
        tb.write_calibration(cal.where(F.col("chan") % 2 >= priority).select("*", F.lit("2015-11-01").alias("obs_day"), F.lit(1).alias("sub_array"), F.lit(priority).alias("priority")), path)
    return tb.read_calibration(spark, path, "2015-11-01", 1, 1).groupBy("sub_band", "pol").agg(F.count("*").alias("n"), r6(F.sum("re"), 4).alias("re"))


register("s05_calibration_store", s05, fx.with_views("SELECT sub_band, pol, count(*) AS n, round(sum(re), 4) + 0.0 AS re FROM cal WHERE chan % 2 >= 1 GROUP BY 1, 2", "cal"))


def s06(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "orders").select((F.col("o_custkey") % 2 + 1).alias("freq"), F.col("o_orderdate").alias("ref_time"), F.concat_ws(",", F.col("o_orderkey") % 97, F.lit("x"), F.floor("o_totalprice").cast("long")).alias("value"))
    p = tb.dated_parameters(rows)
    return p.groupBy("freq").agg(F.count("*").alias("n"), F.sum(F.get("value", F.lit(0))).alias("a"), F.count(F.get("value", F.lit(1))).alias("b"), F.sum(F.get("value", F.lit(2))).alias("c"))


register("s06_dated_parameters", s06, "SELECT o_custkey % 2 + 1 AS freq, count(*) AS n, sum(o_orderkey % 97)::DOUBLE AS a, 0::BIGINT AS b, sum(floor(o_totalprice))::DOUBLE AS c FROM orders GROUP BY 1")


def s07(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "supplier").select((F.col("s_suppkey") - 1).alias("line_no"), F.concat_ws("  ", (F.col("s_suppkey") * 1.5).cast("string"), (F.col("s_suppkey") * -2.25).cast("string"), F.when(F.col("s_suppkey") % 7 == 0, "none").otherwise("0.5")).alias("value"))
    return tb.antenna_positions(lines)


register("s07_antenna_text", s07, "SELECT (s_suppkey - 1)::INT AS ant, s_suppkey * 1.5::DOUBLE AS x, s_suppkey * -2.25::DOUBLE AS y, CASE WHEN s_suppkey % 7 <> 0 THEN 0.5::DOUBLE END AS z FROM supplier")


def s08(spark: SparkSession, sf: str) -> DataFrame:
    """Binary Earth-orientation records of 32 bytes, as built from dates, decoded and looked up by day number."""
    d = fx.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    mjd = F.datediff("d", F.lit("1858-11-17").cast("date"))
    rows = d.select(F.year("d").alias("y"), F.month("d").alias("m"), F.day("d").alias("day"), mjd.alias("mjd"), (mjd % 97 / 64.0).alias("x"), (mjd % 89 / -64.0).alias("y_pole"), (mjd % 83 / 128.0 - 0.25).alias("ut1_utc"))
    found = tb.orientation_records(tb.orientation_bytes(rows))
    asked = fx.table(spark, sf, "lineitem").select(F.datediff("l_shipdate", F.lit("1858-11-17").cast("date")).alias("mjd")).groupBy("mjd").agg(F.count("*").alias("n"))
    return asked.join(found, "mjd").select("mjd", "n", "y", "m", "day", "x", "y_pole", "ut1_utc")


register("s08_orientation_records", s08, "WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d, (o_orderdate::DATE - DATE '1858-11-17')::INT AS mjd FROM orders), a AS (SELECT (l_shipdate::DATE - DATE '1858-11-17')::INT AS mjd, count(*) AS n FROM lineitem GROUP BY 1) SELECT mjd, n, year(d)::INT AS y, month(d)::INT AS m, day(d)::INT AS day, mjd % 97 / 64.0::DOUBLE AS x, mjd % 89 / -64.0::DOUBLE AS y_pole, mjd % 83 / 128.0::DOUBLE - 0.25 AS ut1_utc FROM a JOIN d USING (mjd)")


def s09(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.table(spark, sf, "orders").select(F.concat_ws(" ", (F.col("o_orderkey") + 50000).cast("string"), F.lit("0.125"), F.lit("0.25"), F.when(F.col("o_orderkey") % 10 == 0, "header").otherwise("-0.5")).alias("value"))
    return tb.earth_orientation(lines).select(F.col("mjd").cast("long").alias("mjd"), "x", "ut1_utc")


register("s09_orientation_text", s09, "SELECT o_orderkey + 50000 AS mjd, 0.125::DOUBLE AS x, CASE WHEN o_orderkey % 10 <> 0 THEN -0.5::DOUBLE END AS ut1_utc FROM orders")


def _exports(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    v = fx.with_uv(spark, sf).withColumn("freqsel", (F.col("frame_id") % 4).cast("int")).withColumn("source_id", F.lit(1)).withColumn("pol", (F.col("frame_id") % 2).cast("int"))
    # All samples have a baseline, so those before the join have the same bands and sources.
    samples = fx.vis(spark, sf)
    bands = samples.select((F.col("frame_id") % 4).cast("int").alias("freqsel")).distinct().withColumn("hz", (F.col("freqsel") + 1) * 4e8)
    source = samples.select(F.lit(1).alias("source_id")).distinct().withColumn("source", F.lit("SUN")).withColumn("ra", F.lit(123.25)).withColumn("dec", F.lit(-12.5))
    return tb.export_tables(v, fx.antennas(spark, sf), bands, source)


def s10(spark: SparkSession, sf: str) -> DataFrame:
    """The four tables written and the groups read again."""
    path = new_dir(spark, "export")
    tb.write_tables(_exports(spark, sf), path)
    g = spark.read.parquet(f"{path}/vis_groups")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    return g.select("frame_id", "bl", "freqsel", "baseline", "stokes", r6(F.col("uu") * 1e6, 4).alias("uu"), r6(F.col("vv") * 1e6, 4).alias("vv"), r6(total("re"), 4).alias("re"), total("weight").alias("weight"))


register("s10_export_tables", s10, fx.with_views("SELECT frame_id, bl, (frame_id % 4)::INT AS freqsel, ((ant1 + 1) * 256 + ant2 + 1)::INT AS baseline, CASE WHEN frame_id % 2 = 0 THEN -2 ELSE -1 END AS stokes, round(max(u) / 299792458.0 * 1e6, 4) + 0.0 AS uu, round(max(uv.v) / 299792458.0 * 1e6, 4) + 0.0 AS vv, round(sum(re), 4) + 0.0 AS re, count(*)::DOUBLE AS weight FROM uv GROUP BY 1, 2, 3, 4, 5", "uv"))


def s10c(spark: SparkSession, sf: str) -> DataFrame:
    """The four tables as one commit, twice, and the groups with what the other tables say of them."""
    path = new_dir(spark, "export")
    tables = _exports(spark, sf)
    write_export(tables | {"vis_groups": tables["vis_groups"].where("frame_id % 2 = 0")}, path)
    write_export(tables, path)
    t = read_export(spark, path)
    a = t["antenna"].select(F.col("nosta").alias("a1"), F.col("anname").alias("first"))
    f = t["frequency"].select((F.col("frqsel") - 1).alias("freqsel"), F.get("if_freq", F.lit(0)).alias("hz"))
    g = t["vis_groups"].withColumn("a1", F.floor(F.col("baseline") / 256)).join(F.broadcast(a), "a1").join(F.broadcast(f), "freqsel").join(F.broadcast(t["source"].select(F.col("id").alias("source_id"), "source")), "source_id")
    return g.groupBy("first", "freqsel", "source", F.round("hz").cast("long").alias("hz")).agg(F.count("*").alias("groups"), F.count_distinct("frame_id").alias("frames"))


register("s10_export_commit", s10c, fx.with_views("SELECT 'A' || (ant1 + 1) AS first, (frame_id % 4)::INT AS freqsel, 'SUN' AS source, (frame_id % 4 + 1) * 400000000::BIGINT AS hz, count(DISTINCT (frame_id, bl)) AS groups, count(DISTINCT frame_id) AS frames FROM visu GROUP BY 1, 2, 3, 4", "visu"))


def s10b(spark: SparkSession, sf: str) -> DataFrame:
    """Antenna, frequency and source tables, as written and read again, a row each with its name, number and text of columns."""
    path = new_dir(spark, "export")
    t = _exports(spark, sf)
    tb.write_tables({k: t[k] for k in ("antenna", "frequency", "source")}, path)
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    a = read("antenna").select(F.lit("AN").alias("name"), F.col("nosta").alias("number"), F.concat_ws(" ", "anname", F.format_string("%.3f %.3f", F.get("stabxyz", F.lit(0)), F.get("stabxyz", F.lit(1))), "mntsta", "poltya", "poltyb").alias("value"))
    f = read("frequency").select(F.lit("FQ").alias("name"), F.col("frqsel").alias("number"), F.format_string("%.0f %.0f %.0f %d", F.get("if_freq", F.lit(0)), F.get("ch_width", F.lit(0)), F.get("total_bandwidth", F.lit(0)), F.get("sideband", F.lit(0))).alias("value"))
    s = read("source").select(F.lit("SU").alias("name"), F.col("id").alias("number"), F.concat_ws(" ", "source", F.format_string("%.2f %.2f %.1f %d", "raepo", "decepo", "epoch", "qual")).alias("value"))
    return a.union(f).union(s)


register("s10_export_dimensions", s10b, fx.with_views("""SELECT 'AN' AS name, (ant + 1)::INT AS number, 'A' || (ant + 1) || ' ' || printf('%.3f', e) || ' ' || printf('%.3f', n) || ' 0 L R' AS value FROM antennas
UNION ALL SELECT DISTINCT 'FQ', (frame_id % 4)::INT + 1, ((frame_id % 4 + 1) * 400000000)::BIGINT || ' 25000000 400000000 1' FROM vis UNION ALL SELECT 'SU', 1, 'SUN 123.25 -12.50 2000.0 1'""", "vis", "antennas"))


def s11(spark: SparkSession, sf: str) -> DataFrame:
    t = _exports(spark, sf)
    return tb.exported_products(t["vis_groups"], t["frequency"])


register("s11_list_products", s11, fx.with_views("SELECT (frame_id % 4)::INT AS freqsel, CASE WHEN frame_id % 2 = 0 THEN 'LL' ELSE 'RR' END AS pol, count(DISTINCT (frame_id, bl)) AS groups, count(DISTINCT frame_id) AS frames, (frame_id % 4 + 1) * 0.4::DOUBLE AS ghz FROM visu GROUP BY 1, 2, 5", "visu"))


def s12(spark: SparkSession, sf: str) -> DataFrame:
    lines = tb.training_lines(fx.visu(spark, sf), fx.bad_antennas(spark).where("obs_day = '2014-11-11'").select("ant"))
    return lines.groupBy(F.substring("line", 1, 2).alias("label")).agg(F.count("*").alias("n"), F.min("line").alias("first_line"))


register("s12_training_lines", s12, fx.with_views("""WITH l AS (SELECT CASE WHEN ant1 IN (SELECT ant FROM bad WHERE obs_day = '2014-11-11') OR ant2 IN (SELECT ant FROM bad WHERE obs_day = '2014-11-11') THEN '-1' ELSE '+1' END || ' 1:' || chan || ' 2:' || ant1 || ' 3:' || ant2 || ' 4:' || printf('%.6f', sqrt(re * re + im * im)) || ' 5:' || printf('%.6f', atan2(im, re)) AS line FROM visu)
SELECT line[1:2] AS label, count(*) AS n, min(line) AS first_line FROM l GROUP BY 1""", "visu", "bad"))


def s13(spark: SparkSession, sf: str) -> DataFrame:
    """Profile lines as built from vectors, read as a frequency line and a profile line each."""
    e = fx.table(spark, sf, "embeddings").select("vec_id", F.concat_ws(",", F.transform("embedding", lambda x: F.round(x.cast("double"), 3).cast("string"))).alias("p"))
    lines = e.select(F.explode(F.array(F.struct((F.col("vec_id") * 2).alias("line_no"), (F.col("vec_id") * 1.5).cast("string").alias("value")), F.struct((F.col("vec_id") * 2 + 1).alias("line_no"), F.col("p").alias("value")))).alias("l")).select("l.*")
    return tb.radial_profiles(lines).groupBy("freq").agg(F.count("*").alias("n"), r6(F.sum("brightness"), 3).alias("total"))


register("s13_radial_profiles", s13, "SELECT vec_id * 1.5::DOUBLE AS freq, len(embedding)::BIGINT AS n, round(list_sum(list_transform(embedding, lambda x: round(x::DOUBLE, 3))), 3) + 0.0 AS total FROM embeddings")


def s15(spark: SparkSession, sf: str) -> DataFrame:
    p = im.per_image(fx.pixels(spark, sf).orderBy("y", "x"), lambda pdf: pdf.sort_values(["y", "x"])["value"].to_numpy().reshape(8, 8))
    out = tb.image_product(p, {"object": F.lit("SUN"), "stokes": F.when(F.col("image_key") % 2 == 0, "LL").otherwise("RR"), "gain": F.lit(0.1)})
    path = new_dir(spark, "images")
    out.write.parquet(path)
    back = spark.read.parquet(path)
    return back.select("image_key", "n", F.col("header.stokes").alias("stokes"), F.array_max("data").cast("double").alias("top"))


register("s15_image_product", s15, fx.with_views("SELECT image_key, 8 AS n, CASE WHEN image_key % 2 = 0 THEN 'LL' ELSE 'RR' END AS stokes, max(value) AS top FROM pixels GROUP BY 1", "pixels"))


def s16(spark: SparkSession, sf: str) -> DataFrame:
    """Files of random groups, one of each hundred vectors, read again: a vector is a group's data, without what is no whole triple."""

    def files(batches):
        import numpy as np

        for batch in batches:
            out = []
            for key, some in batch.groupby("file"):
                data = np.stack([np.round(np.asarray(x, float), 4)[: len(x) // 3 * 3] for x in some["embedding"]])
                n = some["vec_id"].to_numpy()
                p = {"UU": n * 0.5, "VV": n * -0.25, "WW": n * 0.0, "BASELINE": 256.0 * (n % 40 + 1) + n % 19 + 41, "SOURCE": n % 3 + 1.0, "DATE": 2457000.5 + n / 64.0}
                out.append((f"file-{key}", uvfiles.encode(p, data)))
            yield pd.DataFrame(out, columns=["path", "content"])

    e = fx.table(spark, sf, "embeddings").select("vec_id", "embedding", F.floor(F.col("vec_id") / 100).alias("file"))
    groups = uvfiles.read_groups(e.repartition("file").sortWithinPartitions("file", "vec_id").mapInPandas(files, "path string, content binary"))
    rows = tb.flux_rows(groups.withColumn("row", F.concat_ws(" ", "path", F.col("baseline").cast("string"), F.col("date").cast("string"))), ["source", "freqid", "inttim", "date", "ant1", "ant2", "uu"])
    total = r6(F.aggregate("flux", F.lit(0.0), lambda s, x: s + x), 4)
    return rows.select("baseline", "ant1", "ant2", "source", "freqid", r6(F.col("date") - 2457000.5).alias("day"), "uu", F.size("flux").alias("n"), total.alias("total"))


register("s16_flux_rows", s16, "SELECT (256 * (vec_id % 40 + 1) + vec_id % 19 + 41)::INT AS baseline, (vec_id % 40 + 1)::INT AS ant1, (vec_id % 19 + 41)::INT AS ant2, (vec_id % 3 + 1)::INT AS source, 1 AS freqid, round(vec_id / 64.0::DOUBLE, 6) + 0.0 AS day, vec_id * 0.5::DOUBLE AS uu, 2 * (len(embedding) // 3)::INT AS n, round((SELECT sum(round(embedding[i * 3 + 1]::DOUBLE, 4) + round(embedding[i * 3 + 2]::DOUBLE, 4)) FROM (SELECT range AS i FROM range(21))), 4) + 0.0 AS total FROM embeddings")


def s17(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    line = F.concat(F.lit("H|"), F.lpad(F.col("o_orderkey").cast("string"), 12, " "), F.lpad(F.lit(" "), 37, " "), F.lpad(F.format_string("%.6f", F.col("o_custkey") % 360 + 0.25), 12, " "), F.lpad(F.when(F.col("o_orderkey") % 9 == 0, "").otherwise(F.format_string("%.6f", F.col("o_custkey") % 90 - 45.5)), 13, " "))
    return tb.fixed_width_stars(o.select(line.alias("value")))


register("s17_star_lines", s17, "SELECT o_orderkey AS hip, o_custkey % 360 + 0.25::DOUBLE AS ra_deg, o_custkey % 90 - 45.5::DOUBLE AS dec_deg FROM orders WHERE o_orderkey % 9 <> 0")


def s18(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    num = F.lpad((F.col("k") % 100000).cast("string"), 5, "0")
    l1 = F.concat(F.lit("1 "), num, F.lit("U 58002B   "), F.lpad((F.col("k") % 100).cast("string"), 2, "0"), F.lit("179.78495062  .00000023"))
    deg = lambda x: F.lpad(F.format_string("%.4f", x), 8, " ")
    l2 = F.concat(F.lit("2 "), num, F.lit(" "), deg(F.col("k") % 90 + 0.5), F.lit(" "), deg(F.col("k") % 360 + 0.25), F.lit(" "), F.lpad((F.col("k") % 9999999).cast("string"), 7, "0"), F.lit(" "), deg(F.col("k") % 300 + 0.125), F.lit(" "), deg(F.col("k") % 200 + 0.75), F.lit(" 10.82419157413667"))
    lines = c.select(F.explode(F.array(F.struct((F.col("k") * 2).alias("n"), l1.alias("value")), F.struct((F.col("k") * 2 + 1).alias("n"), l2.alias("value")))).alias("l")).select("l.*")
    return tb.orbital_elements(lines)


register("s18_two_line_elements", s18, "SELECT c_custkey AS k, (c_custkey % 100000)::INT AS satnum, (c_custkey % 100 + CASE WHEN c_custkey % 100 < 57 THEN 2000 ELSE 1900 END)::INT AS epoch_year, 179.78495062::DOUBLE AS epoch_day, (c_custkey % 90 + 0.5)::DOUBLE AS inclination, (c_custkey % 360 + 0.25)::DOUBLE AS node, ('0.' || lpad((c_custkey % 9999999)::VARCHAR, 7, '0'))::DOUBLE AS eccentricity, (c_custkey % 300 + 0.125)::DOUBLE AS perigee, (c_custkey % 200 + 0.75)::DOUBLE AS anomaly, 10.82419157::DOUBLE AS motion FROM customer")


def p21(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", timescale.julian_date(F.col("o_orderdate").cast("timestamp_ntz")).alias("jd"))
    x, y, z = orbits.precess((F.lit(1.0), F.lit(0.0), F.lit(0.0)), F.col("jd"))
    return o.select("o_orderkey", r6(x, 8).alias("x"), r6(y, 8).alias("y"), r6(z, 8).alias("z"))


register("p21_precession", p21, f"""WITH a AS (SELECT o_orderkey, (epoch_us(o_orderdate::TIMESTAMP) / 86400e6 + 2440587.5 - 2451545.0) / 36525.0 AS t FROM orders),
b AS (SELECT *, -((((-0.0000000951 * t + 0.000132851) * t - 0.00114045) * t - 1.0790069) * t + 5038.481507) * t * {orbits.ARC} AS p, -(((((0.0000003337 * t - 0.000000467) * t - 0.00772503) * t + 0.0512623) * t - 0.025754) * t + 84381.406) * {orbits.ARC} AS w, ((((-0.0000000560 * t + 0.000170663) * t - 0.00121197) * t - 2.3814292) * t + 10.556403) * t * {orbits.ARC} AS c FROM a),
d AS (SELECT *, cos(p) AS x1, -sin(p) * cos(w) AS y1, sin(p) * sin(w) AS z1 FROM b)
SELECT o_orderkey, round(cos(c) * x1 + sin(c) * y1, 8) + 0.0 AS x, round(cos(c) * y1 - sin(c) * x1, 8) + 0.0 AS y, round(z1, 8) + 0.0 AS z FROM d""")


def p22(spark: SparkSession, sf: str) -> DataFrame:
    """Position in km and velocity in km a day."""
    e = fx.table(spark, sf, "events").select("event_id", timescale.julian_date(F.col("ts")).alias("jd"))
    r, v = (F.lit(5094.18), F.lit(6127.64), F.lit(6380.34)), (F.lit(-410000.5), F.lit(67900.25), F.lit(477950.0))
    x, y, z = orbits.teme_to_earth(r, F.col("jd"), 1e-6, 2e-6)
    vx, vy, vz = orbits.teme_velocity_to_earth(r, v, F.col("jd"), 1e-6, 2e-6)
    return e.select("event_id", r6(x, 2).alias("x"), r6(y, 2).alias("y"), r6(z, 2).alias("z"), r6(vx, 0).alias("vx"), r6(vy, 0).alias("vy"), r6(vz, 0).alias("vz"))


register("p22_teme_to_earth", p22, """WITH j AS (SELECT event_id, epoch_us(ts) / 86400e6 + 2440587.5 AS jd FROM events), a AS (SELECT *, (jd - 2451545.0) / 36525.0 AS t FROM j),
b AS (SELECT *, ((jd % 1.0) + (((67310.54841 + (8640184.812866 + (0.093104 - 6.2e-6 * t) * t) * t) / 86400.0 % 1.0 + 1.0) % 1.0)) % 1.0 * 2 * pi() AS g, (1 + (8640184.812866 + (0.093104 * 2 - 6.2e-6 * 3 * t) * t) / 86400.0 / 36525.0) * 2 * pi() AS gd FROM a),
c AS (SELECT *, cos(g) * 5094.18 + sin(g) * 6127.64 AS x, cos(g) * 6127.64 - sin(g) * 5094.18 AS y, 6380.34::DOUBLE AS z, cos(g) * -410000.5 + sin(g) * 67900.25 AS p, cos(g) * 67900.25 - sin(g) * -410000.5 AS q, 477950.0::DOUBLE AS w FROM b),
c2 AS (SELECT *, p + gd * y AS vx, q - gd * x AS vy, w AS vz FROM c),
d AS (SELECT event_id, y, cos(-1e-6) * z + sin(-1e-6) * x AS z, cos(-1e-6) * x - sin(-1e-6) * z AS x, vy, cos(-1e-6) * vz + sin(-1e-6) * vx AS vz, cos(-1e-6) * vx - sin(-1e-6) * vz AS vx FROM c2)
SELECT event_id, round(x, 2) + 0.0 AS x, round(cos(-2e-6) * y + sin(-2e-6) * z, 2) + 0.0 AS y, round(cos(-2e-6) * z - sin(-2e-6) * y, 2) + 0.0 AS z, round(vx, 0) + 0.0 AS vx, round(cos(-2e-6) * vy + sin(-2e-6) * vz, 0) + 0.0 AS vy, round(cos(-2e-6) * vz - sin(-2e-6) * vy, 0) + 0.0 AS vz FROM d""")


def p23(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of as many orbits as orders; the check value e sin E + M - E is 0 within rounding."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 90 / 100.0).alias("e"), (F.col("o_orderkey") % 628 / 100.0).alias("m"))
    a = o.withColumn("anomaly", orbits.eccentric_anomaly(F.col("m"), F.col("e")))
    x, y, z = orbits.ecliptic_position(F.lit(2.0), F.col("e"), F.lit(0.1), F.lit(0.2), F.lit(0.3), F.col("anomaly"))
    return a.select("o_orderkey", r6(F.col("e") * F.sin("anomaly") + F.col("m") - F.col("anomaly"), 9).alias("left"), r6(x).alias("x"), r6(y).alias("y"), r6(z).alias("z"))


register("p23_kepler", p23, """WITH o AS (SELECT o_orderkey, o_custkey % 90 / 100.0::DOUBLE AS e, o_orderkey % 628 / 100.0::DOUBLE AS m FROM orders), a AS (SELECT *, list_reduce(list_prepend(CASE WHEN e < 0.8 THEN m ELSE pi() END, list_transform(range(30), lambda i: 0.0::DOUBLE)), lambda x, i: x - (x - e * sin(x) - m) / (1 - e * cos(x))) AS ea FROM o),
v AS (SELECT *, 2 * (cos(ea) - e) AS xv, 2 * sqrt(1 - e * e) * sin(ea) AS yv FROM a), w AS (SELECT *, xv * cos(0.3) - yv * sin(0.3) AS x1, xv * sin(0.3) + yv * cos(0.3) AS y1 FROM v)
SELECT o_orderkey, round(e * sin(ea) + m - ea, 9) + 0.0 AS left, round(x1 * cos(0.2) - y1 * cos(0.1) * sin(0.2), 6) + 0.0 AS x, round(x1 * sin(0.2) + y1 * cos(0.1) * cos(0.2), 6) + 0.0 AS y, round(y1 * sin(0.1), 6) + 0.0 AS z FROM w""")


def p24(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of all coefficients of the segment that holds each time."""
    c = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("segment"), F.transform("embedding", lambda x: x.cast("double")).alias("c"))
    n, s = orbits.segment_of(F.col("o_orderkey").cast("double"), 0.0, 32.0)
    t = fx.table(spark, sf, "orders").select("o_orderkey", n.alias("segment"), s.alias("s"))
    return t.join(c, "segment").select("o_orderkey", r6(orbits.chebyshev(F.col("c"), F.col("s"))).alias("value"))


register("p24_chebyshev", p24, "SELECT o_orderkey, round((SELECT sum(embedding[k + 1]::DOUBLE * cos(k * acos(s))) FROM (SELECT range AS k FROM range(64))), 6) + 0.0 AS value FROM (SELECT o_orderkey, 2 * (o_orderkey % 32) / 32.0::DOUBLE - 1 AS s, floor(o_orderkey / 32)::BIGINT AS seg FROM orders) JOIN embeddings ON vec_id = seg")


def a14(spark: SparkSession, sf: str) -> DataFrame:
    """Sky, disk and brighter levels of each image, by a mixture of three over its histogram."""
    found = im.sky_levels(fx.pixels(spark, sf), 2000, 3)
    return found.select("image_key", "k", r6(F.col("level"), 3).alias("level"), r6(F.col("deviation"), 3).alias("deviation"), r6(F.col("share"), 4).alias("share"))


register("a14_clusters", a14)

FRAME_SCHEMA = "frame_id long, t_us long, sub_band int, pol int, sub_array int, chan int, bl int, re double, im double"


def stream_rows(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.frames(spark, sf)
    return f.select("frame_id", "t_us", "sub_band", "pol", "sub_array", (F.col("frame_id") % 16).cast("int").alias("chan"), (F.col("frame_id") % 780).cast("int").alias("bl"), (F.col("frame_id") % 50 - 20.0).alias("re"), (F.col("frame_id") % 30 - 10.0).alias("im"))


def _stream(spark: SparkSession, sf: str, twice: bool = False) -> DataFrame:
    """The rows in a folder, as a stream that takes all files as one batch."""
    path = new_dir(spark, "frames")
    rows = stream_rows(spark, sf)
    (rows.union(rows.where("frame_id % 3 = 0")) if twice else rows).write.parquet(path)
    return st.frame_stream(spark, path, FRAME_SCHEMA)


_ROWS = "st AS (SELECT frame_id, t_us, sub_band, pol, (frame_id % 16)::INT AS chan, (frame_id % 780)::INT AS bl, frame_id % 50 - 20.0::DOUBLE AS re, frame_id % 30 - 10.0::DOUBLE AS im FROM frames)"


def t01(spark: SparkSession, sf: str) -> DataFrame:
    rows = st.drain(_stream(spark, sf).drop("t"), new_dir(spark, "t01"))
    return rows.groupBy("sub_band", "pol").agg(F.count("*").alias("n"), F.sum("re").alias("re"))


register("t01_frame_stream", t01, fx.with_views(f"WITH {_ROWS} SELECT sub_band, pol, count(*) AS n, sum(re) AS re FROM st GROUP BY 1, 2", "frames"))


def t02(spark: SparkSession, sf: str) -> DataFrame:
    out = st.drain(st.integrate(_stream(spark, sf), "1 second", "500 milliseconds", ["sub_band", "pol"]), new_dir(spark, "t02"))
    return out.select("start_us", "sub_band", "pol", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"), "n")


register("t02_tumbling", t02, fx.with_views(f"WITH {_ROWS} SELECT (floor(t_us / 500000) * 500000)::BIGINT AS start_us, sub_band, pol, round(avg(re), 6) + 0.0 AS re, round(avg(im), 6) + 0.0 AS im, count(*) AS n FROM st WHERE floor(t_us / 500000) * 500000 + 500000 <= (SELECT floor(max(t_us) / 1000) * 1000 - 1000000 FROM st) GROUP BY 1, 2, 3", "frames"))


def t03(spark: SparkSession, sf: str) -> DataFrame:
    out = st.drain(st.integrate(_stream(spark, sf), "1 second", "2 seconds", ["sub_band"], "1 second"), new_dir(spark, "t03"))
    return out.select("start_us", "sub_band", r6(F.col("re")).alias("re"), "n")


register("t03_sliding", t03, fx.with_views(f"WITH {_ROWS} SELECT ((floor(t_us / 1000000) - k) * 1000000)::BIGINT AS start_us, sub_band, round(avg(re), 6) + 0.0 AS re, count(*) AS n FROM st, (SELECT range AS k FROM range(2)) WHERE (floor(t_us / 1000000) - k) * 1000000 + 2000000 <= (SELECT floor(max(t_us) / 1000) * 1000 - 1000000 FROM st) GROUP BY 1, 2", "frames"))


def t04(spark: SparkSession, sf: str) -> DataFrame:
    return st.drain(st.sessions(_stream(spark, sf), "100 milliseconds", "30 milliseconds", ["sub_band"]), new_dir(spark, "t04"))


register("t04_sessions", t04, fx.with_views(f"""WITH {_ROWS}, a AS (SELECT *, t_us - lag(t_us) OVER (PARTITION BY sub_band ORDER BY t_us) >= 30000 AS cut FROM st), b AS (SELECT *, sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY sub_band ORDER BY t_us) AS s FROM a)
SELECT min(t_us) AS start_us, max(t_us) + 30000 AS end_us, sub_band, count(*) AS n FROM b GROUP BY sub_band, s HAVING max(t_us) + 30000 <= (SELECT floor(max(t_us) / 1000) * 1000 - 100000 FROM st)""", "frames"))


def t05(spark: SparkSession, sf: str) -> DataFrame:
    return st.drain(st.pair_polarizations(_stream(spark, sf), "1 second", 3125), new_dir(spark, "t05"))


register("t05_pairing", t05, fx.with_views("""WITH p AS (SELECT floor(t_us / 60000000)::BIGINT AS key, floor(t_us / 3125 / 2)::BIGINT + 1 AS source_id, bool_or(pol = 0) AS l, bool_or(pol = 1) AS r FROM frames GROUP BY 1, 2)
SELECT key, source_id, CASE WHEN NOT l THEN 1 ELSE 2 END AS error FROM p WHERE NOT (l AND r) AND source_id < (SELECT max(source_id) FROM p q WHERE q.key = p.key)""", "frames"))


def _grown(spark: SparkSession, sf: str, name: str, read) -> DataFrame:
    """Raw files of the suppliers' frames, some of which are missing, read as they grow.

    The stream runs over the first half, of which the last file breaks off in the middle, stops, and starts again from
    its checkpoint when the files are whole.
    """
    records = raw_records(spark, sf, 1).where("frame_no % 7 <> 3")
    folder = new_dir(spark, name)
    half = fx.table(spark, sf, "supplier").agg(F.max("s_suppkey")).first()[0] // 2
    for some in (records.where(F.col("frame_no") <= half), records):
        raw.write_files(some, f"{folder}/files", 60).collect()
        rows = st.catch_up(read(f"{folder}/files"), f"{folder}/out")
    return rows


def t01b(spark: SparkSession, sf: str) -> DataFrame:
    """Visibilities of raw files, decoded as they arrive and integrated over a cycle of eight frames."""
    read = lambda path: st.integrate(st.raw_stream(spark, path, 1, "samples", full=60), "10 milliseconds", "25 milliseconds", ["sub_band", "pol"])
    return _grown(spark, sf, "t01", read).select("start_us", "sub_band", "pol", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"), "n")


_RAW = "WITH x AS (SELECT s_suppkey AS n, s_suppkey * 3125 AS t_us, (s_suppkey % 2)::INT AS pol, CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey % 4 ELSE floor(s_suppkey % 8 / 2) END::INT AS sub_band FROM supplier WHERE s_suppkey % 7 <> 3), over AS (SELECT floor(max(t_us) / 1000) * 1000 - 10000 AS us FROM x)"

register("t01_raw_stream", t01b, f"""{_RAW}, v AS (SELECT x.*, (n * 7919 + rb * 131 + chan * 17) % 20011 - 10005 AS re, (n * 7919 + rb * 131 + chan * 17 + 5) % 20011 - 10005 AS im FROM x, {_receiver_pairs(raw.OUTPUTS[1], raw.ANTENNAS[1])}, (SELECT range::INT AS chan FROM range(16)))
SELECT (floor(t_us / 25000) * 25000)::BIGINT AS start_us, sub_band, pol, round(avg(re), 6) + 0.0 AS re, round(avg(im), 6) + 0.0 AS im, count(*) AS n FROM v WHERE floor(t_us / 25000) * 25000 + 25000 <= (SELECT us FROM over) GROUP BY 1, 2, 3""")

_W03 = "p AS (SELECT floor(t_us / 3125 / 2)::BIGINT + 1 AS source_id, bool_or(pol = 0) AS l, bool_or(pol = 1) AS r, min(t_us) AS t FROM {0} GROUP BY 1), e AS (SELECT source_id, CASE WHEN NOT l THEN 1 WHEN NOT r THEN 2 WHEN t - lag(t) OVER (ORDER BY source_id) > 8000 THEN 3 ELSE 0 END AS error FROM p)"


def t05b(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of polarizations from the headers of raw files as they arrive."""
    read = lambda path: st.pair_by_array(st.raw_stream(spark, path, 1, "headers", full=60).withColumn("sub_array", F.lit(1)), "10 milliseconds", 3125, 8000, 25_000)
    return _grown(spark, sf, "t05", read)


register("t05_raw_pairing", t05b, f"{_RAW}, {_W03.format('x')} SELECT 1 AS sub_array, source_id, error FROM e WHERE (floor(source_id * 6250 / 25000) + 1) * 25000 <= (SELECT us FROM over)")


def t05c(spark: SparkSession, sf: str) -> DataFrame:
    """The same of a stream in which frames repeat, keyed by array: pairs that pass a minute's end are whole."""
    stream = _stream(spark, sf, twice=True).withColumn("sub_array", F.lit(1))
    return st.drain(st.pair_by_array(stream, "1 second", 3125, 8000), new_dir(spark, "t05"))


register("t05_pairing_by_array", t05c, fx.with_views(f"WITH {_W03.format('frames')} SELECT 1 AS sub_array, source_id, error FROM e WHERE (floor(source_id * 6250 / 1000000) + 1) * 1000000 <= (SELECT floor(max(t_us) / 1000) * 1000 - 1000000 FROM frames)", "frames"))


def t06(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["sub_band", "pol", "bl", "chan"]
    out = st.drain(st.calibrated(_stream(spark, sf).drop("t"), fx.cal(spark, sf), keys), new_dir(spark, "t06"))
    return out.groupBy("sub_band", "pol").agg(F.count("*").alias("n"), r6(F.sum("re"), 3).alias("re"), r6(F.sum("im"), 3).alias("im"))


register("t06_static_join", t06, fx.with_views(f"WITH {_ROWS} SELECT st.sub_band, st.pol, count(*) AS n, round(sum(st.re * c.re + st.im * c.im), 3) + 0.0 AS re, round(sum(st.im * c.re - st.re * c.im), 3) + 0.0 AS im FROM st JOIN cal c USING (sub_band, pol, bl, chan) GROUP BY 1, 2", "frames", "cal"))


def t07(spark: SparkSession, sf: str) -> DataFrame:
    out = st.drain(st.once(_stream(spark, sf, twice=True), "1 second", ["sub_array", "t_us"]).drop("t"), new_dir(spark, "t07"))
    return out.groupBy("sub_band").agg(F.count("*").alias("n"), F.sum("re").alias("re"))


register("t07_duplicates", t07, fx.with_views(f"WITH {_ROWS} SELECT sub_band, count(*) AS n, sum(re) AS re FROM st GROUP BY 1", "frames"))


def t08(spark: SparkSession, sf: str) -> DataFrame:
    """A dirty image of each channel from every micro-batch of samples."""
    from visloom.plans.tools import _image

    path = new_dir(spark, "samples")
    _uv(spark, sf).write.parquet(path)
    stream = spark.readStream.schema("image_key int, u double, v double, re double, im double").parquet(path)
    make = lambda batch: im.per_image(batch, lambda pdf: _image(pdf)[0])
    images = st.each_batch(stream, new_dir(spark, "t08"), make, "image_key int, n int, data array<float>")
    return im.extrema(im.as_pixels(images))


register("t08_live_images", t08)


def s14(spark: SparkSession, sf: str) -> DataFrame:
    """The stream dumped into folders by band and polarization, and read again."""
    path = new_dir(spark, "dump")
    stream = _stream(spark, sf).drop("t")
    stream.writeStream.format("parquet").partitionBy("sub_band", "pol").option("checkpointLocation", f"{path}/state").option("path", f"{path}/rows").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows").groupBy("sub_band", "pol").agg(F.count("*").alias("n"), F.min("t_us").alias("first_us"))


register("s14_live_dump", s14, fx.with_views("SELECT sub_band, pol, count(*) AS n, min(t_us) AS first_us FROM frames GROUP BY 1, 2", "frames"))
