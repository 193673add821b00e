"""Queries of joins, aggregations, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visloom.functions import signal
from visloom.operators import calibrate as cb
from visloom.operators import flagging as fl
from visloom.operators import integrate as ig
from visloom.operators import params as pr
from visloom.operators import vistable as vt
from visloom.plans import fixtures as fx
from visloom.plans.scalars import r6
from visloom.registry import register


def j01(spark: SparkSession, sf: str) -> DataFrame:
    return fx.baselines(spark, sf).select("ant1", "ant2", "bl", "baseline_id", r6(F.col("be"), 4).alias("be"), r6(F.col("bn"), 4).alias("bn"))


register("j01_baselines", j01, fx.with_views("SELECT ant1, ant2, bl, baseline_id, round(be, 4) + 0.0 AS be, round(bn, 4) + 0.0 AS bn FROM baselines", "baselines"))


def _banded(spark: SparkSession, sf: str) -> DataFrame:
    return fx.visu(spark, sf).join(fx.frames(spark, sf).select("frame_id", "sub_band", "pol", "t_us"), "frame_id")


def j02(spark: SparkSession, sf: str) -> DataFrame:
    v = cb.calibrate(_banded(spark, sf), fx.cal(spark, sf), ["sub_band", "pol", "bl", "chan"])
    return v.select("frame_id", "bl", "chan", "sub_band", "pol", r6(F.col("re"), 5).alias("re"), r6(F.col("im"), 5).alias("im"))


register("j02_calibrate", j02, fx.with_views("SELECT v.frame_id, v.bl, v.chan, f.sub_band, f.pol, round(v.re * c.re + v.im * c.im, 5) + 0.0 AS re, round(v.im * c.re - v.re * c.im, 5) + 0.0 AS im FROM visu v JOIN frames f USING (frame_id) JOIN cal c ON c.sub_band = f.sub_band AND c.pol = f.pol AND c.bl = v.bl AND c.chan = v.chan", "visu", "frames", "cal"))


def j02b(spark: SparkSession, sf: str) -> DataFrame:
    """Calibration outside loop mode: by baseline and channel alone."""
    flat = fx.cal(spark, sf).where("sub_band = 0 AND pol = 0")
    v = cb.calibrate(fx.visu(spark, sf), flat, ["bl", "chan"])
    return v.groupBy("bl").agg(r6(F.sum("re"), 4).alias("re"), r6(F.sum("im"), 4).alias("im"))


register("j02_calibrate_fixed_mode", j02b, fx.with_views("SELECT v.bl, round(sum(v.re * c.re + v.im * c.im), 4) + 0.0 AS re, round(sum(v.im * c.re - v.re * c.im), 4) + 0.0 AS im FROM visu v JOIN cal c ON c.bl = v.bl AND c.chan = v.chan WHERE c.sub_band = 0 AND c.pol = 0 GROUP BY 1", "visu", "cal"))


def j03(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.frames(spark, sf)
    delays = f.select("frame_id", F.transform(F.sequence(F.lit(0), F.lit(39)), lambda a: (F.col("frame_id") * 7 + a * 13) % 97 / 8.0 - 6).alias("delay"))
    v = fx.vis(spark, sf).join(f.select("frame_id", ((F.col("sub_band") + 1) * 4e8).alias("freq_hz"), (F.col("sub_array") % 2 + 1).alias("sub_array")), "frame_id")
    out = cb.stop_fringes(v, delays, F.col("frame_id") % 5 != 0)
    return out.groupBy("ant1", "ant2", "sub_array").agg(r6(F.sum("re"), 3).alias("re"), r6(F.sum("im"), 3).alias("im"))


register("j03_fringe_stop", j03, fx.with_views("""WITH d AS (SELECT v.*, (sub_band + 1) * 4e8 AS hz, f.sub_array % 2 + 1 AS arr, (v.frame_id * 7 + ant1 * 13) % 97 / 8.0 - 6 AS d1, (v.frame_id * 7 + ant2 * 13) % 97 / 8.0 - 6 AS d2 FROM vis v JOIN frames f USING (frame_id)),
p AS (SELECT *, 2 * pi() * (CASE WHEN arr = 1 THEN 1 ELSE -1 END * ((hz * 1e-6 + CASE WHEN arr = 1 THEN chan ELSE 15 - chan END * 25 + 12.5) / 1000.0) * (d2 - d1) - ((chan * 25 + 12.5 + 50.0) / 1000.0) * (trunc(d2) - trunc(d1))) AS phi FROM d)
SELECT ant1, ant2, arr AS sub_array, round(sum(CASE WHEN frame_id % 5 <> 0 THEN re * cos(phi) + im * sin(phi) ELSE re END), 3) + 0.0 AS re, round(sum(CASE WHEN frame_id % 5 <> 0 THEN (im * cos(phi) - re * sin(phi)) * CASE WHEN arr = 1 THEN 1 ELSE -1 END ELSE im END), 3) + 0.0 AS im FROM p GROUP BY 1, 2, 3""", "vis", "frames"))


def j04(spark: SparkSession, sf: str) -> DataFrame:
    return pr.as_of(fx.probe(spark, sf), fx.params(spark, sf), "freq").groupBy("freq", "t").agg(F.max("value").alias("value"), F.count("*").alias("n"))


register("j04_as_of", j04, fx.with_views("WITH p AS (SELECT freq, ref_time, arg_max(value, id) AS value FROM params GROUP BY 1, 2), q AS (SELECT freq, t, count(*) AS n FROM probe GROUP BY 1, 2) SELECT q.freq, q.t, p.value, q.n FROM q ASOF LEFT JOIN p ON p.freq = q.freq AND p.ref_time <= q.t", "params", "probe"))


def j05(spark: SparkSession, sf: str) -> DataFrame:
    return pr.bracket(fx.probe(spark, sf).distinct(), fx.params(spark, sf), "freq")


register("j05_bracket", j05, fx.with_views("WITH p AS (SELECT freq, ref_time, arg_max(value, id) AS value FROM params GROUP BY 1, 2), q AS (SELECT DISTINCT * FROM probe), a AS (SELECT q.freq, q.t, p.value AS previous FROM q ASOF LEFT JOIN p ON p.freq = q.freq AND p.ref_time <= q.t) SELECT a.freq, a.t, a.previous, p.value AS next FROM a ASOF LEFT JOIN p ON p.freq = a.freq AND p.ref_time >= a.t", "params", "probe"))


def j06(spark: SparkSession, sf: str) -> DataFrame:
    good = fl.drop_bad_antennas(fx.vis(spark, sf), fx.bad_antennas(spark).where("obs_day = '2015-11-01'"))
    return good.groupBy("ant1", "ant2").agg(F.count("*").alias("n"), F.sum("re").alias("re"))


register("j06_drop_bad_antennas", j06, fx.with_views("SELECT ant1, ant2, count(*) AS n, sum(re) AS re FROM vis WHERE ant1 NOT IN (SELECT ant FROM bad WHERE obs_day = '2015-11-01') AND ant2 NOT IN (SELECT ant FROM bad WHERE obs_day = '2015-11-01') GROUP BY 1, 2", "vis", "bad"))


def j07(spark: SparkSession, sf: str) -> DataFrame:
    uvw = fx.baselines(spark, sf).select("bl", "be", "bn")
    v = fx.visu(spark, sf).join(uvw, "bl")
    return v.select("frame_id", "bl", "chan", "re", r6(F.col("be") * F.cos(F.col("frame_id") * 0.001) + F.col("bn") * F.sin(F.col("frame_id") * 0.001), 3).alias("u"))


register("j07_attach_uvw", j07, fx.with_views("SELECT v.frame_id, v.bl, v.chan, v.re, round(b.be * cos(v.frame_id * 0.001) + b.bn * sin(v.frame_id * 0.001), 3) + 0.0 AS u FROM visu v JOIN baselines b USING (bl)", "visu", "baselines"))


def j08(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 25).alias("source_id"), (F.col("l_partkey") % 5).alias("freqsel"), "l_quantity")
    source = fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("source"))
    freq = fx.table(spark, sf, "region").select(F.col("r_regionkey").alias("freqsel"), (F.col("r_regionkey") * 4e8 + 4e8).alias("hz"))
    return v.join(source, "source_id").join(freq, "freqsel").groupBy("source", "hz").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


register("j08_dimensions", j08, "SELECT n_name AS source, r_regionkey * 4e8 + 4e8 AS hz, count(*) AS n, sum(l_quantity) AS total FROM lineitem JOIN nation ON n_nationkey = l_suppkey % 25 JOIN region ON r_regionkey = l_partkey % 5 GROUP BY 1, 2")


def j09(spark: SparkSession, sf: str) -> DataFrame:
    mean = lambda scan: fx.vis(spark, sf).where(F.col("scan") == scan).groupBy("ant1", "ant2", "chan").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    out = cb.reference_phases(mean("N"), mean("R"), ["ant1", "ant2", "chan"])
    return out.select("ant1", "ant2", "chan", r6(F.col("amp"), 5).alias("amp"), r6(F.col("phase"), 5).alias("phase"))


register("j09_reference_source", j09, fx.with_views("WITH m AS (SELECT scan, ant1, ant2, chan, avg(re) AS re, avg(im) AS im FROM vis GROUP BY 1, 2, 3, 4) SELECT n.ant1, n.ant2, n.chan, round(sqrt(n.re * n.re + n.im * n.im), 5) + 0.0 AS amp, round(atan2(n.im, n.re) - atan2(r.im, r.re), 5) + 0.0 AS phase FROM m n JOIN m r USING (ant1, ant2, chan) WHERE n.scan = 'N' AND r.scan = 'R'", "vis"))


def j10(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.params(spark, sf).groupBy("freq", "ref_time").agg(F.max_by("value", "id").alias("value"))
    new = fx.probe(spark, sf).groupBy("freq", F.col("t").alias("ref_time")).agg(F.count("*").cast("double").alias("value")).where("value > 20")
    gone = p.where("month(ref_time) = 2")
    return pr.remove(pr.upsert(p, new, ["freq", "ref_time"]), gone, ["freq", "ref_time"])


register("j10_upsert_delete", j10, fx.with_views("WITH p AS (SELECT freq, ref_time, arg_max(value, id) AS value FROM params GROUP BY 1, 2), n AS (SELECT freq, t AS ref_time, count(*)::DOUBLE AS value FROM probe GROUP BY 1, 2 HAVING count(*) > 20), u AS (SELECT * FROM n UNION ALL SELECT * FROM p WHERE (freq, ref_time) NOT IN (SELECT (freq, ref_time) FROM n)) SELECT * FROM u WHERE (freq, ref_time) NOT IN (SELECT (freq, ref_time) FROM p WHERE month(ref_time) = 2)", "params", "probe"))


def j11(spark: SparkSession, sf: str) -> DataFrame:
    """Visibilities inside an interval of a flag table, one of each order: some for all sources, bands, antennas or partners."""
    k = F.col("o_orderkey")
    known = lambda every, x: F.when(k % every > 0, x.cast("int"))
    flags = fx.table(spark, sf, "orders").select(
        known(3, k % 2).alias("source"), known(97, F.col("o_custkey") % 40).alias("ant_a"), known(4, F.floor("o_totalprice") % 40).alias("ant_b"), known(5, k % 4).alias("band"),
        F.col("o_orderdate").alias("t0"), F.date_add("o_orderdate", 20).alias("t1"), (k % 8).cast("int").alias("c0"), (k % 8 + k % 5).cast("int").alias("c1"),
    )
    v = fx.vis(spark, sf).withColumn("source", (F.col("frame_id") % 2).cast("int")).withColumn("band", (F.col("frame_id") % 4).cast("int"))
    v = v.select("source", "ant1", "ant2", "band", "chan", "obs_ts", "re")
    return ig.flagged_by_ranges(v, flags).groupBy("ant1", "chan").agg(F.count("*").alias("n"), F.sum("re").alias("re"))


register("j11_flag_ranges", j11, fx.with_views("""WITH fl AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 2 END AS source, CASE WHEN o_orderkey % 97 > 0 THEN o_custkey % 40 END AS ant_a, CASE WHEN o_orderkey % 4 > 0 THEN floor(o_totalprice)::BIGINT % 40 END AS ant_b,
CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 4 END AS band, o_orderdate AS t0, o_orderdate + INTERVAL 20 DAY AS t1, o_orderkey % 8 AS c0, o_orderkey % 8 + o_orderkey % 5 AS c1 FROM orders),
pairs AS (SELECT ant_a AS a, ant_b AS b, * EXCLUDE (ant_a, ant_b) FROM fl WHERE ant_a IS NOT NULL AND ant_b IS NOT NULL UNION ALL SELECT ant_b, ant_a, * EXCLUDE (ant_a, ant_b) FROM fl WHERE ant_a IS NOT NULL AND ant_b IS NOT NULL),
x AS (SELECT row_number() OVER () AS k, *, frame_id % 2 AS source, frame_id % 4 AS band FROM vis),
hits AS (SELECT k FROM x JOIN pairs f ON f.a = x.ant1 AND f.b = x.ant2 AND x.obs_ts BETWEEN t0 AND t1 AND chan BETWEEN c0 AND c1 AND (f.source IS NULL OR f.source = x.source) AND (f.band IS NULL OR f.band = x.band)
UNION SELECT k FROM x JOIN fl f ON f.ant_b IS NULL AND f.ant_a = x.ant1 AND x.obs_ts BETWEEN t0 AND t1 AND chan BETWEEN c0 AND c1 AND (f.source IS NULL OR f.source = x.source) AND (f.band IS NULL OR f.band = x.band)
UNION SELECT k FROM x JOIN fl f ON f.ant_b IS NULL AND f.ant_a = x.ant2 AND x.obs_ts BETWEEN t0 AND t1 AND chan BETWEEN c0 AND c1 AND (f.source IS NULL OR f.source = x.source) AND (f.band IS NULL OR f.band = x.band)
UNION SELECT k FROM x JOIN (SELECT * FROM fl WHERE ant_a IS NULL) f ON x.obs_ts BETWEEN t0 AND t1 AND chan BETWEEN c0 AND c1 AND (f.source IS NULL OR f.source = x.source) AND (f.band IS NULL OR f.band = x.band))
SELECT ant1, chan, count(*) AS n, sum(re) AS re FROM x WHERE k IN (SELECT k FROM hits) GROUP BY 1, 2""", "vis"))


def a01(spark: SparkSession, sf: str) -> DataFrame:
    return ig.integrate_frames(_banded(spark, sf), cycle=8, cycles=20).select("integration", "sub_band", "pol", "bl", "chan", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"), "t_mid", "n")


register("a01_integrate_frames", a01, fx.with_views("SELECT floor(frame_id / 160)::BIGINT AS integration, sub_band, pol, bl, chan, round(avg(re), 6) + 0.0 AS re, round(avg(im), 6) + 0.0 AS im, (min(t_us) + max(t_us)) / 2 AS t_mid, count(*) AS n FROM visu JOIN frames USING (frame_id) GROUP BY 1, 2, 3, 4, 5", "visu", "frames"))


def _banded_uv(spark: SparkSession, sf: str) -> DataFrame:
    return fx.with_uv(spark, sf).join(fx.frames(spark, sf).select("frame_id", "sub_band", "pol", "t_us"), "frame_id")


def a02(spark: SparkSession, sf: str) -> DataFrame:
    means = ig.average_bins(_banded_uv(spark, sf), 1_000_000)
    return means.select("bin", "sub_band", "pol", "bl", "chan", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"), r6(F.col("u"), 4).alias("u"), r6(F.col("v"), 4).alias("v"), "n_frames")


register("a02_interval_average", a02, fx.with_views("SELECT floor(t_us / 1000000)::BIGINT AS bin, sub_band, pol, bl, chan, round(avg(re), 6) + 0.0 AS re, round(avg(im), 6) + 0.0 AS im, round(avg(u), 4) + 0.0 AS u, round(avg(uv.v), 4) + 0.0 AS v, count(DISTINCT frame_id) AS n_frames FROM uv JOIN frames USING (frame_id) GROUP BY 1, 2, 3, 4, 5", "uv", "frames"))


def a03(spark: SparkSession, sf: str) -> DataFrame:
    """One frame of each band and polarization every second of a fixed grid."""
    return ig.sample_grid(fx.frames(spark, sf), 1_000_000).select("sub_band", "pol", "slot", "frame_id", "t_us")


register("a03_interval_sample_grid", a03, fx.with_views("SELECT sub_band, pol, floor(t_us / 1000000)::BIGINT AS slot, arg_min(frame_id, t_us) AS frame_id, min(t_us) AS t_us FROM frames GROUP BY 1, 2, 3", "frames"))


def a03c(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the chain: the next frame is the first at least a second after the one picked last."""
    return ig.sample_chain(fx.frames(spark, sf), ["sub_band", "pol"], 1_000_000)


register("a03_interval_sample_chain", a03c, fx.with_views("""WITH RECURSIVE c AS (SELECT sub_band, pol, min(t_us) AS t_us FROM frames GROUP BY 1, 2
UNION ALL SELECT c.sub_band, c.pol, (SELECT min(f.t_us) FROM frames f WHERE f.sub_band = c.sub_band AND f.pol = c.pol AND f.t_us >= c.t_us + 1000000) FROM c WHERE EXISTS (SELECT 1 FROM frames f WHERE f.sub_band = c.sub_band AND f.pol = c.pol AND f.t_us >= c.t_us + 1000000))
SELECT * FROM c""".replace("WITH RECURSIVE", "WITH", 1), "frames").replace("WITH ", "WITH RECURSIVE ", 1))


def a04(spark: SparkSession, sf: str) -> DataFrame:
    """The mixture, turned to a centre a little off; u and v of its mean in wavelengths."""
    mean = ig.mixture(_banded_uv(spark, sf), fx.frames(spark, sf), 1_000_000, 30_000)
    waves = ((F.col("sub_band") + 1) * 4e8 + F.col("chan") * 25e6 + 12.5e6) / signal.C
    v = ig.shift_phases(mean, signal.offset_phase(F.col("u") * waves, F.col("v") * waves, F.lit(2e-4), F.lit(-1e-4)))
    return v.select("slot", "sub_band", "pol", "bl", "chan", r6(F.col("re"), 5).alias("re"), r6(F.col("im"), 5).alias("im"))


register("a04_mixture", a04, fx.with_views("""WITH f AS (SELECT *, row_number() OVER (PARTITION BY sub_band, pol, floor(t_us / 1000000) ORDER BY t_us) AS k, floor(t_us / 1000000)::BIGINT AS slot FROM frames),
m AS (SELECT slot, sub_band, pol, bl, chan, avg(re) AS re, avg(im) AS im, avg(u) AS u, avg(uv.v) AS w FROM uv JOIN f USING (frame_id) WHERE k <= 10 GROUP BY 1, 2, 3, 4, 5), p AS (SELECT *, 2 * pi() * (((sub_band + 1) * 4e8 + chan * 25e6 + 12.5e6) / 299792458.0) * (u * 2e-4 + w * -1e-4) AS phi FROM m)
SELECT slot, sub_band, pol, bl, chan, round(re * cos(phi) + im * sin(phi), 5) + 0.0 AS re, round(im * cos(phi) - re * sin(phi), 5) + 0.0 AS im FROM p""", "uv", "frames"))


def a05(spark: SparkSession, sf: str) -> DataFrame:
    return cb.calibration_table(_banded(spark, sf).where("frame_id >= 100"), ["sub_band", "pol", "bl", "chan"], "frame_id").select("sub_band", "pol", "bl", "chan", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


register("a05_build_calibration", a05, fx.with_views("SELECT sub_band, pol, bl, chan, round(arg_max(re, frame_id), 6) + 0.0 AS re, round(arg_max(im, frame_id), 6) + 0.0 AS im FROM visu JOIN frames USING (frame_id) WHERE frame_id >= 100 GROUP BY 1, 2, 3, 4", "visu", "frames"))


def a12(spark: SparkSession, sf: str) -> DataFrame:
    power = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    v = fx.vis(spark, sf).withColumn("p", power)
    middle = vt.quantiles(v, ["ant1", "ant2"], "p", {"median": 0.5})
    return middle.join(v.groupBy("ant1", "ant2").agg(F.min("p").alias("low"), F.max("p").alias("high"), r6(F.var_pop("p"), 2).alias("variance"), r6(F.skewness("p"), 4).alias("skew"), r6(F.kurtosis("p"), 4).alias("kurt"), r6(10 * F.log10(F.avg("p")), 4).alias("db")), ["ant1", "ant2"])


register("a12_spectral_statistics", a12, fx.with_views("""WITH m AS (SELECT ant1, ant2, p, avg(p) OVER (PARTITION BY ant1, ant2) AS mu FROM (SELECT *, re * re + im * im AS p FROM vis))
SELECT ant1, ant2, median(p) AS median, min(p) AS low, max(p) AS high, round(var_pop(p), 2) + 0.0 AS variance,
round(CASE WHEN avg((p - mu) ^ 2) > 0 THEN avg((p - mu) ^ 3) / avg((p - mu) ^ 2) ^ 1.5 END, 4) + 0.0 AS skew, round(CASE WHEN avg((p - mu) ^ 2) > 0 THEN avg((p - mu) ^ 4) / avg((p - mu) ^ 2) ^ 2 - 3 END, 4) + 0.0 AS kurt, round(10 * log10(avg(p)), 4) + 0.0 AS db FROM m GROUP BY 1, 2""", "vis"))


def a13(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.visu(spark, sf).select("bl", "chan").join(fx.baselines(spark, sf), "bl")
    scale = (F.col("chan") * 25e6 + 4e8) / 299792458.0
    return v.groupBy("chan").agg(r6(F.max(F.abs(F.col("be") * scale)), 2).alias("umax"), r6(F.max(F.abs(F.col("bn") * scale)), 2).alias("vmax"), F.count_distinct("bl").alias("points"))


register("a13_uv_coverage", a13, fx.with_views("SELECT chan, round(max(abs(be * ((chan * 25e6 + 4e8) / 299792458.0))), 2) + 0.0 AS umax, round(max(abs(bn * ((chan * 25e6 + 4e8) / 299792458.0))), 2) + 0.0 AS vmax, count(DISTINCT bl) AS points FROM visu JOIN baselines USING (bl) GROUP BY 1", "visu", "baselines"))


def a16(spark: SparkSession, sf: str) -> DataFrame:
    """Kept and flagged samples of each antenna, for each day's list."""
    v, bad = fx.vis(spark, sf), fx.bad_antennas(spark)
    counts = v.groupBy("ant1", "ant2").agg(F.count("*").alias("n"))
    lists = bad.groupBy("obs_day").agg(F.collect_set("ant").alias("bad"))
    # Two short lists, each held against every baseline.
    both = counts.crossJoin(F.broadcast(lists))
    hit = F.array_contains("bad", F.col("ant1")) | F.array_contains("bad", F.col("ant2"))
    return both.groupBy("obs_day", "ant1").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("flagged"), F.sum(F.when(hit, 0).otherwise(F.col("n"))).alias("kept"))


register("a16_flag_bookkeeping", a16, fx.with_views("SELECT obs_day, ant1, sum(CASE WHEN hit THEN 1 ELSE 0 END)::BIGINT AS flagged, sum(CASE WHEN hit THEN 0 ELSE 1 END)::BIGINT AS kept FROM (SELECT d.obs_day, v.ant1, (v.ant1 IN (SELECT ant FROM bad b WHERE b.obs_day = d.obs_day) OR v.ant2 IN (SELECT ant FROM bad b WHERE b.obs_day = d.obs_day)) AS hit FROM vis v, (SELECT DISTINCT obs_day FROM bad) d) GROUP BY 1, 2", "vis", "bad"))


def w01(spark: SparkSession, sf: str) -> DataFrame:
    return ig.gaps(fx.frames(spark, sf).withColumn("sub_array", F.lit(1)), 3125)


register("w01_frame_gaps", w01, fx.with_views("SELECT 1 AS sub_array, frame_id, t_us, floor(dt / 3125)::BIGINT AS skipped FROM (SELECT *, t_us - lag(t_us) OVER (ORDER BY t_us) AS dt FROM frames) WHERE dt > 3125", "frames"))


def w02(spark: SparkSession, sf: str) -> DataFrame:
    """Every slot of the clock, absent frames as weight 0."""
    filled = ig.fill_slots(fx.frames(spark, sf), 3125)
    return filled.groupBy("minute").agg(F.count("*").alias("slots"), F.sum("weight").alias("present"), r6(F.sum("value"), 3).alias("value"))


register("w02_fill_missing", w02, fx.with_views("SELECT floor(s * 3125 / 60000000)::BIGINT AS minute, count(*) AS slots, sum(CASE WHEN f.frame_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS present, round(sum(coalesce(f.value, 0.0)), 3) + 0.0 AS value FROM (SELECT unnest(generate_series((SELECT min(t_us) // 3125 FROM frames), (SELECT max(t_us) // 3125 FROM frames))) AS s) LEFT JOIN frames f ON f.t_us = s * 3125 GROUP BY 1", "frames"))


def w03(spark: SparkSession, sf: str) -> DataFrame:
    return ig.pair_polarizations(fx.frames(spark, sf), 3125, 8000)


register("w03_pair_polarizations", w03, fx.with_views("""WITH p AS (SELECT floor(t_us / 3125 / 2)::BIGINT + 1 AS source_id, max(CASE WHEN pol = 0 THEN t_us END) AS ll, max(CASE WHEN pol = 1 THEN t_us END) AS rr, min(t_us) AS t FROM frames GROUP BY 1)
SELECT source_id, CASE WHEN ll IS NULL THEN 1 WHEN rr IS NULL THEN 2 WHEN t - lag(t) OVER (ORDER BY source_id) > 8000 THEN 3 ELSE 0 END AS error FROM p""", "frames"))


def w04(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.frames(spark, sf)
    n = ig.number_frames(f, ["sub_band", "pol"], "t_us")
    return n.select("frame_id", "sub_band", "pol", F.col("n").cast("long").alias("n"), F.floor((F.col("n") - 1) / 20).alias("integration"))


register("w04_frame_numbers", w04, fx.with_views("SELECT frame_id, sub_band, pol, n, floor((n - 1) / 20)::BIGINT AS integration FROM (SELECT *, row_number() OVER (PARTITION BY sub_band, pol ORDER BY t_us) AS n FROM frames)", "frames"))


def w08(spark: SparkSession, sf: str) -> DataFrame:
    """The three dearest and the newest parameter of each receiver."""
    p = fx.params(spark, sf)
    top = p.withColumn("k", F.row_number().over(W.partitionBy("freq").orderBy(F.desc("value"), "id"))).where("k <= 3").select("freq", "k", "id")
    newest = p.groupBy("freq").agg(F.max_by("id", F.struct("ref_time", "id")).alias("id")).select("freq", F.lit(0).alias("k"), "id")
    return top.union(newest)


register("w08_top_k", w08, fx.with_views("SELECT freq, k::INT AS k, id FROM (SELECT *, row_number() OVER (PARTITION BY freq ORDER BY value DESC, id) AS k FROM params) WHERE k <= 3 UNION ALL SELECT freq, 0, id FROM (SELECT *, row_number() OVER (PARTITION BY freq ORDER BY ref_time DESC, id DESC) AS k FROM params) WHERE k = 1", "params"))


def w09(spark: SparkSession, sf: str) -> DataFrame:
    from visloom.operators.geometry import baseline_order_errors

    v = fx.visu(spark, sf).withColumn("seq", F.row_number().over(W.partitionBy("frame_id", "chan").orderBy("ant1", "ant2")) - 1)
    return baseline_order_errors(v, 40)


register("w09_baseline_order", w09, fx.with_views("SELECT frame_id, count(*) FILTER (seq <> bl) AS n_wrong, count(*) AS n_rows FROM (SELECT *, row_number() OVER (PARTITION BY frame_id, chan ORDER BY ant1, ant2) - 1 AS seq FROM visu) GROUP BY 1", "visu"))


def w10(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.frames(spark, sf)
    return f.groupBy(F.floor(F.col("t_us") / 60_000_000).alias("minute_file")).agg(F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"), F.count("*").alias("n"))


register("w10_minute_files", w10, fx.with_views("SELECT floor(t_us / 60000000)::BIGINT AS minute_file, min(frame_id) AS first_frame, max(frame_id) AS last_frame, count(*) AS n FROM frames GROUP BY 1", "frames"))


def w11(spark: SparkSession, sf: str) -> DataFrame:
    """Drifting pointing: means of the n-th integration of each band are turned forward by n steps of the drift."""
    means = ig.average_bins(_banded_uv(spark, sf), 1_000_000)
    bins = fx.frames(spark, sf).select("sub_band", F.floor(F.col("t_us") / 1_000_000).alias("bin")).distinct()
    # One row an integration and band.
    numbered = bins.select("sub_band", "bin", F.dense_rank().over(W.partitionBy("sub_band").orderBy("bin")).cast("long").alias("n"))
    hz = (F.col("sub_band") + 1) * 4e8 + F.col("chan") * 25e6 + 12.5e6
    turned = ig.shift_phases(means.join(numbered, ["sub_band", "bin"]), -signal.drifting_phase(F.col("u") / signal.C, F.col("v") / signal.C, hz, F.col("n")))
    return turned.groupBy("sub_band", "bin", "n").agg(r6(-0.1 + 0.02 * F.first("n")).alias("dec_offset"), r6(F.sum("re"), 3).alias("re"), r6(F.sum("im"), 3).alias("im"))


register("w11_pointing_drift", w11, fx.with_views("""WITH d AS (SELECT *, dense_rank() OVER (PARTITION BY sub_band ORDER BY bin) AS n FROM (SELECT DISTINCT sub_band, floor(t_us / 1000000)::BIGINT AS bin FROM frames)),
m AS (SELECT floor(t_us / 1000000)::BIGINT AS bin, sub_band, pol, bl, chan, avg(re) AS re, avg(im) AS im, avg(u) AS u, avg(uv.v) AS w FROM uv JOIN frames USING (frame_id) GROUP BY 1, 2, 3, 4, 5),
p AS (SELECT m.*, n, 2 * pi() * ((sub_band + 1) * 4e8 + chan * 25e6 + 12.5e6) * (u / 299792458.0 * radians(0.14::DOUBLE) + w / 299792458.0 * radians(-0.1::DOUBLE + 0.02::DOUBLE * n)) AS phi FROM m JOIN d USING (sub_band, bin))
SELECT sub_band, bin, n, (round(-0.1 + 0.02 * n, 6) + 0.0)::DOUBLE AS dec_offset, round(sum(re * cos(phi) - im * sin(phi)), 3) + 0.0 AS re, round(sum(im * cos(phi) + re * sin(phi)), 3) + 0.0 AS im FROM p GROUP BY 1, 2, 3""", "uv", "frames"))


def u01(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of several tasks as one set with numbers of its own."""
    f = fx.frames(spark, sf)
    chunks = [f.where(F.col("sub_band") == k).select("frame_id", "t_us", "sub_band", F.lit(k).alias("task")) for k in (2, 0, 3, 1)]
    return ig.merge_chunks(chunks, "t_us").select("frame_id", "task", F.col("n").cast("long").alias("n"))


register("u01_merge_chunks", u01, fx.with_views("SELECT frame_id, sub_band AS task, row_number() OVER (PARTITION BY floor(t_us / 60000000) ORDER BY t_us) AS n FROM frames", "frames"))


def u02(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.baselines(spark, sf).select("ant1", "ant2", "bl")
    bad = fx.bad_antennas(spark).where("obs_day = '2014-11-11'").select("ant")
    flagged = b.join(bad, (F.col("ant") == F.col("ant1")) | (F.col("ant") == F.col("ant2")), "left_semi")
    return b.exceptAll(flagged)


register("u02_good_baselines", u02, fx.with_views("SELECT ant1, ant2, bl FROM baselines WHERE ant1 NOT IN (SELECT ant FROM bad WHERE obs_day = '2014-11-11') AND ant2 NOT IN (SELECT ant FROM bad WHERE obs_day = '2014-11-11')", "baselines", "bad"))


def u03(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf)
    return v.groupBy("scan").agg(F.size(F.collect_set("ant1")).cast("long").alias("antennas"), F.count_distinct("ant1", "ant2").alias("baselines"), F.array_join(F.sort_array(F.collect_set("chan")), ",").alias("channels"))


register("u03_distinct_sets", u03, fx.with_views("SELECT scan, count(DISTINCT ant1) AS antennas, count(DISTINCT (ant1, ant2)) AS baselines, array_to_string(list_sort(list(DISTINCT chan)), ',') AS channels FROM vis GROUP BY 1", "vis"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Bad antennas, calibration, one-second mean, statistics of amplitude by band, polarization and channel, over all frames."""
    good = fl.drop_bad_antennas(_banded(spark, sf), fx.bad_antennas(spark).where("obs_day = '2014-11-11'"))
    means = ig.average_bins(cb.calibrate(good, fx.cal(spark, sf), ["sub_band", "pol", "bl", "chan"]), 1_000_000)
    amp = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    return means.groupBy("sub_band", "pol", "chan").agg(F.count("*").alias("n"), r6(F.min(amp), 4).alias("low"), r6(F.max(amp), 4).alias("high"), r6(F.avg(amp), 4).alias("mean"))


register("flagship_calibrated_statistics", flagship, fx.with_views("""WITH g AS (SELECT v.*, f.sub_band, f.pol, f.t_us FROM visu v JOIN frames f USING (frame_id) WHERE v.ant1 NOT IN (SELECT ant FROM bad WHERE obs_day = '2014-11-11') AND v.ant2 NOT IN (SELECT ant FROM bad WHERE obs_day = '2014-11-11')),
m AS (SELECT floor(t_us / 1000000) AS bin, g.sub_band, g.pol, g.bl, g.chan, avg(g.re * c.re + g.im * c.im) AS re, avg(g.im * c.re - g.re * c.im) AS im FROM g JOIN cal c ON c.sub_band = g.sub_band AND c.pol = g.pol AND c.bl = g.bl AND c.chan = g.chan GROUP BY 1, 2, 3, 4, 5)
SELECT sub_band, pol, chan, count(*) AS n, round(min(sqrt(re * re + im * im)), 4) + 0.0 AS low, round(max(sqrt(re * re + im * im)), 4) + 0.0 AS high, round(avg(sqrt(re * re + im * im)), 4) + 0.0 AS mean FROM m GROUP BY 1, 2, 3""", "visu", "frames", "cal", "bad"))
