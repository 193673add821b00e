"""Queries of the visibility-table tools and of pixel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visloom.operators import cubes as cu
from visloom.operators import flagging as fl
from visloom.operators import imaging as im
from visloom.operators import metadata as md
from visloom.operators import vistable as vt
from visloom.functions.signal import image_geometry
from visloom.operators.blockimages import image_blocks
from visloom.operators.geometry import baseline_index
from visloom.operators.timecube import TimeCube
from visloom.plans import fixtures as fx
from visloom.plans.joins import _banded
from visloom.plans.scalars import away, r6
from visloom.registry import register
from visloom.scratch import new_dir
from visloom.scratch import store as store_table
from visloom.sources.flagversions import MERGES, FlagVersions

SPEED = 299792458.0


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    """Exposures of receivers: an order line is one of as many hours as its quantity, of a field in a spectral window."""
    x = fx.table(spark, sf, "lineitem")
    start = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 1800
    return x.select(
        F.col("l_suppkey").cast("long").alias("receiver"), (F.col("l_partkey") % 5).cast("int").alias("field"), (F.col("l_orderkey") % 4).cast("int").alias("spw"), (F.floor("l_extendedprice").cast("long") % 16).cast("int").alias("chan"),
        start.alias("start"), (start + F.col("l_quantity").cast("long") * 3600).alias("end"),
    )


_OBSERVED = "WITH o AS (SELECT l_suppkey::BIGINT AS receiver, (l_partkey % 5)::INT AS field, (l_orderkey % 4)::INT AS spw, (floor(l_extendedprice)::BIGINT % 16)::INT AS chan, epoch(l_shipdate::TIMESTAMP)::BIGINT + l_linenumber * 1800 AS s, epoch(l_shipdate::TIMESTAMP)::BIGINT + l_linenumber * 1800 + l_quantity::BIGINT * 3600 AS e FROM lineitem)"
_SEEN = _OBSERVED + ", p AS (SELECT *, max(e) OVER (PARTITION BY receiver ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM o)"
_SCANS = _SEEN + ", n AS (SELECT *, sum((seen IS NULL OR s > seen + 86400)::INT) OVER (PARTITION BY receiver ORDER BY s, e, (seen IS NULL OR s > seen + 86400) DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS scan FROM p)"
_MONTH = 30 * 86400


def d30b(spark: SparkSession, sf: str) -> DataFrame:
    return md.exposure(_observed(spark, sf), ["receiver"], "start", "end", _MONTH)


register("d30_exposure", d30b, _SEEN + " SELECT receiver, sum(greatest(e - greatest(s, coalesce(seen, s)), 0))::BIGINT AS covered, sum(e - s)::BIGINT AS total, min_by(e - s, {'s': s, 'e': e}) AS first, count(*) AS n FROM p GROUP BY 1")


def _scanned(spark: SparkSession, sf: str) -> DataFrame:
    return md.scans(_observed(spark, sf), ["receiver"], "start", "end", 86400, _MONTH)


def d30c(spark: SparkSession, sf: str) -> DataFrame:
    return md.scan_list(_scanned(spark, sf), ["receiver"], "start", "end", "start")


register("d30_scans", d30c, _SCANS + " SELECT receiver, scan, min(s) AS first, max(e) AS last, count(*) AS rows, count(DISTINCT s) AS times FROM n GROUP BY 1, 2")


def d30d(spark: SparkSession, sf: str) -> DataFrame:
    """Nested lists, as text: receiver and its scans of each field."""
    each = F.transform("scans", lambda x: F.concat(x["receiver"].cast("string"), F.lit(":"), F.array_join(x["scans"].cast("array<string>"), ",")))
    return md.scans_by_field(_scanned(spark, sf), "field", ["receiver"]).select("field", F.size("scans").cast("long").alias("receivers"), F.sha2(F.array_join(each, ";"), 256).alias("scans"))


register("d30_scans_by_field", d30d, _SCANS + ", f AS (SELECT field, receiver, string_agg(scan::VARCHAR, ',' ORDER BY scan) AS l FROM (SELECT DISTINCT field, receiver, scan FROM n) GROUP BY 1, 2) SELECT field, count(*) AS receivers, sha256(string_agg(receiver::VARCHAR || ':' || l, ';' ORDER BY receiver)) AS scans FROM f GROUP BY 1")


def d30e(spark: SparkSession, sf: str) -> DataFrame:
    """Times by scan and window, counted and summed by receiver and window."""
    t = md.times_by_scan(_scanned(spark, sf), ["receiver"], "start", "spw")
    return t.groupBy("receiver", "spw").agg(F.count("*").alias("times"), F.sum(F.col("start") * F.col("scan")).alias("weighted"))


register("d30_times_by_scan", d30e, _SCANS + " SELECT receiver, spw, count(*) AS times, sum(s * scan)::BIGINT AS weighted FROM (SELECT DISTINCT receiver, scan, spw, s FROM n) GROUP BY 1, 2")


def d30f(spark: SparkSession, sf: str) -> DataFrame:
    w = md.spectral_windows(_observed(spark, sf), "spw", (F.col("spw") + 1) * 4e8 + F.col("chan") * 25e6 + 12.5e6, "field")
    return w.select("spw", r6(F.col("mean_hz"), 3).alias("mean_hz"), "channels", F.array_join(F.col("fields").cast("array<string>"), ",").alias("fields"))


register("d30_spectral_windows", d30f, _OBSERVED + " SELECT spw, round(avg(DISTINCT (spw + 1) * 4e8 + chan * 25e6 + 12.5e6), 3) + 0.0 AS mean_hz, count(DISTINCT chan) AS channels, array_to_string(list_sort(list(DISTINCT field)), ',') AS fields FROM o GROUP BY 1")


def _with_auto(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of two antennas or of one with itself."""
    a = [(F.col(c) % 40).cast("int") for c in ("l_suppkey", "l_partkey")]
    return fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("frame_id"), F.least(*a).alias("ant1"), F.greatest(*a).alias("ant2"), (F.col("l_quantity") > 20).alias("flag"))


_AUTO = "WITH a AS (SELECT l_orderkey AS frame_id, least(l_suppkey % 40, l_partkey % 40)::INT AS ant1, greatest(l_suppkey % 40, l_partkey % 40)::INT AS ant2, l_quantity > 20 AS flag FROM lineitem)"


def d30g(spark: SparkSession, sf: str) -> DataFrame:
    return md.row_counts(_with_auto(spark, sf), ["frame_id", "ant1", "ant2"], F.col("ant1") == F.col("ant2"), "flag")


register("d30_rows", d30g, _AUTO + ", r AS (SELECT frame_id, ant1, ant2, bool_and(flag) AS bad FROM a GROUP BY 1, 2, 3) SELECT count(*) AS rows, count(*) FILTER (ant1 <> ant2) AS cross, count(*) FILTER (NOT bad) AS good, count(*) FILTER (NOT bad AND ant1 <> ant2) AS cross_good FROM r")


def d30h(spark: SparkSession, sf: str) -> DataFrame:
    m = md.baseline_matrix(_with_auto(spark, sf))
    return m.select("ant1", F.array_join(F.col("partners").cast("array<string>"), ",").alias("partners"))


register("d30_baselines", d30h, _AUTO + " SELECT ant1, string_agg(ant2::VARCHAR, ',' ORDER BY ant2) AS partners FROM (SELECT ant1, ant2 FROM a UNION SELECT ant2, ant1 FROM a) GROUP BY 1")


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return fx.visu(spark, sf).withColumn("flag", F.col("re") * F.col("re") + F.col("im") * F.col("im") > 500)


_FLAGGED = "WITH fv AS (SELECT *, re * re + im * im > 500 AS flag FROM visu)"


def d01(spark: SparkSession, sf: str) -> DataFrame:
    amp = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    v = fx.vis(spark, sf).withColumn("flag", fl.flag_range(amp, 3.0, 22.0, outside=True, zeros=True))
    return v.groupBy("chan").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


register("d01_clip", d01, fx.with_views("SELECT chan, count(*) FILTER (a < 3 OR a > 22 OR a = 0) AS flagged, count(*) AS n FROM (SELECT chan, sqrt(re * re + im * im) AS a FROM vis) GROUP BY 1", "vis"))


def d01b(spark: SparkSession, sf: str) -> DataFrame:
    """Clipped after an average over four channels."""
    v = fl.clip_averaged(fx.visu(spark, sf), ["frame_id", "bl"], 4, 3.0, 22.0)
    return v.groupBy("chan").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


register("d01_clip_averaged", d01b, fx.with_views("SELECT chan, count(*) FILTER (NOT sqrt(r * r + i * i) BETWEEN 3 AND 22) AS flagged, count(*) AS n FROM (SELECT chan, avg(re) OVER w AS r, avg(im) OVER w AS i FROM visu WINDOW w AS (PARTITION BY frame_id, bl, chan // 4)) GROUP BY 1", "visu"))


def d02(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf).withColumn("flag", F.col("re") < -20)
    v = v.withColumn("flag", fl.flag_where(F.col("flag"), (F.col("ant1") == 3) | (F.col("chan").between(4, 6) & (F.col("scan") == "A"))))
    v = v.withColumn("flag", fl.flag_where(F.col("flag"), F.col("ant2") == 17, apply=False))
    return v.groupBy("ant1").agg(F.count_if("flag").alias("flagged"))


register("d02_manual_flags", d02, fx.with_views("SELECT ant1, count(*) FILTER (ant2 <> 17 AND (re < -20 OR ant1 = 3 OR (chan BETWEEN 4 AND 6 AND scan = 'A'))) AS flagged FROM vis GROUP BY 1", "vis"))


def d03(spark: SparkSession, sf: str) -> DataFrame:
    v = fl.quack(fx.vis(spark, sf), 40 * 86400.0, ["scan", "ant1"], "obs_ts")
    return v.groupBy("scan", "ant1").agg(F.count_if("flag").alias("flagged"))


register("d03_quack", d03, fx.with_views("SELECT scan, ant1, count(*) FILTER (epoch_us(obs_ts::TIMESTAMP) < epoch_us(t0::TIMESTAMP) + 40 * 86400 * 1000000::BIGINT) AS flagged FROM (SELECT *, min(obs_ts) OVER (PARTITION BY scan, ant1) AS t0 FROM vis) GROUP BY 1, 2", "vis"))


def d04(spark: SparkSession, sf: str) -> DataFrame:
    """Elevation from hour angle and declination at the array's latitude."""
    h, d, lat = F.radians(F.col("chan") * 15.0 - 120), F.radians(F.lit(12.0)), F.radians(F.lit(42.2118))
    alt = F.degrees(F.asin(F.sin(lat) * F.sin(d) + F.cos(lat) * F.cos(d) * F.cos(h)))
    return fl.flag_elevation(fx.vis(spark, sf), alt, 10.0, 55.0).groupBy("chan").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


register("d04_elevation", d04, fx.with_views("SELECT chan, count(*) FILTER (NOT alt BETWEEN 10 AND 55) AS flagged, count(*) AS n FROM (SELECT chan, degrees(asin(sin(radians(42.2118)) * sin(radians(12.0)) + cos(radians(42.2118)) * cos(radians(12.0)) * cos(radians(chan * 15.0 - 120)))) AS alt FROM vis) GROUP BY 1", "vis"))


def d05(spark: SparkSession, sf: str) -> DataFrame:
    """Full groups, neighbours in channel, then across baselines of a frame's channel."""
    v = fl.extend_groups(_flagged(spark, sf), ["frame_id", "ant1"], 50.0)
    return fl.grow(v, ["frame_id", "bl"], "chan").groupBy("chan").agg(F.count_if("flag").alias("flagged"))


register("d05_extend", d05, fx.with_views(_FLAGGED + ", e AS (SELECT *, flag OR avg(flag::INT) OVER (PARTITION BY frame_id, ant1) * 100 > 50 AS f2 FROM fv) SELECT chan, count(*) FILTER (f3) AS flagged FROM (SELECT chan, f2 OR coalesce(lag(f2) OVER w, false) OR coalesce(lead(f2) OVER w, false) AS f3 FROM e WINDOW w AS (PARTITION BY frame_id, bl ORDER BY chan)) GROUP BY 1", "visu"))


def d05b(spark: SparkSession, sf: str) -> DataFrame:
    return fl.across(_flagged(spark, sf), ["frame_id", "chan"]).groupBy("chan").agg(F.count_if("flag").alias("flagged"))


register("d05_extend_across", d05b, fx.with_views(_FLAGGED + " SELECT chan, count(*) FILTER (f) AS flagged FROM (SELECT chan, bool_or(flag) OVER (PARTITION BY frame_id, chan) AS f FROM fv) GROUP BY 1", "visu"))


def d06(spark: SparkSession, sf: str) -> DataFrame:
    v = fl.crop(fx.visu(spark, sf), ["ant1"], "chan", "re", 1.5)
    return v.groupBy("ant1").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


register("d06_crop", d06, fx.with_views("WITH f AS (SELECT ant1, regr_slope(re, chan) AS b, regr_intercept(re, chan) AS a FROM visu GROUP BY 1), r AS (SELECT ant1, re - (a + b * chan) AS r FROM visu JOIN f USING (ant1)), s AS (SELECT ant1, stddev_pop(r) AS s FROM r GROUP BY 1) SELECT ant1, count(*) FILTER (abs(r) > 1.5 * s) AS flagged, count(*) AS n FROM r JOIN s USING (ant1) GROUP BY 1", "visu"))


def d06b(spark: SparkSession, sf: str) -> DataFrame:
    """Parabolas on three pieces of each antenna's channels."""
    v = fl.crop(fx.visu(spark, sf), ["ant1"], "chan", "re", 1.5, order=2, pieces=3)
    return v.groupBy("ant1").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


register("d06_crop_polynomial", d06b)


def d06c(spark: SparkSession, sf: str) -> DataFrame:
    """Each baseline's means by frame held against those of five frames to either side."""
    v = fx.visu(spark, sf).groupBy("bl", "frame_id").agg(F.avg("re").alias("re"))
    return fl.crop_sliding(v, ["bl"], "frame_id", "re", 1.8, 5).groupBy("bl").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


register("d06_crop_sliding", d06c, fx.with_views("WITH m AS (SELECT bl, frame_id, avg(re) AS re FROM visu GROUP BY 1, 2) SELECT bl, count(*) FILTER (abs(re - a) > 1.8 * s) AS flagged, count(*) AS n FROM (SELECT *, avg(re) OVER w AS a, stddev_pop(re) OVER w AS s FROM m WINDOW w AS (PARTITION BY bl ORDER BY frame_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) GROUP BY 1", "visu"))


def d06d(spark: SparkSession, sf: str) -> DataFrame:
    """Samples with interference of three strengths: lines over each antenna's channels and over each channel's frames take turns until nothing is flagged any more."""
    off = F.when(F.col("frame_id") % 97 == 5, 900.0).when(F.col("frame_id") % 61 == 3, 120.0).when(F.col("chan") == 11, 60.0).otherwise(0.0)
    v = fx.visu(spark, sf).withColumn("amp", F.col("re") + off * F.when(F.col("ant1") % 2 == 0, 1.0).otherwise(-1.0) + F.col("chan") * 3.0)
    turns = [fl.Direction(("ant1",), "chan", 1.8), fl.Direction(("ant1", "chan"), "frame_id", 2.2)]
    done = fl.crop_until_stable(v.select("frame_id", "bl", "ant1", "chan", "amp"), turns, "amp")
    return done.groupBy("ant1", "chan").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))


_TURNS = """WITH RECURSIVE x AS (SELECT frame_id, bl, ant1, chan, re + CASE WHEN frame_id % 97 = 5 THEN 900.0 WHEN frame_id % 61 = 3 THEN 120.0 WHEN chan = 11 THEN 60.0 ELSE 0.0 END * CASE WHEN ant1 % 2 = 0 THEN 1.0 ELSE -1.0 END + chan * 3.0 AS amp FROM visu),
r AS (SELECT *, false AS flag, 0 AS turn, 0 AS quiet FROM x UNION ALL
  SELECT frame_id, bl, ant1, chan, amp, flag OR new, turn + 1, CASE WHEN bool_or(new) OVER () THEN 0 ELSE quiet + 1 END FROM (
    SELECT *, NOT flag AND coalesce(rest > cut * 1.4826 * median(CASE WHEN NOT flag THEN rest END) OVER (PARTITION BY g) + 1e-6, false) AS new FROM (
      SELECT *, abs(amp - avg(CASE WHEN NOT flag THEN amp END) OVER (PARTITION BY g) - coalesce(regr_slope(CASE WHEN NOT flag THEN amp END, p) OVER (PARTITION BY g), 0) * (p - avg(CASE WHEN NOT flag THEN p END) OVER (PARTITION BY g))) AS rest FROM (
        SELECT *, CASE WHEN turn % 2 = 0 THEN ant1 * 100 ELSE ant1 * 100 + chan + 1 END AS g, CASE WHEN turn % 2 = 0 THEN chan ELSE frame_id END::DOUBLE AS p, CASE WHEN turn % 2 = 0 THEN 1.8 ELSE 2.2 END AS cut FROM r WHERE quiet < 2))))
SELECT ant1, chan, count(*) FILTER (flag) AS flagged, count(*) AS n FROM r WHERE turn = (SELECT max(turn) FROM r) GROUP BY 1, 2"""
register("d06_crop_turns", d06d, fx.with_views(_TURNS, "visu").replace("WITH vis AS", "WITH RECURSIVE vis AS", 1).replace(",  RECURSIVE x AS", ", x AS", 1))


def d07(spark: SparkSession, sf: str) -> DataFrame:
    return fl.summary(_flagged(spark, sf), [["chan"], ["ant1"], ["ant1", "chan"], []])


register("d07_flag_summary", d07, fx.with_views(_FLAGGED + " SELECT chan, ant1, (count(*) FILTER (flag))::BIGINT AS flagged, count(*) AS total FROM fv GROUP BY GROUPING SETS ((chan), (ant1), (ant1, chan), ())", "visu"))


def d08(spark: SparkSession, sf: str) -> DataFrame:
    """A saved version put back in three ways."""
    now, keys = _flagged(spark, sf), ["frame_id", "bl", "chan"]
    saved = fx.visu(spark, sf).select(*keys, (F.col("re") > 10).alias("flag")).where("chan % 2 = 0")
    parts = [fl.restore(now, saved, keys, how).groupBy(F.lit(how).alias("how")).agg(F.count_if("flag").alias("flagged")) for how in ("replace", "and", "or")]
    return parts[0].union(parts[1]).union(parts[2])


register("d08_flag_versions", d08, fx.with_views(_FLAGGED + ", s AS (SELECT *, CASE WHEN chan % 2 = 0 THEN re > 10 END AS sv FROM fv) SELECT 'replace' AS how, count(*) FILTER (coalesce(sv, flag)) AS flagged FROM s UNION ALL SELECT 'and', count(*) FILTER (flag AND coalesce(sv, false)) FROM s UNION ALL SELECT 'or', count(*) FILTER (flag OR coalesce(sv, false)) FROM s", "visu"))


def d08b(spark: SparkSession, sf: str) -> DataFrame:
    """A life of versions: three saves, one of them merged into another, one deleted; then what is left, put back in three ways."""
    samples = store_table(fx.visu(spark, sf).select("frame_id", "bl", "chan", "re", "im"), "samples")
    banded = lambda flag: samples.select("frame_id", (F.col("frame_id") % 4).cast("int").alias("sub_band"), "bl", "chan", flag.alias("flag"))
    store = FlagVersions(spark, new_dir(spark, "flags"))
    store.save(banded(F.col("re") > 10).where("chan % 2 = 0"), "first", "bright")
    store.save(banded(F.col("im") < 0), "second", "below")
    store.save(banded(F.col("re") < -15).where("chan % 4 = 0"), "first", "bright or dark", merge="or")
    store.save(banded(F.lit(True)), "third", "all")
    store.delete("third")
    now = banded(F.col("re") * F.col("re") + F.col("im") * F.col("im") > 500)
    ways = {f"{how}:{'+'.join(names)}": (how, names) for how in MERGES for names in (("first",), ("first", "second"))}
    counts = store.restore_all(now, ways).groupBy("sub_band", "chan").agg(F.count("*").alias("n"), *(F.count_if(F.col(f"`{w}`")).alias(w) for w in ways))
    one = F.explode(F.array(*(F.struct(F.lit(how).alias("how"), F.lit("+".join(names)).alias("version"), F.col(f"`{w}`").alias("flagged")) for w, (how, names) in ways.items()))).alias("one")
    listed = F.lit("; ".join(f"{n}: {c}" for n, c in store.versions())).alias("listed")
    return counts.select("sub_band", "chan", "n", one).select("one.how", "one.version", "sub_band", "chan", "one.flagged", "n", listed)


register("d08_flag_store", d08b, fx.with_views(_FLAGGED + """, s AS (SELECT *, frame_id % 4 AS sub_band, CASE WHEN chan % 2 = 0 THEN re > 10 OR (chan % 4 = 0 AND re < -15) END AS a, im < 0 AS b FROM fv),
r AS (SELECT *, coalesce(a, flag) AS x1, flag AND coalesce(a, false) AS x2, flag OR coalesce(a, false) AS x3 FROM s),
u AS (SELECT how, version, sub_band, chan, f FROM (SELECT *, unnest([{'how': 'replace', 'version': 'first', 'f': x1}, {'how': 'and', 'version': 'first', 'f': x2}, {'how': 'or', 'version': 'first', 'f': x3}, {'how': 'replace', 'version': 'first+second', 'f': b}, {'how': 'and', 'version': 'first+second', 'f': x2 AND b}, {'how': 'or', 'version': 'first+second', 'f': x3 OR b}], recursive := true) FROM r))
SELECT how, version, sub_band::INT AS sub_band, chan, count(*) FILTER (f) AS flagged, count(*) AS n, 'first: bright or dark; second: below' AS listed FROM u GROUP BY ALL""", "visu"))


def d09(spark: SparkSession, sf: str) -> DataFrame:
    v = vt.select_rows(fx.vis(spark, sf), F.col("ant1").isin(1, 2, 3, 5, 8), F.col("chan").between(2, 12), F.col("obs_ts") >= "1994-01-01", F.abs("re") < 20)
    return v.groupBy("ant1", "scan").agg(F.count("*").alias("n"), F.sum("im").alias("im"))


register("d09_select", d09, fx.with_views("SELECT ant1, scan, count(*) AS n, sum(im) AS im FROM vis WHERE ant1 IN (1, 2, 3, 5, 8) AND chan BETWEEN 2 AND 12 AND obs_ts >= '1994-01-01' AND abs(re) < 20 GROUP BY 1, 2", "vis"))


def d10(spark: SparkSession, sf: str) -> DataFrame:
    return vt.average_channels(fx.visu(spark, sf), ["frame_id", "bl"], 1, 3, 5, 3).select("frame_id", "bl", "out_chan", r6(F.col("re")).alias("re"), r6(F.col("im")).alias("im"))


register("d10_channel_average", d10, fx.with_views("SELECT frame_id, bl, floor((chan - 1) / 5)::INT AS out_chan, round(avg(re), 6) + 0.0 AS re, round(avg(im), 6) + 0.0 AS im FROM visu WHERE chan >= 1 AND (chan - 1) % 5 < 3 AND floor((chan - 1) / 5) < 3 GROUP BY 1, 2, 3", "visu"))


def d11(spark: SparkSession, sf: str) -> DataFrame:
    s = vt.stokes(_banded(spark, sf), ["sub_band", "bl", "chan"])
    return s.select("sub_band", "bl", "chan", *(r6(F.col(c), 5).alias(c) for c in ("i_re", "i_im", "v_re", "v_im")))


register("d11_stokes", d11, fx.with_views("WITH s AS (SELECT sub_band, bl, chan, avg(re) FILTER (pol = 0) AS lr, avg(im) FILTER (pol = 0) AS li, avg(re) FILTER (pol = 1) AS rr, avg(im) FILTER (pol = 1) AS ri FROM visu JOIN frames USING (frame_id) GROUP BY 1, 2, 3) SELECT sub_band, bl, chan, round((rr + lr) / 2, 5) + 0.0 AS i_re, round((ri + li) / 2, 5) + 0.0 AS i_im, round((rr - lr) / 2, 5) + 0.0 AS v_re, round((ri - li) / 2, 5) + 0.0 AS v_im FROM s WHERE lr IS NOT NULL AND rr IS NOT NULL", "visu", "frames"))


def d11b(spark: SparkSession, sf: str) -> DataFrame:
    """All four Stokes values; correlations are dealt by channel, and the way back is taken, too."""
    v = fx.vis(spark, sf).withColumn("pol", F.col("chan") % 4)
    s = vt.stokes(v, ["ant1", "ant2"], linear=True)
    back = vt.circular(s, ["ant1", "ant2"]).groupBy("ant1", "ant2").agg(r6(F.sum(F.col("re") * (F.col("pol") + 1)), 4).alias("back_re"), r6(F.sum(F.col("im") * (F.col("pol") + 1)), 4).alias("back_im"))
    return s.select("ant1", "ant2", *(r6(F.col(c), 5).alias(c) for c in ("i_re", "i_im", "q_re", "q_im", "u_re", "u_im", "v_re", "v_im"))).join(back, ["ant1", "ant2"])


register("d11_stokes_linear", d11b, fx.with_views("WITH s AS (SELECT ant1, ant2, " + ", ".join(f"avg({x}) FILTER (chan % 4 = {k}) AS {x}{k}" for k in range(4) for x in ("re", "im")) + """ FROM vis GROUP BY 1, 2)
SELECT ant1, ant2, round((re1 + re0) / 2, 5) + 0.0 AS i_re, round((im1 + im0) / 2, 5) + 0.0 AS i_im, round((re2 + re3) / 2, 5) + 0.0 AS q_re, round((im2 + im3) / 2, 5) + 0.0 AS q_im, round((im2 - im3) / 2, 5) + 0.0 AS u_re, round((re3 - re2) / 2, 5) + 0.0 AS u_im, round((re1 - re0) / 2, 5) + 0.0 AS v_re, round((im1 - im0) / 2, 5) + 0.0 AS v_im,
round(re0 + 2 * re1 + 3 * re2 + 4 * re3, 4) + 0.0 AS back_re, round(im0 + 2 * im1 + 3 * im2 + 4 * im3, 4) + 0.0 AS back_im FROM s WHERE re0 IS NOT NULL AND re1 IS NOT NULL AND re2 IS NOT NULL AND re3 IS NOT NULL""", "vis"))


def d12(spark: SparkSession, sf: str) -> DataFrame:
    s = vt.statistics(fx.vis(spark, sf).withColumn("amp2", F.col("re") * F.col("re") + F.col("im") * F.col("im")), ["scan", "chan"], "amp2")
    return s.select("scan", "chan", "n", "low", "high", "total", *(r6(F.col(c), 3).alias(c) for c in ("mean", "std", "var", "median", "rms", "q1", "q3")))


register("d12_statistics", d12, fx.with_views("SELECT scan, chan, count(a) AS n, min(a) AS low, max(a) AS high, sum(a) AS total, round(avg(a), 3) + 0.0 AS mean, round(stddev_samp(a), 3) + 0.0 AS std, round(var_samp(a), 3) + 0.0 AS var, round(median(a), 3) + 0.0 AS median, round(sqrt(avg(a * a)), 3) + 0.0 AS rms, round(quantile_cont(a, 0.25), 3) + 0.0 AS q1, round(quantile_cont(a, 0.75), 3) + 0.0 AS q3 FROM (SELECT *, re * re + im * im AS a FROM vis) GROUP BY 1, 2", "vis"))


def d12b(spark: SparkSession, sf: str) -> DataFrame:
    """Without flagged rows, under a selection."""
    v = _flagged(spark, sf).withColumn("amp2", F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    s = vt.statistics(v, ["chan"], "amp2", where=F.col("ant1") < 20, flag="flag")
    return s.select("chan", "n", *(r6(F.col(c), 3).alias(c) for c in ("low", "high", "total", "mean", "std", "median", "rms", "q1", "q3")))


register("d12_statistics_unflagged", d12b, fx.with_views(_FLAGGED + " SELECT chan, count(a) AS n, " + ", ".join(f"round({x}, 3) + 0.0 AS {n}" for n, x in {"low": "min(a)", "high": "max(a)", "total": "sum(a)", "mean": "avg(a)", "std": "stddev_samp(a)", "median": "median(a)", "rms": "sqrt(avg(a * a))", "q1": "quantile_cont(a, 0.25)", "q3": "quantile_cont(a, 0.75)"}.items()) + " FROM (SELECT *, re * re + im * im AS a FROM fv WHERE ant1 < 20 AND NOT flag) GROUP BY 1", "visu"))


def d13(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf)
    ifr = F.col("ant1") * 1000 + F.col("ant2")
    return v.groupBy("scan").agg(F.min("re").alias("re_low"), F.max("re").alias("re_high"), F.array_join(F.sort_array(F.collect_set("chan")), " ").alias("chans"), F.min(ifr).cast("long").alias("ifr_low"), F.count_distinct(ifr).alias("ifrs"))


register("d13_ranges", d13, fx.with_views("SELECT scan, min(re) AS re_low, max(re) AS re_high, array_to_string(list_sort(list(DISTINCT chan)), ' ') AS chans, min(ant1 * 1000 + ant2)::BIGINT AS ifr_low, count(DISTINCT ant1 * 1000 + ant2) AS ifrs FROM vis GROUP BY 1", "vis"))


def d14(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf).withColumn("weight", F.col("chan") + 1.0)
    return vt.split_time(v, 30 * 86400.0, ["scan", "ant1"], "weight").select("bin", "scan", "ant1", r6(F.col("re"), 5).alias("re"), r6(F.col("im"), 5).alias("im"), "weight")


register("d14_split_time", d14, fx.with_views("SELECT floor(epoch_us(obs_ts::TIMESTAMP) / (30 * 86400.0 * 1e6))::BIGINT AS bin, scan, ant1, round(sum(re * (chan + 1.0)) / sum(chan + 1.0), 5) + 0.0 AS re, round(sum(im * (chan + 1.0)) / sum(chan + 1.0), 5) + 0.0 AS im, sum(chan + 1.0)::DOUBLE AS weight FROM vis GROUP BY 1, 2, 3", "vis"))


def d14b(spark: SparkSession, sf: str) -> DataFrame:
    """Four channels into one, over all scans."""
    v = fx.vis(spark, sf).withColumn("weight", F.col("chan") + 1.0)
    return vt.split_time(v, 30 * 86400.0, ["scan", "ant1"], "weight", step=4, combine=["scan"]).select("bin", "scan", "ant1", "out_chan", r6(F.col("re"), 5).alias("re"), r6(F.col("im"), 5).alias("im"), "weight")


register("d14_split_channels", d14b, fx.with_views("SELECT floor(epoch_us(obs_ts::TIMESTAMP) / (30 * 86400.0 * 1e6))::BIGINT AS bin, min(scan) AS scan, ant1, (chan // 4)::INT AS out_chan, round(sum(re * (chan + 1.0)) / sum(chan + 1.0), 5) + 0.0 AS re, round(sum(im * (chan + 1.0)) / sum(chan + 1.0), 5) + 0.0 AS im, sum(chan + 1.0)::DOUBLE AS weight FROM vis GROUP BY 1, 3, 4", "vis"))


def d15(spark: SparkSession, sf: str) -> DataFrame:
    v = vt.weights_from_scatter(fx.vis(spark, sf), ["ant1", "ant2", "scan"], 20)
    return v.groupBy("ant1", "scan").agg(r6(F.sum("weight"), 5).alias("weight"), F.count_if("flag").alias("flagged"))


register("d15_scatter_weights", d15, fx.with_views("WITH s AS (SELECT ant1, ant2, scan, (var_samp(re) + var_samp(im)) / 2 AS v, count(*) AS n FROM vis GROUP BY 1, 2, 3) SELECT ant1, scan, round(sum(CASE WHEN n >= 20 AND v > 0 THEN n / v END), 5) + 0.0 AS weight, coalesce(sum(n) FILTER (NOT coalesce(n >= 20 AND v > 0, false)), 0)::BIGINT AS flagged FROM s GROUP BY 1, 2", "vis"))


def d15b(spark: SparkSession, sf: str) -> DataFrame:
    """By antenna in bins of half a year, as rms about 0."""
    v = vt.weights_from_scatter(fx.vis(spark, sf), ["ant1"], 20, seconds=183 * 86400.0, rms=True)
    return v.groupBy("ant1").agg(r6(F.sum("weight"), 4).alias("weight"), F.count_if("flag").alias("flagged"))


register("d15_scatter_bins", d15b, fx.with_views("WITH s AS (SELECT ant1, floor(epoch_us(obs_ts::TIMESTAMP) / (183 * 86400.0 * 1e6)) AS b, (avg(re * re) + avg(im * im)) / 2 AS v, count(*) AS n FROM vis GROUP BY 1, 2) SELECT ant1, round(sum(CASE WHEN n >= 20 AND v > 0 THEN n / v END), 4) + 0.0 AS weight, coalesce(sum(n) FILTER (NOT coalesce(n >= 20 AND v > 0, false)), 0)::BIGINT AS flagged FROM s GROUP BY 1", "vis"))


def d16(spark: SparkSession, sf: str) -> DataFrame:
    v = vt.subtract_continuum(fx.vis(spark, sf), ["ant1", "ant2"], (F.col("chan") < 5) | (F.col("chan") > 10))
    return v.groupBy("ant1", "chan").agg(r6(F.sum("re"), 3).alias("re"), r6(F.sum("im"), 3).alias("im"))


register("d16_continuum", d16, fx.with_views("WITH f AS (SELECT ant1, ant2, regr_slope(re, chan) AS br, regr_intercept(re, chan) AS ar, regr_slope(im, chan) AS bi, regr_intercept(im, chan) AS ai FROM vis WHERE chan < 5 OR chan > 10 GROUP BY 1, 2) SELECT ant1, chan, round(sum(re - coalesce(ar, 0) - coalesce(br, 0) * chan), 3) + 0.0 AS re, round(sum(im - coalesce(ai, 0) - coalesce(bi, 0) * chan), 3) + 0.0 AS im FROM vis LEFT JOIN f USING (ant1, ant2) GROUP BY 1, 2", "vis"))


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    """Means by baseline and channel, which leave few holes."""
    v = fx.vis(spark, sf).groupBy("ant1", "ant2", "chan").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    return v.withColumn("flag", F.abs("re") > 15)


_DENSE = "WITH dn AS (SELECT *, abs(re) > 15 AS flag FROM (SELECT ant1, ant2, chan, avg(re) AS re, avg(im) AS im FROM vis GROUP BY 1, 2, 3))"


def d16b(spark: SparkSession, sf: str) -> DataFrame:
    """Order 0: less the mean of the line-free channels."""
    v = vt.subtract_continuum(fx.vis(spark, sf), ["ant1", "ant2"], (F.col("chan") < 5) | (F.col("chan") > 10), order=0)
    return v.groupBy("ant1", "chan").agg(r6(F.sum("re"), 3).alias("re"), r6(F.sum("im"), 3).alias("im"))


register("d16_continuum_mean", d16b, fx.with_views("WITH f AS (SELECT ant1, ant2, avg(re) AS ar, avg(im) AS ai FROM vis WHERE chan < 5 OR chan > 10 GROUP BY 1, 2) SELECT ant1, chan, round(sum(re - coalesce(ar, 0)), 3) + 0.0 AS re, round(sum(im - coalesce(ai, 0)), 3) + 0.0 AS im FROM vis LEFT JOIN f USING (ant1, ant2) GROUP BY 1, 2", "vis"))


def d17(spark: SparkSession, sf: str) -> DataFrame:
    return vt.hanning(_dense(spark, sf), ["ant1", "ant2"]).select("ant1", "ant2", "chan", r6(F.col("re"), 5).alias("re"), r6(F.col("im"), 5).alias("im"), "flag")


register("d17_hanning", d17, fx.with_views(_DENSE + ", n AS (SELECT a.*, l.re AS lr, l.im AS li, l.flag AS lf, r.re AS rr, r.im AS ri, r.flag AS rf FROM dn a LEFT JOIN dn l ON l.ant1 = a.ant1 AND l.ant2 = a.ant2 AND l.chan = a.chan - 1 LEFT JOIN dn r ON r.ant1 = a.ant1 AND r.ant2 = a.ant2 AND r.chan = a.chan + 1) SELECT ant1, ant2, chan, round(lr / 4 + re / 2 + rr / 4, 5) + 0.0 AS re, round(li / 4 + im / 2 + ri / 4, 5) + 0.0 AS im, flag OR coalesce(lf, true) OR coalesce(rf, true) AS flag FROM n", "vis"))


def d18(spark: SparkSession, sf: str) -> DataFrame:
    model = _dense(spark, sf).where("chan < 12").select("ant1", "ant2", "chan", "re", "im")
    v = vt.subtract_model(fx.vis(spark, sf), model, ["ant1", "ant2", "chan"])
    return v.groupBy("chan", "scan").agg(r6(F.sum("re"), 4).alias("re"), r6(F.sum("im"), 4).alias("im"))


register("d18_subtract_model", d18, fx.with_views(_DENSE + " SELECT chan, scan, round(sum(v.re - coalesce(m.re, 0)), 4) + 0.0 AS re, round(sum(v.im - coalesce(m.im, 0)), 4) + 0.0 AS im FROM vis v LEFT JOIN (SELECT * FROM dn WHERE chan < 12) m USING (ant1, ant2, chan) GROUP BY 1, 2", "vis"))


def d19(spark: SparkSession, sf: str) -> DataFrame:
    return fx.frames(spark, sf).orderBy(F.desc("t_us"), "pol").select("frame_id", "t_us", "pol")


register("d19_sort", d19, fx.with_views("SELECT frame_id, t_us, pol FROM frames ORDER BY t_us DESC, pol", "frames"))


def d20(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda s: fx.vis(spark, sf).where(F.col("scan") == s).withColumn("weight", F.lit(1.0))
    both = vt.concatenate([(part("A"), 1.0), (part("N"), 0.5), (part("R"), 0.25)], "weight")
    return both.groupBy("ant1").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))


register("d20_concatenate", d20, fx.with_views("SELECT ant1, sum(CASE scan WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.5 ELSE 0.25 END)::DOUBLE AS weight, count(*) AS n FROM vis GROUP BY 1", "vis"))


def d20b(spark: SparkSession, sf: str) -> DataFrame:
    xy = lambda t, k, m: fx.table(spark, sf, t).select(F.col(k).alias("id"), (F.col(k) * m % 1000 / 10.0).alias("x"), (F.col(k) * 7 * m % 1000 / 10.0).alias("y"))
    return vt.match_fields(xy("supplier", "s_suppkey", 37), xy("customer", "c_custkey", 13), 1.5)


register("d20_match_fields", d20b, "WITH a AS (SELECT s_suppkey AS id, s_suppkey * 37 % 1000 / 10.0 AS x, s_suppkey * 259 % 1000 / 10.0 AS y FROM supplier), b AS (SELECT c_custkey AS id, c_custkey * 13 % 1000 / 10.0 AS x, c_custkey * 91 % 1000 / 10.0 AS y FROM customer) SELECT b.id AS other_id, min(a.id) AS field_id FROM a, b WHERE sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2) <= 1.5 GROUP BY 1")


def d21(spark: SparkSession, sf: str) -> DataFrame:
    return fx.vis(spark, sf).where("chan = 5 AND re > 0").select("ant1", "ant2", "scan").dropDuplicates().orderBy(F.desc("ant1"), "ant2", "scan")


register("d21_table_query", d21, fx.with_views("SELECT DISTINCT ant1, ant2, scan FROM vis WHERE chan = 5 AND re > 0", "vis"))


def d22(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double") * 1000)).alias("a"))
    total = F.aggregate("a", F.lit(0.0), lambda s, x: s + F.abs(x))
    return e.select("vec_id", r6(total / F.size("a"), 4).alias("mean_abs"), F.size(F.filter("a", lambda x: x > 100)).cast("long").alias("n_true"), F.array_max("a").alias("top"))


register("d22_column_calculation", d22, "SELECT vec_id, round(list_avg(list_transform(a, lambda x: abs(x))), 4) + 0.0 AS mean_abs, len(list_filter(a, lambda x: x > 100))::BIGINT AS n_true, list_max(a) AS top FROM (SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE * 1000)) AS a FROM embeddings)")


def d23(spark: SparkSession, sf: str) -> DataFrame:
    return vt.cube(fx.vis(spark, sf), list(range(16)), "chan", "re").select("ant1", "ant2", *(r6(F.col(str(k)), 5).alias(f"t{k}") for k in range(16)))


register("d23_cube", d23, fx.with_views("SELECT ant1, ant2, " + ", ".join(f"round(coalesce(avg(re) FILTER (chan = {k}), 0), 5) + 0.0 AS t{k}" for k in range(16)) + " FROM vis GROUP BY 1, 2", "vis"))


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    return fx.vis(spark, sf).withColumn("week", F.floor(F.unix_seconds(F.col("obs_ts").cast("timestamp")) / 604800)).where("ant1 % 7 <> week % 5")


def d23b(spark: SparkSession, sf: str) -> DataFrame:
    """The cube of all pairs and weeks, summed by pair with weights of the week, and averaged over time."""
    cube = TimeCube(_weekly(spark, sf), "week", "re", default=-1.0, width=100)
    c = cube.cells().groupBy("ant1", "ant2").agg(F.count("*").alias("times"), F.count_if(~F.col("known")).alias("missing"), r6(F.sum(F.col("value") * (F.col("week") % 11)), 4).alias("weighted"))
    return c.join(cube.time_average(), ["ant1", "ant2"]).select("ant1", "ant2", "times", "missing", "weighted", "n", r6(F.col("mean"), 5).alias("mean"))


register("d23_time_cube", d23b, fx.with_views("""WITH w AS (SELECT *, floor(epoch(obs_ts::TIMESTAMP) / 604800)::BIGINT AS week FROM vis), u AS (SELECT ant1, ant2, week, avg(re) AS re FROM w WHERE ant1 % 7 <> week % 5 GROUP BY 1, 2, 3),
g AS (SELECT p.ant1, p.ant2, t.week, u.re FROM (SELECT DISTINCT ant1, ant2 FROM u) p CROSS JOIN (SELECT DISTINCT week FROM u) t LEFT JOIN u ON u.ant1 = p.ant1 AND u.ant2 = p.ant2 AND u.week = t.week)
SELECT ant1, ant2, count(*) AS times, count(*) FILTER (re IS NULL) AS missing, round(sum(coalesce(re, -1.0) * (week % 11)), 4) + 0.0 AS weighted, count(re) AS n, round(avg(re), 5) + 0.0 AS mean FROM g GROUP BY 1, 2""", "vis"))


def d24(spark: SparkSession, sf: str) -> DataFrame:
    c = cu.collapse(fx.pixels(spark, sf), ["x", "label"])
    return c.select("x", "label", "max", "min", "sum", *(r6(F.col(k), 3).alias(k) for k in ("mean", "median", "rms", "stdev", "variance")))


register("d24_collapse", d24, fx.with_views("SELECT x, label, max(value) AS max, min(value) AS min, sum(value) AS sum, round(avg(value), 3) + 0.0 AS mean, round(median(value), 3) + 0.0 AS median, round(sqrt(avg(value * value)), 3) + 0.0 AS rms, round(stddev_samp(value), 3) + 0.0 AS stdev, round(var_samp(value), 3) + 0.0 AS variance FROM pixels GROUP BY 1, 2", "pixels"))


def d25(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.pixels(spark, sf).withColumn("value", F.abs("value") + 1)
    m = cu.spectral_moments(p, "image_key")
    return m.select("x", "y", "max", "max_at", "min", "min_at", *(r6(F.col(k), 3).alias(k) for k in ("mean", "integrated", "coordinate", "dispersion", "median", "std", "rms", "absdev")))


register("d25_spectral_moments", d25, fx.with_views("""WITH p AS (SELECT image_key AS c, x, y, abs(value) + 1 AS v FROM pixels), m AS (SELECT x, y, max(v) AS max, min(v) AS min, avg(v) AS mean, sum(v) AS s, sum(v * c) / sum(v) AS coo, sum(v * c * c) AS s2, median(v) AS med, stddev_samp(v) AS std, sqrt(avg(v * v)) AS rms FROM p GROUP BY 1, 2)
SELECT m.x, m.y, max, (SELECT min(c) FROM p WHERE p.x = m.x AND p.y = m.y AND p.v = m.max) AS max_at, min, (SELECT min(c) FROM p WHERE p.x = m.x AND p.y = m.y AND p.v = m.min) AS min_at, round(mean, 3) + 0.0 AS mean, round(s, 3) + 0.0 AS integrated, round(coo, 3) + 0.0 AS coordinate, round(sqrt(abs(s2 / s - coo ^ 2)), 3) + 0.0 AS dispersion, round(med, 3) + 0.0 AS median, round(std, 3) + 0.0 AS std, round(rms, 3) + 0.0 AS rms, (SELECT round(avg(abs(p.v - m.mean)), 3) + 0.0 FROM p WHERE p.x = m.x AND p.y = m.y) AS absdev FROM m""", "pixels"))


def d26(spark: SparkSession, sf: str) -> DataFrame:
    p = cu.boxcar(fx.pixels(spark, sf), "x", ["image_key", "y"], 3)
    return cu.rebin(cu.hanning_axis(p, "y", ["image_key", "x"]), 2, 2).select("image_key", "x", "y", r6(F.col("value"), 7).alias("value"))


register("d26_smooth_rebin", d26, fx.with_views("WITH b AS (SELECT image_key, x, y, avg(value) OVER (PARTITION BY image_key, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM pixels), h AS (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS c FROM b WINDOW w AS (PARTITION BY image_key, x ORDER BY y)) SELECT image_key, floor(x / 2)::INT AS x, floor(y / 2)::INT AS y, round(avg(CASE WHEN a IS NOT NULL AND c IS NOT NULL THEN a / 4 + v / 2 + c / 4 ELSE v END), 7) + 0.0 AS value FROM h GROUP BY 1, 2, 3", "pixels"))


def d27(spark: SparkSession, sf: str) -> DataFrame:
    return cu.plane_histogram(fx.pixels(spark, sf), 20, -200.0, 200.0)


register("d27_plane_histogram", d27, fx.with_views("SELECT image_key, bin, n, (sum(n) OVER (PARTITION BY image_key ORDER BY bin))::BIGINT AS cumulative, log10(n) AS log_n FROM (SELECT image_key, least(greatest(floor((value + 200.0) * 20 / 400.0), -1), 20)::INT AS bin, count(*) AS n FROM pixels GROUP BY 1, 2)", "pixels"))


def d28(spark: SparkSession, sf: str) -> DataFrame:
    return cu.structure_function(fx.pixels(spark, sf), 2).select("image_key", "dx", "dy", r6(F.col("s"), 3).alias("s"), "n")


register("d28_structure_function", d28, fx.with_views("SELECT a.image_key, (b.x - a.x)::INT AS dx, (b.y - a.y)::INT AS dy, round(avg((b.value - a.value) ^ 2), 3) + 0.0 AS s, count(*) AS n FROM pixels a JOIN pixels b ON a.image_key = b.image_key AND b.x - a.x BETWEEN 0 AND 2 AND b.y - a.y BETWEEN 0 AND 2 AND (b.x <> a.x OR b.y <> a.y) GROUP BY 1, 2, 3", "pixels"))


def d28b(spark: SparkSession, sf: str) -> DataFrame:
    return cu.structure_all_lags(fx.pixels(spark, sf), 8).select("image_key", "dx", "dy", F.round(F.col("s") * F.col("n")).alias("total"), "n")


register("d28_structure_all_lags", d28b, fx.with_views("SELECT a.image_key, (b.x - a.x)::INT AS dx, (b.y - a.y)::INT AS dy, round(sum((b.value - a.value) ^ 2)) + 0.0 AS total, count(*) AS n FROM pixels a JOIN pixels b ON a.image_key = b.image_key AND (b.y > a.y OR (b.y = a.y AND b.x > a.x)) GROUP BY 1, 2, 3", "pixels").replace("pixels AS (", "pixels AS MATERIALIZED (", 1))


def d29(spark: SparkSession, sf: str) -> DataFrame:
    return cu.find_sources(fx.pixels(spark, sf), 0.4, 5)


register("d29_find_sources", d29, fx.with_views("WITH t AS (SELECT a.image_key, a.x, a.y, a.value FROM pixels a WHERE a.value >= (SELECT max(b.value) FROM pixels b WHERE b.image_key = a.image_key AND abs(b.x - a.x) <= 1 AND abs(b.y - a.y) <= 1 AND (b.x <> a.x OR b.y <> a.y)) AND a.value >= 0.4 * (SELECT max(c.value) FROM pixels c WHERE c.image_key = a.image_key)) SELECT image_key, k::INT AS k, x, y, value FROM (SELECT *, row_number() OVER (PARTITION BY image_key ORDER BY value DESC, y, x) AS k FROM t) WHERE k <= 5", "pixels"))


def d30(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, baselines and span of each scan and antenna, with subtotals."""
    v = fx.vis(spark, sf)
    return v.rollup("scan", "ant1").agg(F.count("*").alias("n"), F.count_distinct("ant2").alias("partners"), F.count_distinct("chan").alias("chans"), F.sum("re").alias("re"))


register("d30_summary", d30, fx.with_views("SELECT scan, ant1, count(*) AS n, count(DISTINCT ant2) AS partners, count(DISTINCT chan) AS chans, sum(re) AS re FROM vis GROUP BY ROLLUP (scan, ant1)", "vis"))


def _uv(spark: SparkSession, sf: str) -> DataFrame:
    """Samples in wavelengths, an image a channel."""
    b = fx.baselines(spark, sf).select("bl", "be", "bn")
    scale = (F.col("chan") * 25e6 + 4e8) / SPEED
    v = fx.vis(spark, sf).withColumn("bl", baseline_index(F.col("ant1"), F.col("ant2"), 40)).groupBy("bl", "chan").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    return v.join(F.broadcast(b), "bl").select(F.col("chan").alias("image_key"), (F.col("be") * scale).alias("u"), (F.col("bn") * scale).alias("v"), "re", "im")


_UV = f"WITH uv AS (SELECT chan AS image_key, be * ((chan * 25e6 + 4e8) / {SPEED}) AS u, bn * ((chan * 25e6 + 4e8) / {SPEED}) AS v, re, im FROM (SELECT CAST(ant1 * 40 - floor(ant1 * (ant1 + 1) / 2) + (ant2 - ant1 - 1) AS INT) AS bl, chan, avg(re) AS re, avg(im) AS im FROM vis GROUP BY 1, 2) JOIN baselines USING (bl))"
_GRID = """, s AS (SELECT image_key, abs(u) / 20.0 AS gu, CASE WHEN u < 0 THEN -v ELSE v END / 20.0 AS gv, re, CASE WHEN u < 0 THEN -im ELSE im END AS im FROM uv),
b AS (SELECT * FROM s UNION ALL SELECT image_key, -gu, -gv, re, -im FROM s WHERE gu < 3), o AS (SELECT range - 3 AS o FROM range(8)),
c AS (SELECT image_key, floor(gu) + o1.o AS iu, floor(gv) + o2.o AS iv, gu, gv, re, im FROM b, o o1, o o2 WHERE floor(gu) + o1.o >= 0),
w AS (SELECT *, {k}[du::INT + 1] * {k}[dv::INT + 1] AS w FROM (SELECT *, trunc(abs(iu - gu)) AS du, trunc(abs(iv - gv)) AS dv FROM c) WHERE du < 3 AND dv < 3),
g AS (SELECT image_key, iu::BIGINT AS iu, iv::BIGINT AS iv, sum(w * re) AS re, sum(w * im) AS im, sum(w) AS beam, count(*) AS n FROM w GROUP BY 1, 2, 3)""".replace("{k}", "([" + ", ".join(map(repr, im.KERNEL)) + "]::DOUBLE[])")


def a06(spark: SparkSession, sf: str) -> DataFrame:
    return im.grid(_uv(spark, sf), 20.0).select("image_key", "iu", "iv", r6(F.col("re"), 4).alias("re"), r6(F.col("im"), 4).alias("im"), r6(F.col("beam"), 4).alias("beam"), "n")


register("a06_uv_grid", a06, fx.with_views(_UV + _GRID + " SELECT image_key, iu, iv, round(re, 4) + 0.0 AS re, round(im, 4) + 0.0 AS im, round(beam, 4) + 0.0 AS beam, n FROM g", "vis", "baselines"))


def a07(spark: SparkSession, sf: str) -> DataFrame:
    return im.weigh(im.grid(_uv(spark, sf), 20.0), uniform=True).groupBy("image_key").agg(r6(F.sum("re"), 2).alias("re"), r6(F.sum("beam"), 2).alias("beam"))


register("a07_weighting", a07, fx.with_views(_UV + _GRID + " SELECT image_key, round(sum(re / n), 2) + 0.0 AS re, round(sum(beam / n), 2) + 0.0 AS beam FROM g GROUP BY 1", "vis", "baselines"))


def a08(spark: SparkSession, sf: str) -> DataFrame:
    return im.histogram(fx.pixels(spark, sf), 200)


register("a08_histogram", a08, fx.with_views("WITH s AS (SELECT image_key, floor(min(value)) AS lo, ceil(max(value)) AS hi FROM pixels GROUP BY 1) SELECT image_key, CASE WHEN hi > lo THEN floor((value - lo) * 199 / (hi - lo)) ELSE 0 END::INT AS bin, count(*) AS n FROM pixels JOIN s USING (image_key) GROUP BY 1, 2", "pixels"))


def a09(spark: SparkSession, sf: str) -> DataFrame:
    return im.extrema(fx.pixels(spark, sf))


register("a09_extrema", a09, fx.with_views("SELECT image_key, max(value) AS high, min(value) AS low, first(x ORDER BY value DESC, y, x) AS x, first(y ORDER BY value DESC, y, x) AS y FROM pixels GROUP BY 1", "pixels"))


def a10(spark: SparkSession, sf: str) -> DataFrame:
    return im.centroid(fx.pixels(spark, sf).withColumn("value", F.abs("value") + 1)).select("image_key", r6(F.col("cx")).alias("cx"), r6(F.col("cy")).alias("cy"))


register("a10_centroid", a10, fx.with_views("SELECT image_key, round(sum(x * (abs(value) + 1)) / sum(abs(value) + 1), 6) + 0.0 AS cx, round(sum(y * (abs(value) + 1)) / sum(abs(value) + 1), 6) + 0.0 AS cy FROM pixels GROUP BY 1", "pixels"))


def a11(spark: SparkSession, sf: str) -> DataFrame:
    m = im.moments(fx.pixels(spark, sf).withColumn("value", F.abs("value") + 1))
    return m.select("image_key", *(r6(F.col(c), 4).alias(c) for c in ("height", "amplitude", "cx", "cy", "wx", "wy")))


register("a11_moments", a11, fx.with_views("WITH p AS (SELECT image_key, x, y, abs(value) + 1 AS v FROM pixels), c AS (SELECT image_key, median(v) AS h, max(v) AS t, sum(x * v) / sum(v) AS cx, sum(y * v) / sum(v) AS cy FROM p GROUP BY 1) SELECT image_key, round(h, 4) + 0.0 AS height, round(t - h, 4) + 0.0 AS amplitude, round(cx, 4) + 0.0 AS cx, round(cy, 4) + 0.0 AS cy, round(sqrt(sum((x - cx) ^ 2 * v) / sum(v)), 4) + 0.0 AS wx, round(sqrt(sum((y - cy) ^ 2 * v) / sum(v)), 4) + 0.0 AS wy FROM p JOIN c USING (image_key) GROUP BY image_key, h, t, cx, cy", "pixels"))


def a11b(spark: SparkSession, sf: str) -> DataFrame:
    """Peaks of each vector's series."""
    m = im.spectrum_moments(_series(spark, sf), ["image_key"], "i", "value")
    return m.select("image_key", *(away(F.col(c).cast("double"), 4).alias(c) for c in ("height", "amplitude", "centre", "width")))


_SERIES = "WITH se AS (SELECT image_key, y * 8 + x AS i, value FROM pixels)"
register("a11_spectrum_moments", a11b, fx.with_views(_SERIES + """, s AS (SELECT image_key, median(value) AS h, avg(value) AS mu, min(value) AS lo, max(value) AS hi, sum(value) AS t, count(*) AS n, (max(i) - min(i)) / (count(*) - 1) AS dx, first(i ORDER BY value DESC, i) AS at_hi, first(i ORDER BY value, i) AS at_lo FROM se GROUP BY 1),
m AS (SELECT image_key, h, lo, hi, t, n, dx, at_hi, at_lo, stddev_pop(i) FILTER (value > mu) AS sh, stddev_pop(i) FILTER (value < mu) AS sl, sum(CASE WHEN value > h THEN value ELSE 0 END) AS above, sum(CASE WHEN value < h THEN value ELSE 0 END) AS below FROM se JOIN s USING (image_key) GROUP BY ALL)
SELECT image_key, round(h, 4) + 0.0 AS height, round(CASE WHEN sh < sl THEN hi - h ELSE lo - h END, 4) + 0.0 AS amplitude, round(CASE WHEN sh < sl THEN at_hi ELSE at_lo END::DOUBLE, 4) + 0.0 AS centre,
round(0.5 * abs(CASE WHEN sh < sl THEN (t - h * n - below) * dx / (hi - h) ELSE (t - h * n - above) * dx / (lo - h) END), 4) + 0.0 AS width FROM m""", "pixels"))


def a15(spark: SparkSession, sf: str) -> DataFrame:
    return im.stretch(fx.pixels(spark, sf), 0.01).select("image_key", "x", "y", r6(F.col("value"), 5).alias("value"))


register("a15_stretch", a15, fx.with_views("WITH p AS (SELECT image_key, quantile_cont(value, 0.01) AS lo, max(value) AS hi FROM pixels GROUP BY 1) SELECT image_key, x, y, round((greatest(value, lo) - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END, 5) + 0.0 AS value FROM pixels JOIN p USING (image_key)", "pixels"))


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return fx.pixels(spark, sf).select("image_key", (F.col("y") * 8 + F.col("x")).alias("i"), "value")




def w05(spark: SparkSession, sf: str) -> DataFrame:
    once = im.forward_mean(_series(spark, sf), ["image_key"], "i", "value", 8)
    return im.forward_mean(once, ["image_key"], "i", "value", 8).select("image_key", "i", F.col("value").cast("long").alias("value"))


register("w05_forward_mean", w05, fx.with_views(_SERIES + ", a AS (SELECT image_key, i, CASE WHEN count(value) OVER w = 8 THEN floor(avg(value) OVER w) ELSE 0 END AS value FROM se WINDOW w AS (PARTITION BY image_key ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) SELECT image_key, i, CASE WHEN count(value) OVER w = 8 THEN floor(avg(value) OVER w) ELSE 0 END::BIGINT AS value FROM a WINDOW w AS (PARTITION BY image_key ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)", "pixels"))


def w06(spark: SparkSession, sf: str) -> DataFrame:
    return im.peaks(_series(spark, sf), ["image_key"], "i", "value", 0.5)


_PEAKS = _SERIES + ", pk AS (SELECT image_key, i, value FROM (SELECT *, value - lag(value) OVER w AS up, lead(value) OVER w - value AS down, min(value) OVER (PARTITION BY image_key) AS lo, max(value) OVER (PARTITION BY image_key) AS hi FROM se WINDOW w AS (PARTITION BY image_key ORDER BY i)) WHERE up > 0 AND down < 0 AND value > 0.5 * (hi - lo) + lo)"
register("w06_peaks", w06, fx.with_views(_PEAKS + " SELECT * FROM pk", "pixels"))
register("w06_peaks_suppressed", lambda spark, sf: im.suppress(w06(spark, sf), ["image_key"], "i", "value", 6))


def w07(spark: SparkSession, sf: str) -> DataFrame:
    return im.rescale(_series(spark, sf), ["image_key"], "value", 0.0, 255.0).select("image_key", "i", r6(F.col("value"), 4).alias("value"))


register("w07_rescale", w07, fx.with_views(_SERIES + " SELECT image_key, i, round(CASE WHEN hi > lo THEN (value - lo) * 255.0 / (hi - lo) ELSE 0.0 END, 4) + 0.0 AS value FROM (SELECT *, min(value) OVER (PARTITION BY image_key) AS lo, max(value) OVER (PARTITION BY image_key) AS hi FROM se)", "pixels"))


def i02(spark: SparkSession, sf: str) -> DataFrame:
    """Exact brightness on an 8 x 8 list of directions."""
    at = [(k % 8, k // 8, (k % 8 - 4) * 0.0005, (k // 8 - 4) * 0.0005) for k in range(64)]
    return im.direct_map(_uv(spark, sf), at).select("image_key", "x", "y", r6(F.col("value"), 4).alias("value"))


register("i02_direct_map", i02, fx.with_views(_UV + " SELECT image_key, x, y, round(avg(re * cos(2 * pi() * (u * (x - 4) * 0.0005 + v * (y - 4) * 0.0005)) + im * sin(2 * pi() * (u * (x - 4) * 0.0005 + v * (y - 4) * 0.0005))), 4) + 0.0 AS value FROM uv, (SELECT (range % 8)::INT AS x, floor(range / 8)::INT AS y FROM range(64)) GROUP BY 1, 2, 3", "vis", "baselines"))


def i06(spark: SparkSession, sf: str) -> DataFrame:
    """The hybrid of two images of one sky: pixels and their smoothed form stand for the two CLEAN images of i06_hybrid_clean."""
    p = fx.pixels(spark, sf)
    return im.hybrid(p, im.box_smooth(p, 3, 3.0), 3.5, 3.0).select("image_key", "x", "y", r6(F.col("value") * 0.7310585, 4).alias("value"))


register("i06_hybrid", i06, fx.with_views("""WITH r AS (SELECT image_key, x, y, sum(value) OVER (PARTITION BY image_key, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 3.0 AS v FROM pixels), b AS (SELECT image_key, x, y, sum(v) OVER (PARTITION BY image_key, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 3.0 AS v FROM r),
ua AS (SELECT image_key, x, y, (value - lo) / CASE WHEN hi > 0 THEN hi ELSE 1 END AS a, hi AS peak FROM (SELECT *, least(min(value) OVER k, 0) AS lo, max(value) OVER k - least(min(value) OVER k, 0) AS hi FROM pixels WINDOW k AS (PARTITION BY image_key))),
ub AS (SELECT image_key, x, y, (v - lo) / CASE WHEN hi > 0 THEN hi ELSE 1 END AS b FROM (SELECT *, least(min(v) OVER k, 0) AS lo, max(v) OVER k - least(min(v) OVER k, 0) AS hi FROM b WINDOW k AS (PARTITION BY image_key))),
m AS (SELECT image_key, x, y, (x - 3.5) ^ 2 + (y - 3.5) ^ 2 AS far, peak * 0.15::DOUBLE AS back, (a + b) / 2 * peak + CASE WHEN (x - 3.5) ^ 2 + (y - 3.5) ^ 2 <= 9 THEN peak * 0.15::DOUBLE ELSE 0 END AS v FROM ua JOIN ub USING (image_key, x, y))
SELECT image_key, x, y, round(CASE WHEN far > 12.96 THEN 0.0 WHEN far > 9 AND v < 0.9 * back THEN 0.0 ELSE v END * 0.7310585::DOUBLE, 4) + 0.0 AS value FROM m""", "pixels"))


def i08(spark: SparkSession, sf: str) -> DataFrame:
    """Radial brightness by distance; the profile falls linearly to the limb."""
    profile = spark.range(200).select(F.col("id").cast("int").alias("i"), F.greatest(F.lit(0.0), 1 - F.col("id") / 110.0).alias("brightness"))
    return im.radial_model(fx.pixels(spark, sf), profile, 3.5, 4.0).select("image_key", "x", "y", r6(F.col("value"), 5).alias("value"))


register("i08_radial_model", i08, fx.with_views("WITH p AS (SELECT image_key, x, y, sqrt((x - 3.5) ^ 2 + (y - 3.5) ^ 2) / 4.0 * 100 AS r FROM pixels) SELECT image_key, x, y, round(greatest(0.0, 1 - floor(r) / 110.0) + (greatest(0.0, 1 - (floor(r) + 1) / 110.0) - greatest(0.0, 1 - floor(r) / 110.0)) * (r - floor(r)), 5) + 0.0 AS value FROM p", "pixels"))


def i09(spark: SparkSession, sf: str) -> DataFrame:
    return im.rotate_image(fx.pixels(spark, sf), 30.0, 8)


_ROT = "WITH t AS (SELECT image_key, x, y, floor({c}::DOUBLE * (x - 4.0::DOUBLE) - {s}::DOUBLE * (y - 4.0::DOUBLE) + 4.0::DOUBLE)::INT AS sx, floor({s}::DOUBLE * (x - 4.0::DOUBLE) + {c}::DOUBLE * (y - 4.0::DOUBLE) + 4.0::DOUBLE)::INT AS sy FROM pixels) SELECT t.image_key, t.x, t.y, coalesce(p.value, 0.0) AS value FROM t LEFT JOIN pixels p ON p.image_key = t.image_key AND p.x = sx AND p.y = sy"
register("i09_rotate", i09, fx.with_views(_ROT.format(c=repr(0.8660254037844387), s=repr(0.49999999999999994)), "pixels").replace("pixels AS (", "pixels AS MATERIALIZED (", 1))


def i10(spark: SparkSession, sf: str) -> DataFrame:
    return im.shift_image(fx.pixels(spark, sf), 4, 4, 8)


register("i10_quadrant_swap", i10, fx.with_views("SELECT image_key, ((x + 4) % 8)::INT AS x, ((y + 4) % 8)::INT AS y, value FROM pixels", "pixels"))


def i11(spark: SparkSession, sf: str) -> DataFrame:
    return im.add_inside(fx.pixels(spark, sf), 3.5, 2.5, -10.0)


register("i11_disk_mask", i11, fx.with_views("SELECT image_key, label, x, y, CASE WHEN (x - 3.5) ^ 2 + (y - 3.5) ^ 2 <= 6.25 THEN value - 10.0 ELSE value END AS value FROM pixels", "pixels"))


def i12(spark: SparkSession, sf: str) -> DataFrame:
    return im.box_smooth(fx.pixels(spark, sf), 3, 4.0).select("image_key", "x", "y", r6(F.col("value"), 4).alias("value"))


register("i12_box_smooth", i12, fx.with_views("WITH r AS (SELECT image_key, x, y, sum(value) OVER (PARTITION BY image_key, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 4.0 AS v FROM pixels) SELECT image_key, x, y, round(sum(v) OVER (PARTITION BY image_key, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 4.0, 4) + 0.0 AS value FROM r", "pixels"))

#: Radius of the disk that is looked for, in radians.
DISK = 2e-3


def _geometry(pdf) -> tuple[int, float]:
    """Image size and cell in radians of the first array at the samples' frequency, as p09 has them; image_key is the channel where it isn't given."""
    hz = float(pdf["hz"].iloc[0] if "hz" in pdf else pdf["image_key"].iloc[0] * 25e6 + 4e8)
    return 256 if hz < 800e6 else 512 if hz < 1200e6 else 1024, SPEED / hz / 3000.0 / 3


def _image(pdf, uniform: bool = False) -> tuple:
    a = pdf[["u", "v", "re", "im"]].to_numpy()
    return im.dirty_image(a[:, 0], a[:, 1], a[:, 2], a[:, 3], *_geometry(pdf), uniform=uniform)


def i01(spark: SparkSession, sf: str) -> DataFrame:
    return im.as_pixels(im.per_image(_uv(spark, sf), lambda pdf: _image(pdf)[0]))


def i03(spark: SparkSession, sf: str) -> DataFrame:
    return im.as_pixels(im.per_image(_uv(spark, sf), lambda pdf: im.fit_beam(_image(pdf)[1])))


def i04(spark: SparkSession, sf: str) -> DataFrame:
    def clean(pdf):
        image, beam = _image(pdf)
        return im.restore(*im.hogbom(image, beam), im.fit_beam(beam))

    return im.as_pixels(im.per_image(_uv(spark, sf), clean))


def i05(spark: SparkSession, sf: str) -> DataFrame:
    def clean(pdf):
        image, beam = _image(pdf)
        rest, model = im.steer(image, beam)
        return rest + im.convolve(model, im.fit_beam(beam))

    return im.as_pixels(im.per_image(_uv(spark, sf), clean))


def i06b(spark: SparkSession, sf: str) -> DataFrame:
    """Hybrid of both CLEAN images of each channel: points from uniform weights, extended sources from natural ones."""
    uv = _uv(spark, sf)

    def points(pdf):
        image, beam = _image(pdf, uniform=True)
        return im.restore(*im.hogbom(image, beam), im.fit_beam(beam))

    def extended(pdf):
        image, beam = _image(pdf)
        rest, model = im.steer(image, beam)
        return rest + im.convolve(model, im.fit_beam(beam))

    pixels = [im.as_pixels(im.per_image(uv, make)) for make in (points, extended)]
    return im.hybrid(*pixels, 128.0, 60.0)


def i01b(spark: SparkSession, sf: str) -> DataFrame:
    """Places and depths: all CLEAN components of each channel's image, strongest first, as whole pixels and rounded flux."""

    def parts(pdf):
        import numpy as np

        found: dict = {}
        for y, x, flux in im.hogbom(*_image(pdf))[1]:
            found[y, x] = found.get((y, x), 0.0) + flux
        top = sorted(found.items(), key=lambda f: (-abs(f[1]), f[0]))
        return np.array([[k, y, x, round(flux, 4)] for k, ((y, x), flux) in enumerate(top)])

    d = im.per_image(_uv(spark, sf), parts).select("image_key", F.explode(F.sequence(F.lit(0), F.floor(F.size("data") / 4).cast("int") - 1)).alias("k"), "data")
    at = lambda i: F.get("data", F.col("k") * 4 + i)
    return d.select("image_key", "k", at(1).cast("int").alias("y"), at(2).cast("int").alias("x"), F.round(at(3).cast("double"), 4).alias("flux"))


def i07(spark: SparkSession, sf: str) -> DataFrame:
    """Offset of the disk in each dirty image, as two numbers."""
    return im.per_image(_uv(spark, sf), lambda pdf: _offset(pdf)).select("image_key", F.get("data", F.lit(0)).alias("dx"), F.get("data", F.lit(1)).alias("dy"))


def _offset(pdf):
    import numpy as np

    return np.array(im.disk_offset(_image(pdf)[0], DISK / _geometry(pdf)[1]), float)


def i13(spark: SparkSession, sf: str) -> DataFrame:
    """Centres of the two highest points of each image's series, refined."""
    import numpy as np

    def refine(pdf):
        y = np.abs(pdf.sort_values("i")["value"].to_numpy()) + 1
        return np.array(im.refine_peaks(y, np.argsort(-y, kind="stable")[:2].tolist()))

    return im.per_image(_series(spark, sf), refine).select("image_key", F.posexplode("data").alias("k", "centre"))


def i14(spark: SparkSession, sf: str) -> DataFrame:
    """CLEAN images of every band, polarization and channel, of the means over all frames, and their peaks."""
    b = fx.baselines(spark, sf).select("bl", "be", "bn")
    v = _banded(spark, sf).groupBy("sub_band", "pol", "chan", "bl").agg(F.avg("re").alias("re"), F.avg("im").alias("im")).join(F.broadcast(b), "bl")
    hz = (F.col("sub_band") + 1) * 4e8 + F.col("chan") * 25e6
    scale = hz / SPEED
    key = F.concat_ws("-", "sub_band", "pol", "chan").alias("image_key")
    uv = v.select(key, (F.col("be") * scale).alias("u"), (F.col("bn") * scale).alias("v"), "re", "im", hz.alias("hz"))

    def peaks(pdf):
        """As im.extrema has them, of pixels as per_image would give them: 128 images of up to 1024 x 1024 stay in their tasks."""
        import numpy as np

        image, beam = _image(pdf)
        pixels = im.restore(*im.hogbom(image, beam), im.fit_beam(beam)).astype(np.float32)
        y, x = np.unravel_index(int(pixels.argmax()), pixels.shape)
        return np.array([pixels[y, x], pixels.min(), x, y], np.float32)

    d = [F.get("data", F.lit(k)) for k in range(4)]
    return im.per_image(uv, peaks).select("image_key", d[0].cast("double").alias("high"), d[1].cast("double").alias("low"), d[2].cast("int").alias("x"), d[3].cast("int").alias("y"))


#: Bands of the second array whose images have 1280, 2560 and 5120 pixels a side, and its antennas.
_WIDE, _ANTS = (0, 5, 15), 60
#: Places of pixels that the SQL sums up anew, as parts of an image's side.
_PLACES = ((0.0, 0.0), (0.5, 0.5), (0.25, 0.75), (0.5, 0.125), (0.9, 0.3), (0.625, 0.5), (0.4921875, 0.5078125), (0.9984375, 0.9984375))


def _wide_uv(spark: SparkSession, sf: str) -> DataFrame:
    """Mean samples of three bands of the second array, an image a band."""
    x = fx.table(spark, sf, "lineitem").select((F.col("l_suppkey") % _ANTS).cast("int").alias("a"), (F.col("l_partkey") % _ANTS).cast("int").alias("b"), (F.col("l_linenumber") % 3).cast("int").alias("k"), (F.col("l_quantity") - 25.5).alias("re"), (F.round(F.col("l_discount") * 100) - 4.5).alias("im"))
    v = x.where("a <> b").groupBy(F.least("a", "b").alias("ant1"), F.greatest("a", "b").alias("ant2"), "k").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    hz = 2e9 + 4e8 * F.get(F.array(*map(F.lit, _WIDE)), F.col("k")) + 12.5e6
    east = lambda ant: 20.0 * F.pow(F.lit(1.08), F.col(ant)) * F.cos(2.1 * F.col(ant))
    north = lambda ant: 20.0 * F.pow(F.lit(1.08), F.col(ant)) * F.sin(2.1 * F.col(ant))
    g = image_geometry(hz, F.lit(2))
    u, w = (f("ant2") - f("ant1") for f in (east, north))
    return v.select(F.col("k").alias("image_key"), (u * hz / SPEED).alias("u"), (w * hz / SPEED).alias("v"), "re", "im", g["imsize"].cast("int").alias("size"), F.radians(g["cell"] / 3600).alias("cell"))


def i01c(spark: SparkSession, sf: str) -> DataFrame:
    """Images of the second array in blocks: the pixels at given places of each image and beam."""
    blocks = image_blocks(_wide_uv(spark, sf))
    at = F.explode(F.array(*(F.struct(F.floor(x * F.col("size")).cast("int").alias("x"), F.floor(y * F.col("size")).cast("int").alias("y")) for x, y in _PLACES))).alias("p")
    near = blocks.select("*", at).where((F.col("p.y") >= F.col("y0")) & (F.col("p.y") < F.col("y0") + F.size("data") / F.col("size")))
    value = F.get("data", (F.col("p.y") - F.col("y0")) * F.col("size") + F.col("p.x"))
    return near.select("image_key", "plane", "p.x", "p.y", F.round(value.cast("double"), 4).alias("value"))


_TAPER = lambda e: "CASE WHEN {e} <= {l} THEN {a} ELSE {b} END".format(e=f"abs({e})", l=im.LIMIT, **{n: "(" + " + ".join(f"{c!r} * power({e} * {e} - {q!r}, {i})" for i, c in enumerate(im.NUMERATORS[k])) + ") / (" + " + ".join(f"{c!r} * power({e} * {e} - {q!r}, {i})" for i, c in enumerate(im.DENOMINATORS[k])) + ")" for n, k, q in (("a", 0, im.LIMIT**2), ("b", 1, 1.0))})
_WIDE_UV = f"""WITH m AS (SELECT least(a, b) AS ant1, greatest(a, b) AS ant2, k, avg(re) AS re, avg(im) AS im FROM (SELECT l_suppkey % {_ANTS} AS a, l_partkey % {_ANTS} AS b, l_linenumber % 3 AS k, l_quantity - 25.5 AS re, round(l_discount * 100) - 4.5 AS im FROM lineitem) WHERE a <> b GROUP BY ALL),
h AS (SELECT *, 2e9 + 4e8 * [{', '.join(map(str, _WIDE))}][k + 1] + 12.5e6 AS hz, [1280, 2560, 5120][k + 1] AS size FROM m),
uv AS (SELECT k::INT AS image_key, size, {SPEED} / hz / 3000.0 / 3 AS cell, (20.0 * power(1.08, ant2) * cos(2.1 * ant2) - 20.0 * power(1.08, ant1) * cos(2.1 * ant1)) * hz / {SPEED} AS u, (20.0 * power(1.08, ant2) * sin(2.1 * ant2) - 20.0 * power(1.08, ant1) * sin(2.1 * ant1)) * hz / {SPEED} AS v, re, im FROM h)"""
_WIDE_SQL = (
    _WIDE_UV
    + _GRID.replace("image_key, abs(u) / 20.0", "image_key, size, abs(u) * 2 * size * cell").replace("END / 20.0 AS gv", "END * 2 * size * cell AS gv").replace("SELECT image_key, -gu", "SELECT image_key, size, -gu").replace("SELECT image_key, floor(gu)", "SELECT image_key, size, floor(gu)").replace("SELECT image_key, iu::BIGINT", "SELECT image_key, any_value(size) AS size, iu::BIGINT").replace("WHERE du < 3", "WHERE iu < size AND abs(iv) < size AND du < 3").replace("GROUP BY 1, 2, 3)", "GROUP BY image_key, iu, iv)")
    + f""", q AS (SELECT image_key, size, iu, iv, plane, CASE WHEN plane = 0 THEN re ELSE beam END * CASE WHEN iu = 0 THEN 1 ELSE 2 END AS re, CASE WHEN plane = 0 THEN im ELSE 0 END * CASE WHEN iu = 0 THEN 1 ELSE 2 END AS im FROM g, (VALUES (0), (1)) p(plane)),
pl AS (SELECT unnest([{', '.join(f"{{'x': {x}, 'y': {y}}}" for x, y in _PLACES)}]) AS p),
z AS (SELECT image_key, size, plane, floor(p.x * size)::INT AS x, floor(p.y * size)::INT AS y, sum(re * cos(pi() * (iu * (floor(p.x * size) - size // 2) + iv * (floor(p.y * size) - size // 2)) / size) + im * sin(pi() * (iu * (floor(p.x * size) - size // 2) + iv * (floor(p.y * size) - size // 2)) / size)) AS s FROM q, pl GROUP BY 1, 2, 3, 4, 5),
t AS (SELECT *, s / ({_TAPER('((x - size // 2) / size)')}) / ({_TAPER('((y - size // 2) / size)')}) AS v FROM z),
top AS (SELECT image_key, max(v) AS peak FROM t WHERE plane = 1 AND x = size // 2 AND y = size // 2 GROUP BY 1)
SELECT image_key, plane, x, y, round((v / peak)::FLOAT::DOUBLE, 4) + 0.0 AS value FROM t JOIN top USING (image_key)"""
)
register("i01_block_image", i01c, _WIDE_SQL)


for _name, _run in {"i01_dirty_image": i01, "i03_clean_beam": i03, "i04_hogbom": i04, "i05_steer": i05, "i06_hybrid_clean": i06b, "i04_hogbom_components": i01b, "i07_disk_offset": i07, "i13_refine_peaks": i13, "i14_batch_clean": i14}.items():
    register(_name, _run)
