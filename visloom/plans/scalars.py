"""Queries of projections, scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visloom.functions import signal, sun, timescale
from visloom.operators import geometry
from visloom.operators.integrate import number_frames, sample_chain
from visloom.plans import fixtures as fx
from visloom.registry import register

C = 299792458.0


def r6(x: Column, digits: int = 6) -> Column:
    return F.round(x, digits) + 0.0


def away(x: Column, digits: int) -> Column:
    """x rounded in binary, halves away from 0, as SQL engines round doubles: 4.98875 times 10000 is less than 49887.5. `r6` goes by the decimal digits that x is shown with."""
    y = F.abs(x) * float(10**digits)
    near = F.signum(x) * (F.floor(y) + F.when(y - F.floor(y) >= 0.5, 1).otherwise(0)) / float(10**digits) + 0.0
    return F.when(y < 2.0**52, near).otherwise(x)


def _parts(ts: str) -> dict[str, Column]:
    micro = F.pmod(timescale.micros(F.col(ts)), F.lit(1_000_000))
    return {"tick": F.col("event_id") % 64, "us": micro % 1000, "ms": F.floor(micro / 1000), "second": F.floor(F.second(ts)), "minute": F.minute(ts), "hour": F.hour(ts), "day": F.day(ts), "month": F.month(ts), "year": F.year(ts)}


def p01(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events").select("event_id", timescale.pack_time(_parts("ts")).alias("packed"))
    f = timescale.unpack_time(F.col("packed"))
    return e.select("event_id", timescale.instant(f).cast("string").alias("t"), f["ns"].cast("long").alias("ns"))


register("p01_unpack_time", p01, "SELECT event_id, CASE WHEN ts = date_trunc('second', ts) THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') END AS t, CASE WHEN event_id % 64 >= 50 THEN 0 ELSE (event_id % 64) * 20 END::BIGINT AS ns FROM events")


def p02(spark: SparkSession, sf: str) -> DataFrame:
    utc = timescale.to_utc(F.col("ts"))
    return fx.table(spark, sf, "events").select("event_id", F.date_format(utc, "yyyy-MM-dd").alias("date_utc"), F.date_format(utc, "HH:mm:ss").alias("time_utc"), timescale.iso_text(utc, F.col("event_id") % 50 * 20).alias("iso"))


register("p02_local_to_utc", p02, "SELECT event_id, strftime(u, '%Y-%m-%d') AS date_utc, strftime(u, '%H:%M:%S') AS time_utc, strftime(u, '%Y-%m-%dT%H:%M:%S.%f') || lpad(((event_id % 50) * 20)::VARCHAR, 3, '0') AS iso FROM (SELECT event_id, ts - INTERVAL 8 HOUR AS u FROM events)")


def p03(spark: SparkSession, sf: str) -> DataFrame:
    x = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 7 % 256).alias("a"), (F.col("l_partkey") % 256).alias("b"), (F.col("l_suppkey") * 37 % 256).alias("c"))
    return x.groupBy("l_linenumber").agg(F.sum(signal.signed24(F.col("a"), F.col("b"), F.col("c"))).alias("total"), F.min(signal.signed24(F.col("a"), F.col("b"), F.col("c"))).alias("low"))


register("p03_signed24", p03, "SELECT l_linenumber, sum(v)::BIGINT AS total, min(v)::BIGINT AS low FROM (SELECT l_linenumber, CASE WHEN r >= 8388608 THEN r - 16777216 ELSE r END AS v FROM (SELECT l_linenumber, l_orderkey * 7 % 256 + (l_partkey % 256) * 256 + (l_suppkey * 37 % 256) * 65536 AS r FROM lineitem)) GROUP BY 1")


def p04(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "loop_low").otherwise("fixed_high").alias("mode"), F.when(F.col("event_id") % 2 == 0, F.floor(F.col("event_id") / 2) % 9).otherwise(F.floor(F.col("event_id") / 2) % 35 * 257).cast("int").alias("code"), (F.col("user_id") % 2).cast("int").alias("frame_pol"))
    return signal.resolve_modes(e, signal.mode_codes(spark)).select("event_id", "pol", "sub_band", "freq_hz", "freqid")


register("p04_mode_codes", p04, """
WITH e AS (SELECT event_id, user_id, CAST(floor(event_id / 2) AS BIGINT) AS h FROM events), k AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN h % 9 ELSE h % 35 END AS k FROM e)
SELECT event_id, CASE WHEN event_id % 2 = 0 AND k < 8 THEN k % 2 ELSE user_id % 2 END::INT AS pol,
  CASE WHEN event_id % 2 = 0 THEN CASE WHEN k < 8 THEN floor(k / 2) END ELSE CASE WHEN k < 33 THEN k END END::INT AS sub_band,
  CASE WHEN event_id % 2 = 0 THEN CASE WHEN k < 8 THEN 400000000 * (floor(k / 2) + 1) END ELSE CASE WHEN k < 33 THEN least(2000000000 + 400000000 * k, 14600000000) END END::BIGINT AS freq_hz,
  CASE WHEN event_id % 2 = 0 THEN CASE WHEN k < 8 THEN floor(k / 2) + 1 END ELSE CASE WHEN k < 33 THEN k + 1 END END::INT AS freqid FROM k""")


def p05(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf)
    return v.groupBy("ant1", "ant2", "chan").agg(r6(F.avg(signal.amplitude(F.col("re"), F.col("im"))), 4).alias("amp"), r6(F.max(signal.phase(F.col("re"), F.col("im")))).alias("top_phase"))


register("p05_amplitude_phase", p05, fx.with_views("SELECT ant1, ant2, chan, round(avg(sqrt(re * re + im * im)), 4) + 0.0 AS amp, round(max(atan2(im, re)), 6) + 0.0 AS top_phase FROM vis GROUP BY 1, 2, 3", "vis"))


def p06(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.visu(spark, sf)
    re, im = signal.rotate(F.col("re"), F.col("im"), F.col("chan") * 0.1)
    return v.select("frame_id", "bl", "chan", r6(re, 5).alias("re"), r6(im, 5).alias("im"))


register("p06_phase_rotation", p06, fx.with_views("SELECT frame_id, bl, chan, round(re * cos(chan * 0.1) + im * sin(chan * 0.1), 5) + 0.0 AS re, round(im * cos(chan * 0.1) - re * sin(chan * 0.1), 5) + 0.0 AS im FROM visu", "visu"))


def p07(spark: SparkSession, sf: str) -> DataFrame:
    x = fx.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 300 + 1).cast("int").alias("a1"), (F.col("l_partkey") % 400 + 1).cast("int").alias("a2")).distinct()
    x = x.withColumn("id", geometry.baseline_id(F.col("a1"), F.col("a2")))
    b1, b2 = geometry.antennas_of(F.col("id"))
    return x.select("a1", "a2", "id", b1.alias("b1"), b2.alias("b2"))


register("p07_baseline_ids", p07, """SELECT *, CASE WHEN id > 65536 THEN floor((id - 65536) / 2048) ELSE floor(id / 256) END::INT AS b1, CASE WHEN id > 65536 THEN (id - 65536) % 2048 ELSE id % 256 END::INT AS b2
FROM (SELECT DISTINCT (l_suppkey % 300 + 1)::INT AS a1, (l_partkey % 400 + 1)::INT AS a2, CASE WHEN l_partkey % 400 + 1 > 255 THEN (l_suppkey % 300 + 1) * 2048 + l_partkey % 400 + 1 + 65536 ELSE (l_suppkey % 300 + 1) * 256 + l_partkey % 400 + 1 END::INT AS id FROM lineitem)""")


def p08(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf).select("frame_id", "chan", (F.col("ant1") % 2 + 1).alias("sub_array"))
    hz = signal.channel_hz((F.col("sub_array") * 4e8), F.col("chan"), F.col("sub_array"))
    return v.groupBy("sub_array", "chan", hz.alias("hz")).agg(F.count("*").alias("n"))


register("p08_channel_frequency", p08, fx.with_views("SELECT ant1 % 2 + 1 AS sub_array, chan, (ant1 % 2 + 1) * 4e8 + CASE WHEN ant1 % 2 = 0 THEN chan ELSE 15 - chan END * 25e6 + 12.5e6 AS hz, count(*) AS n FROM vis GROUP BY ALL", "vis"))


def p09(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.frames(spark, sf).select("frame_id", (F.col("sub_array") % 2 + 1).alias("sub_array"), "sub_band")
    f = f.withColumn("hz", F.when(F.col("sub_array") == 1, (F.col("sub_band") + 1) * 4e8).otherwise(2e9 + F.col("sub_band") * 2.4e9))
    g = signal.image_geometry(F.col("hz"), F.col("sub_array"))
    return f.select("frame_id", "hz", r6(g["cell"], 4).alias("cell"), g["imsize"].alias("imsize"), r6(g["fov"], 2).alias("fov"))


register("p09_image_geometry", p09, fx.with_views(f"""SELECT frame_id, hz, round(degrees({C} / hz / 3000.0) * 3600 / 3, 4) + 0.0 AS cell, s AS imsize, round(s * degrees({C} / hz / 3000.0) * 3600 / 3, 2) + 0.0 AS fov FROM
(SELECT *, CASE WHEN a = 1 THEN CASE WHEN hz < 800e6 THEN 256 WHEN hz < 1200e6 THEN 512 ELSE 1024 END ELSE CASE WHEN hz < 4e9 THEN 1280 WHEN hz < 8e9 THEN 2560 ELSE 5120 END END AS s FROM
(SELECT frame_id, sub_array % 2 + 1 AS a, CASE WHEN sub_array % 2 = 0 THEN (sub_band + 1) * 4e8 ELSE 2e9 + sub_band * 2.4e9 END AS hz FROM frames))""", "frames"))


def p10(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    jd = timescale.calendar_to_jd(F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate"))
    y, m, d = timescale.jd_to_calendar(F.col("jd") + 0.25)
    return o.select("o_orderkey", jd.cast("double").alias("jd")).select("o_orderkey", "jd", (F.col("jd") - 2400000.5).alias("mjd"), y.cast("int").alias("y"), m.cast("int").alias("m"), F.round(d, 6).alias("d"))


register("p10_julian_dates", p10, "SELECT o_orderkey, julian(date_trunc('day', o_orderdate)::TIMESTAMP) - 0.5 AS jd, julian(date_trunc('day', o_orderdate)::TIMESTAMP) - 0.5 - 2400000.5 AS mjd, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, (day(o_orderdate) + 0.25)::DOUBLE AS d FROM orders")

_JD = "(epoch_us(ts) / 86400e6 + 2440587.5)"
_PMOD = lambda x, y: f"((({x}) % {y} + {y}) % {y})"


def p11(spark: SparkSession, sf: str) -> DataFrame:
    jd = timescale.julian_date(F.col("ts"))
    return fx.table(spark, sf, "events").select("event_id", r6(timescale.earth_rotation(jd)).alias("era"), r6(timescale.sidereal_hours(jd, jd, 115.2505), 5).alias("last"))


_ERA = _PMOD(f"0.7790572732640 + 0.00273781191135448 * ({_JD} - 2451545.0) + {_PMOD(_JD, '1.0')}", "1.0")
_T = f"(({_JD} - 2451545.0) / 36525.0)"
register("p11_sidereal_time", p11, f"""SELECT event_id, round({_ERA}, 6) + 0.0 AS era, round({_PMOD(f"(0.014506 + {_T} * (4612.156534 + {_T} * (1.3915817 + {_T} * (-0.00000044 + {_T} * (-0.000029956 + {_T} * -0.0000000368))))) / 54000.0 + {_ERA} * 24.0 + 115.2505 / 15.0", '24.0')}, 5) + 0.0 AS last FROM events""")

LAT, LON = 42.2118, 115.2505


def _earth_fixed(ants: DataFrame) -> DataFrame:
    x, y, z = geometry.earth_fixed(LAT, F.lit(0.0), F.col("e"), F.col("n"), F.col("u"))
    x0, y0, z0 = geometry.earth_fixed(LAT, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    return ants.select("ant", (x - x0).alias("x"), (y - y0).alias("y"), (z - z0).alias("z"))


def p12(spark: SparkSession, sf: str) -> DataFrame:
    return _earth_fixed(fx.antennas(spark, sf)).select("ant", *(r6(F.col(c), 4).alias(c) for c in "xyz"))


register("p12_antenna_xyz", p12, fx.with_views(f"SELECT ant, round(-n * sin(radians({LAT})) + u * cos(radians({LAT})), 4) + 0.0 AS x, round(e, 4) + 0.0 AS y, round(n * cos(radians({LAT})) + u * sin(radians({LAT})), 4) + 0.0 AS z FROM antennas", "antennas"))


def p13(spark: SparkSession, sf: str) -> DataFrame:
    a = _earth_fixed(fx.antennas(spark, sf))
    b = a.select(F.col("ant").alias("ant2"), *(F.col(c).alias(f"{c}2") for c in "xyz"))
    pairs = a.join(b, F.col("ant") < F.col("ant2")).select(F.col("ant").alias("ant1"), "ant2", *((F.col(f"{c}2") - F.col(c)).alias(f"b{c}") for c in "xyz"))
    hours = fx.frames(spark, sf).groupBy("sub_band", "pol").agg((F.min("frame_id") % 24 - 12).cast("double").alias("h"))
    u, v, w = geometry.uvw_seconds(F.col("bx"), F.col("by"), F.col("bz"), F.col("h") * 15, F.lit(12.5))
    # Eight frames' hour angles and an array's baselines are both small, fixed tables.
    return pairs.crossJoin(F.broadcast(hours)).select("ant1", "ant2", "sub_band", "pol", *(r6(x * 1e9, 3).alias(n) for x, n in ((u, "u_ns"), (v, "v_ns"), (w, "w_ns"))))


register("p13_uvw", p13, fx.with_views(f"""WITH p AS (SELECT ant, -n * sin(radians({LAT})) + u * cos(radians({LAT})) AS x, e AS y, n * cos(radians({LAT})) + u * sin(radians({LAT})) AS z FROM antennas),
b AS (SELECT a.ant AS ant1, b.ant AS ant2, b.x - a.x AS x, b.y - a.y AS y, b.z - a.z AS z FROM p a JOIN p b ON a.ant < b.ant),
h AS (SELECT sub_band, pol, radians((min(frame_id) % 24 - 12) * 15) AS h, radians(12.5) AS d FROM frames GROUP BY 1, 2)
SELECT ant1, ant2, sub_band, pol, round((sin(h) * x + cos(h) * y) / {C} * 1e9, 3) + 0.0 AS u_ns, round((-sin(d) * cos(h) * x + sin(d) * sin(h) * y + cos(d) * z) / {C} * 1e9, 3) + 0.0 AS v_ns,
round((cos(d) * cos(h) * x - cos(d) * sin(h) * y + sin(d) * z) / {C} * 1e9, 3) + 0.0 AS w_ns FROM b, h""", "antennas", "frames"))


def _sun_sql(jd: str) -> tuple[str, str]:
    """CTEs of the Sun's angles of d(id, jd), and of its radius vector."""
    t = f"(({jd} - 2415020.0) / 36525.0)"
    ang = lambda a: f"({a[0]} + {_PMOD(f'{a[1]} * {t}', '360.0')})"
    me = ang(sun.EARTH)
    terms = " + ".join(f"{a} * cos(radians({p} + {i} * {ang(planet)} + {j} * {me}))" for planet, ts in sun.TERMS.items() for a, p, i, j in ts)
    arc = f"(279.696678 + {_PMOD(f'36000.768925 * {t}', '360.0')}) * 3600.0 + (6910.1 - 17.2 * {t}) * sin(radians({me})) + 72.3 * sin(radians(2.0 * {me})) + {terms} + 6.5 * sin(radians({ang(sun.MOON)})) + 6.4 * sin(radians(231.19 + 20.2 * {t}))"
    omega = f"(259.183275 - {_PMOD(f'1934.142008 * {t}', '360.0')})"
    cte = f"s1 AS (SELECT *, {_PMOD(f'{arc} + 2592000.0', '1296000.0')} AS arc, {omega} AS om, {t} AS t FROM d), s AS (SELECT *, arc / 3600.0 AS longitude, (arc - 20.5 - 17.2 * sin(radians(om))) / 3600.0 AS app, 23.452294 - 0.0130125 * t + 9.2 * cos(radians(om)) / 3600.0 AS ob FROM s1)"
    a2 = [f"radians({a} + {_PMOD(f'{r} * t', '360.0')})" for a, r in ((212.6, 58517.8), (358.476, 35999.0498), (319.5, 19139.86), (225.3, 3034.69), (350.7, 445267.11))]
    mv, m, mm, mj, dd = a2
    r = f"(1.000141 - (0.016748 - 0.0000418 * t) * cos({m}) - 0.00014 * cos(2.0 * {m}) + 0.000016 * cos(radians(58.3) + 2.0 * {mv} - 2.0 * {m}) + 0.000005 * cos(radians(209.1) + {mv} - {m}) + 0.000005 * cos(radians(253.8) - 2.0 * {mm} + 2.0 * {m}) + 0.000016 * cos(radians(89.5) - {mj} + {m}) + 0.000009 * cos(radians(357.1) - 2.0 * {mj} + 2.0 * {m}) + 0.000031 * cos({dd}))"
    return cte, r


_SUN, _R = _sun_sql("jd")


def p14(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", timescale.julian_date(F.col("o_orderdate").cast("timestamp_ntz")).alias("jd"))
    s = sun.sun_position(F.col("jd"))
    return o.select("o_orderkey", *(r6(s[k], 5).alias(k) for k in ("longitude", "app_long", "obliq", "ra", "dec")))


register("p14_sun_position", p14, f"""WITH d AS (SELECT o_orderkey, epoch_us(o_orderdate::TIMESTAMP) / 86400e6 + 2440587.5 AS jd FROM orders), {_SUN}, r AS (SELECT *, degrees(atan2(sin(radians(app)) * cos(radians(ob)), cos(radians(app)))) AS ra FROM s)
SELECT o_orderkey, round(longitude, 5) + 0.0 AS longitude, round(app, 5) + 0.0 AS app_long, round(ob, 5) + 0.0 AS obliq, round(CASE WHEN ra < 0 THEN ra + 360.0 ELSE ra END, 5) + 0.0 AS ra, round(degrees(asin(sin(radians(app)) * sin(radians(ob)))), 5) + 0.0 AS dec FROM r""")


def p15(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", timescale.julian_date(F.col("o_orderdate").cast("timestamp_ntz")).alias("jd"))
    s = sun.solar_angles(F.col("jd"))
    return o.select("o_orderkey", *(r6(s[k], 5).alias(k) for k in ("p", "b0", "sd")))


register("p15_solar_angles", p15, f"""WITH d AS (SELECT o_orderkey, epoch_us(o_orderdate::TIMESTAMP) / 86400e6 + 2440587.5 AS jd FROM orders), {_SUN},
g AS (SELECT *, longitude - 20.5 / 3600.0 - (73.666666 + (50.25 / 3600.0) * ((jd - 2415020.0) / 365.25 + 50.0)) AS arg FROM s)
SELECT o_orderkey, round(degrees(atan(-tan(radians(ob)) * cos(radians(app))) + atan(-0.12722 * cos(radians(arg)))), 5) + 0.0 AS p, round(degrees(asin(0.1262 * sin(radians(arg)))), 5) + 0.0 AS b0,
round(degrees(asin({sun.SUN_RADIUS_M} / {sun.AU_M} / {_R})) * 60.0, 5) + 0.0 AS sd FROM g""")


def p16(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", (F.floor("o_totalprice") % 7200 / 16 - 180).alias("deg"))
    sign, d, m, s = timescale.sexagesimal(F.col("deg"))
    text = F.concat(F.when(sign < 0, "-").otherwise(""), F.format_string("%d:%d:%s", d, m, F.round(s, 2).cast("string")))
    return o.select("o_orderkey", d.cast("int").alias("d"), m.cast("int").alias("m"), F.round(s, 4).alias("s"), F.round(timescale.from_sexagesimal(text), 4).alias("back"))


register("p16_sexagesimal", p16, "SELECT o_orderkey, floor(abs(x))::INT AS d, floor((abs(x) - floor(abs(x))) * 60)::INT AS m, round((abs(x) - floor(abs(x))) * 3600 - floor((abs(x) - floor(abs(x))) * 60) * 60, 4) AS s, round(x, 4) AS back FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT % 7200 / 16 - 180 AS x FROM orders)")


def p17(spark: SparkSession, sf: str) -> DataFrame:
    """Delta-T of each order's day: the day's UT1 offset by an equi-join on the day number, leap seconds as of the day."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("t")).withColumn("mjd", F.floor(timescale.julian_date(F.col("t")) - 2400000.5))
    eop = o.select("mjd").distinct().select("mjd", (F.col("mjd") % 200 / 250.0 - 0.4).alias("ut1_utc"))
    leap = timescale.tai_minus_utc(F.col("t"))
    return o.join(eop, "mjd").select("o_orderkey", leap.alias("leap"), F.round(timescale.delta_t(leap, F.col("ut1_utc")), 4).alias("delta_t"))


_LEAP = ", ".join(f"(DATE '{d}', {i})" for i, d in enumerate(timescale.LEAP_DAYS, timescale.FIRST_LEAP))
register("p17_delta_t", p17, f"WITH l(day, leap) AS (VALUES {_LEAP}), o AS (SELECT o_orderkey, o_orderdate::DATE AS day, (o_orderdate::DATE - DATE '1858-11-17')::BIGINT AS mjd FROM orders) SELECT o_orderkey, leap::INT AS leap, round(32.184 + leap - (mjd % 200 / 250.0 - 0.4), 4)::DOUBLE AS delta_t FROM o ASOF JOIN l ON l.day <= o.day")


def p18(spark: SparkSession, sf: str) -> DataFrame:
    """Universal to atomic to terrestrial to barycentric time: whole microseconds of TT, and the periodic terms."""
    tt = timescale.tt_micros(F.col("ts"))
    jd = tt / 86400e6 + 2440587.5
    return fx.table(spark, sf, "events").select("event_id", tt.alias("tt_us"), F.round(timescale.tdb_minus_tt(jd) * 1e6, 2).alias("tdb_tt_us"))


_TT = "(epoch_us(ts) + 69184000)"
register("p18_tdb_tt", p18, f"SELECT event_id, {_TT} AS tt_us, round((0.001657 * sin(628.3076 * t + 6.2401) + 0.000022 * sin(575.3385 * t + 4.2970) + 0.000014 * sin(1256.6152 * t + 6.1969) + 0.000005 * sin(606.9777 * t + 4.0212) + 0.000005 * sin(52.9691 * t + 0.4444) + 0.000002 * sin(21.3299 * t + 5.5431) + 0.00001 * t * sin(628.3076 * t + 4.2490)) * 1e6, 2) AS tdb_tt_us FROM (SELECT event_id, ts, ({_TT} / 86400e6 + 2440587.5 - 2451545.0) / 36525.0 AS t FROM events)")


def p19(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", (F.floor("o_totalprice") % 93 - 2.5).alias("alt"))
    return o.select("o_orderkey", r6(timescale.refraction(F.col("alt"), 10.0, 1010.0)).alias("lift"), r6(timescale.apparent_altitude(F.col("alt"), 10.0, 1010.0, 2)).alias("seen"))


_REF = lambda x: f"(CASE WHEN ({x}) >= -1.0 AND ({x}) <= 89.9 THEN 0.016667 / tan(radians(({x}) + 7.31 / (({x}) + 4.4))) * (0.28 * 1010.0 / 283.0) ELSE 0.0 END)"
register("p19_refraction", p19, f"WITH a AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT % 93 - 2.5::DOUBLE AS alt FROM orders), b AS (SELECT *, {_REF('alt')} AS r1 FROM a), c AS (SELECT *, alt + r1 AS s1 FROM b) SELECT o_orderkey, round(r1, 6) + 0.0 AS lift, round(alt + {_REF('s1')}, 6) + 0.0 AS seen FROM c")


def p20(spark: SparkSession, sf: str) -> DataFrame:
    x = fx.table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 11 - 5.0).alias("x"), (F.col("o_orderkey") % 13 - 6.0).alias("y"), (F.floor("o_totalprice") % 7 - 3.0).alias("z"))
    r, el, az = geometry.to_polar(F.col("x"), F.col("y"), F.col("z"))
    x2, _, _ = geometry.from_polar(r, el, az)
    return x.select("o_orderkey", r6(r).alias("r"), r6(el).alias("el"), r6(az).alias("az"), r6(x2, 5).alias("x2"))


register("p20_polar", p20, "SELECT o_orderkey, round(r, 6) + 0.0 AS r, round(CASE WHEN r > 0 THEN asin(z / r) ELSE 0.0 END, 6) + 0.0 AS el, round(CASE WHEN atan2(y, x) < 0 THEN atan2(y, x) + 2 * pi() ELSE atan2(y, x) END, 6) + 0.0 AS az, round(x, 5) + 0.0 AS x2 FROM (SELECT *, sqrt(x * x + y * y + z * z) AS r FROM (SELECT o_orderkey, o_custkey % 11 - 5.0::DOUBLE AS x, o_orderkey % 13 - 6.0::DOUBLE AS y, floor(o_totalprice)::BIGINT % 7 - 3.0::DOUBLE AS z FROM orders))")


def p25(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events")
    code = F.col("event_id") % 4 * 257
    return e.groupBy(signal.pol_label(F.col("event_id") % 2).alias("pol"), signal.target_label(code).alias("target")).agg(F.count("*").alias("n"))


register("p25_labels", p25, "SELECT CASE WHEN event_id % 2 = 0 THEN 'LL' ELSE 'RR' END AS pol, CASE event_id % 4 WHEN 0 THEN 'sun' WHEN 1 THEN 'satellite' WHEN 2 THEN 'swan' ELSE 'other' END AS target, count(*) AS n FROM events GROUP BY 1, 2")


def p26(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.vis(spark, sf)
    phi = signal.offset_phase(F.col("ant1") * 3.0, F.col("ant2") * 2.0, F.lit(0.002), F.lit(-0.001))
    re, im = signal.rotate(F.col("re"), F.col("im"), phi)
    return b.groupBy("ant1", "ant2").agg(r6(F.sum(re), 4).alias("re"), r6(F.sum(im), 4).alias("im"))


_PHI = "(2 * pi() * (ant1 * 3.0 * 0.002 + ant2 * 2.0 * -0.001))"
register("p26_offset_phase", p26, fx.with_views(f"SELECT ant1, ant2, round(sum(re * cos({_PHI}) + im * sin({_PHI})), 4) + 0.0 AS re, round(sum(im * cos({_PHI}) - re * sin({_PHI})), 4) + 0.0 AS im FROM vis GROUP BY 1, 2", "vis"))


def p26d(spark: SparkSession, sf: str) -> DataFrame:
    """The drifting pointing: values turned forward by the n-th step of the drift, u and v in light seconds."""
    b = fx.vis(spark, sf).withColumn("n", F.col("frame_id") % 30)
    phi = signal.drifting_phase(F.col("ant1") * 1e-8, F.col("ant2") * -2e-8, F.col("chan") * 25e6 + 4e8, F.col("n"))
    re, im = signal.rotate(F.col("re"), F.col("im"), -phi)
    return b.groupBy("ant1", "ant2").agg(r6(F.sum(re), 4).alias("re"), r6(F.sum(im), 4).alias("im"))


_DRIFT = "(2 * pi() * (chan * 25e6 + 4e8) * (ant1 * 1e-8 * radians(0.14::DOUBLE) + ant2 * -2e-8 * radians(-0.1::DOUBLE + 0.02::DOUBLE * (frame_id % 30))))"
register("p26_drifting_phase", p26d, fx.with_views(f"SELECT ant1, ant2, round(sum(re * cos({_DRIFT}) - im * sin({_DRIFT})), 4) + 0.0 AS re, round(sum(im * cos({_DRIFT}) + re * sin({_DRIFT})), 4) + 0.0 AS im FROM vis GROUP BY 1, 2", "vis"))


def p27(spark: SparkSession, sf: str) -> DataFrame:
    """Frames from start to end, and the frames a reader may skip before start."""
    f = fx.frames(spark, sf)
    start, end = 3_000_000, 20_000_000
    first = f.agg(F.min("t_us").alias("t0"))
    picked = f.where(F.col("t_us").between(start, end))
    return picked.crossJoin(F.broadcast(first)).groupBy("sub_band", "pol").agg(F.count("*").alias("n"), F.min("frame_id").alias("first_frame"), F.max(F.floor((start - F.col("t0")) / 3125) - 1).cast("long").alias("skip"))


register("p27_time_range", p27, fx.with_views("SELECT sub_band, pol, count(*) AS n, min(frame_id) AS first_frame, (SELECT floor((3000000 - min(t_us)) / 3125) - 1 FROM frames)::BIGINT AS skip FROM frames WHERE t_us BETWEEN 3000000 AND 20000000 GROUP BY 1, 2", "frames"))


def p28(spark: SparkSession, sf: str) -> DataFrame:
    """Frames from the first start of a cycle on or after the wanted time."""
    f = fx.frames(spark, sf)
    start = f.where("t_us >= 1000000").agg(F.min(F.when((F.col("sub_band") == 0) & (F.col("pol") == 0), F.col("t_us"))).alias("t0"))
    return f.join(F.broadcast(start), F.col("t_us") >= F.col("t0")).agg(F.count("*").alias("n"), F.min("frame_id").alias("first_frame"))


register("p28_cycle_alignment", p28, fx.with_views("SELECT count(*) AS n, min(frame_id) AS first_frame FROM frames WHERE t_us >= (SELECT min(t_us) FROM frames WHERE t_us >= 1000000 AND sub_band = 0 AND pol = 0)", "frames"))


def p29(spark: SparkSession, sf: str) -> DataFrame:
    v, f = fx.vis(spark, sf), fx.frames(spark, sf)
    return v.where(F.col("chan").isin(2, 3, 7)).join(f.where("sub_band IN (0, 2) AND pol = 1").select("frame_id", "sub_band"), "frame_id").groupBy("sub_band", "chan").agg(F.count("*").alias("n"), F.sum("re").alias("re"))


register("p29_subselect", p29, fx.with_views("SELECT sub_band, chan, count(*) AS n, sum(re) AS re FROM vis JOIN frames USING (frame_id) WHERE chan IN (2, 3, 7) AND sub_band IN (0, 2) AND pol = 1 GROUP BY 1, 2", "vis", "frames"))


def p30(spark: SparkSession, sf: str) -> DataFrame:
    v = fx.vis(spark, sf).withColumn("id", (F.col("ant1") * 7 + 1) * 256 + F.col("ant2") * 7 + 1)
    return v.where(F.col("id") < 255 * 256 + 255).agg(F.count("*").alias("n"), F.max("id").cast("long").alias("top"))


register("p30_convention_filter", p30, fx.with_views("SELECT count(*) AS n, max(id)::BIGINT AS top FROM (SELECT (ant1 * 7 + 1) * 256 + ant2 * 7 + 1 AS id FROM vis) WHERE id < 255 * 256 + 255", "vis"))


def p31(spark: SparkSession, sf: str) -> DataFrame:
    """Interleaved re, im of four correlations in a flux array, as columns by channel."""
    e = fx.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 4)).alias("flux"))
    groups = e.select("vec_id", "flux", F.explode(F.sequence(F.lit(0), F.floor(F.size("flux") / 8).cast("int") - 1)).alias("chan"))
    names = [f"{p}_{c}" for p in ("xx", "yy", "xy", "yx") for c in ("re", "im")]
    return groups.select("vec_id", "chan", *(F.get("flux", F.col("chan") * 8 + i).alias(n) for i, n in enumerate(names)))


register("p31_stokes_columns", p31, "SELECT vec_id, c::INT AS chan, " + ", ".join(f"round(embedding[c * 8 + {i + 1}]::DOUBLE, 4) AS {p}_{q}" for i, (p, q) in enumerate((p, q) for p in ("xx", "yy", "xy", "yx") for q in ("re", "im"))) + " FROM embeddings, (SELECT range AS c FROM range(8))")


def p32(spark: SparkSession, sf: str) -> DataFrame:
    """Every 40th of the frames of a band and polarization."""
    f = fx.frames(spark, sf).where("sub_band = 1 AND pol = 0")
    n = number_frames(f, ["sub_band", "pol"], "t_us")
    return n.where("(n - 1) % 40 = 0").select("frame_id", "t_us", F.col("n").cast("int").alias("n"))


register("p32_thinning", p32, fx.with_views("SELECT frame_id, t_us, n::INT AS n FROM (SELECT *, row_number() OVER (ORDER BY t_us) AS n FROM frames WHERE sub_band = 1 AND pol = 0) WHERE (n - 1) % 40 = 0", "frames"))

#: Frames that are jumped over after one is taken, and the clock's step.
_JUMP, _STEP = 398, 3125


def p32b(spark: SparkSession, sf: str) -> DataFrame:
    """One frame of a band and polarization, then the first such frame after a jump over the next 398 slots of the clock."""
    f = fx.frames(spark, sf).where("sub_band = 1 AND pol = 0")
    return sample_chain(f, ["sub_band", "pol"], (_JUMP + 1) * _STEP)


register("p32_thinning_jump", p32b, fx.with_views(f"""WITH w AS (SELECT * FROM frames WHERE sub_band = 1 AND pol = 0), c AS (SELECT sub_band, pol, min(t_us) AS t_us FROM w GROUP BY 1, 2
UNION ALL SELECT c.sub_band, c.pol, (SELECT min(w.t_us) FROM w WHERE w.t_us >= c.t_us + {(_JUMP + 1) * _STEP}) FROM c WHERE EXISTS (SELECT 1 FROM w WHERE w.t_us >= c.t_us + {(_JUMP + 1) * _STEP})) SELECT * FROM c""", "frames").replace("WITH ", "WITH RECURSIVE ", 1))


def p33(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events")
    text = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd")).when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss SSSSSS")).otherwise("no date")
    return e.select("event_id", timescale.micros(timescale.parse_date_text(text)).alias("us"))


register("p33_date_text", p33, "SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(date_trunc('day', ts)::TIMESTAMP) WHEN 1 THEN epoch_us(date_trunc('second', ts)) WHEN 2 THEN epoch_us(ts) END AS us FROM events")


def p34(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of an integration and integrations of a span, by cycle length."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", (F.floor("o_totalprice") * 1000).alias("span_us"), F.element_at(F.array(F.lit(25000), F.lit(206250), F.lit(3125)), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("cycle_us"))
    per = F.ceil(F.lit(1_000_000) / F.col("cycle_us"))
    return o.select("o_orderkey", per.cast("long").alias("cycles"), F.floor(F.col("span_us") / (per * F.col("cycle_us"))).cast("long").alias("integrations"))


register("p34_integration_plan", p34, "SELECT o_orderkey, ceil(1000000 / c)::BIGINT AS cycles, floor(s / (ceil(1000000 / c) * c))::BIGINT AS integrations FROM (SELECT o_orderkey, floor(o_totalprice) * 1000 AS s, CASE o_orderkey % 3 WHEN 0 THEN 25000 WHEN 1 THEN 206250 ELSE 3125 END AS c FROM orders)")
