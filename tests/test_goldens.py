"""Published and constructed values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.functions import orbits, sun, timescale
from visloom.operators import flagging, geometry, imaging, integrate, params, vistable
from visloom.sources import rawframes, tables
from visloom.streaming import frames as streams


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.mark.parametrize(("jd", "degrees"), [(2440423.345833333, 243.32160780274833), (2448031.5, 237.5118441792128), (2451545.0, 280.46061837504), (2456164.5, 333.4965831957672)])
def test_earth_rotation(spark, jd, degrees):
    assert one(spark, timescale.earth_rotation(F.lit(jd)) * 360)[0] == pytest.approx(degrees, abs=1e-6)


def test_calendar(spark):
    jd = timescale.calendar_to_jd(F.lit(1969), F.lit(7), F.lit(20))
    assert one(spark, jd)[0] == 2440422.5
    assert one(spark, *timescale.jd_to_calendar(F.lit(2440423.345833333)))[:2] == (1969, 7)
    assert one(spark, timescale.jd_to_calendar(F.lit(2440423.345833333))[2])[0] == pytest.approx(20.845833333, abs=1e-6)


def test_packed_time_round_trip(spark):
    f = {"tick": 10, "us": 999, "ms": 1, "second": 59, "minute": 0, "hour": 23, "day": 31, "month": 12, "year": 2015}
    back = timescale.unpack_time(timescale.pack_time({k: F.lit(v) for k, v in f.items()}))
    assert one(spark, *(back[k] for k in f)) == tuple(f.values())
    assert one(spark, back["ns"])[0] == 200


def test_polar(spark):
    r, el, az = one(spark, *geometry.to_polar(F.lit(0.0), F.lit(-1.0), F.lit(0.0)))
    assert (r, el) == (1.0, 0.0)
    assert az == pytest.approx(1.5 * np.pi)
    assert one(spark, *geometry.to_polar(F.lit(0.0), F.lit(0.0), F.lit(0.0))) == (0.0, 0.0, 0.0)


def test_teme_rotation_keeps_length(spark):
    x, y, z = one(spark, *orbits.teme_to_earth((F.lit(5094.18), F.lit(6127.64), F.lit(6380.34)), F.lit(2453101.827406783)))
    assert x * x + y * y + z * z == pytest.approx(5094.18**2 + 6127.64**2 + 6380.34**2)
    assert (x, y, z) == pytest.approx((-1033.475, 7901.305, 6380.345), abs=1.0)


def test_teme_velocity(spark):
    """Published example of the frame change, with the pole's place (arc seconds) and km a day."""
    day, arc = 86400.0, orbits.ARC
    r = tuple(map(F.lit, (5094.18016210, 6127.64465950, 6380.34453270)))
    v = tuple(F.lit(x * day) for x in (-4.746131487, 0.785818041, 5.531931288))
    jd = F.lit(2453101.5 + (7 * 3600 + 51 * 60 + 28.386 - 0.439961) / day)
    pole = (-0.140682 * arc, 0.333309 * arc)
    assert one(spark, *orbits.teme_to_earth(r, jd, *pole)) == pytest.approx((-1033.47938300, 7901.29527540, 6380.35659580), abs=1e-4)
    got = one(spark, *orbits.teme_velocity_to_earth(r, v, jd, *pole))
    assert [x / day for x in got] == pytest.approx([-3.225636520, -2.872451450, 5.531924446], abs=1e-7)


def test_sun(spark):
    """The almanac's Sun of 1 May 1982, and pole and disk centre of 13 October 1992."""
    p = sun.sun_position(F.lit(2445090.5))
    ra, dec = one(spark, p["ra"], p["dec"])
    assert ra / 15 == pytest.approx(2 + 31 / 60 + 32.6 / 3600, abs=0.1 / 3600) and dec == pytest.approx(14 + 54 / 60 + 34.9 / 3600, abs=0.5 / 3600)
    a = sun.solar_angles(F.lit(2448908.5))
    assert one(spark, a["p"], a["b0"], a["sd"]) == pytest.approx((26.27, 5.99, 16.03), abs=0.05)


def test_leap_seconds(spark):
    at = lambda t: one(spark, timescale.tai_minus_utc(F.lit(t).cast("timestamp_ntz")))[0]
    assert [at(t) for t in ("1971-12-31", "1972-01-01", "1973-12-31 23:59:59", "2016-12-31 23:59:59", "2017-01-01", "2030-01-01")] == [None, 10, 12, 36, 37, 37]
    assert one(spark, timescale.tt_micros(F.lit("2000-01-01 12:00:00").cast("timestamp_ntz")))[0] == 946728000_000_000 + 64_184_000


def utc(spark, day, seconds, places):
    """Text of seconds in a day, by way of atomic time."""
    rows = spark.createDataFrame([(round(x * 1e6),) for x in seconds], "us long")
    tai = timescale.tai_of_day(F.lit(day).cast("date"), F.col("us"))
    return [r["t"] for r in rows.orderBy("us").select(timescale.utc_iso(tai, places).alias("t")).collect()]


@pytest.mark.parametrize(
    ("day", "second", "texts"),
    [
        ("1915-12-02", 3 * 3600 + 4 * 60 + 5.6786786, ("1915-12-02T03:04:06Z", "1915-12-02T03:04:05.7Z", "1915-12-02T03:04:05.68Z", "1915-12-02T03:04:05.679Z", "1915-12-02T03:04:05.6787Z")),
        ("2014-12-21", 6 * 3600 + 3 * 60 + 1.234234, ("2014-12-21T06:03:01Z", "2014-12-21T06:03:01.2Z", "2014-12-21T06:03:01.23Z", "2014-12-21T06:03:01.234Z", "2014-12-21T06:03:01.2342Z")),
        ("1973-12-31", 86400.12349, ("1973-12-31T23:59:60Z", "1973-12-31T23:59:60.1Z", "1973-12-31T23:59:60.12Z", "1973-12-31T23:59:60.123Z", "1973-12-31T23:59:60.1235Z")),
    ],
)
def test_universal_time_as_text(spark, day, second, texts):
    for places, text in enumerate(texts):
        assert utc(spark, day, [second], places) == [text]


def test_universal_time_over_a_leap_second(spark):
    at = 86340 + np.arange(58.75, 63.1, 0.5)
    whole = ["23:59:59", "23:59:59", "23:59:60", "23:59:60", "00:00:00", "00:00:00", "00:00:01", "00:00:01", "00:00:02"]
    assert [x[11:19] for x in utc(spark, "1973-12-31", at, 0)] == whole
    parts = ["23:59:58.75", "23:59:59.25", "23:59:59.75", "23:59:60.25", "23:59:60.75", "00:00:00.25", "00:00:00.75", "00:00:01.25", "00:00:01.75"]
    assert [x[11:22] for x in utc(spark, "1973-12-31", at, 2)] == parts
    # Atomic time reaches the first moment of 1974 twelve seconds before universal time does.
    assert one(spark, timescale.tai_of_day(F.lit("1973-12-31").cast("date"), F.lit((86400 - 12) * 10**6)))[0] == 1461 * 86400 * 10**6


def test_chebyshev_of_many_coefficients(spark):
    c = np.zeros(1501)
    c[1500] = 1.0
    assert one(spark, orbits.chebyshev(F.array(*map(F.lit, c.tolist())), F.lit(1.0)))[0] == 1.0
    assert one(spark, orbits.chebyshev(F.array(F.lit(2.5)), F.lit(0.3)))[0] == 2.5


def test_anomaly_of_many_turns(spark):
    a = orbits.eccentric_anomaly(F.col("m"), F.lit(0.3))
    x, y = (spark.range(1).select(F.lit(m).alias("m")).select(a).first()[0] for m in (1.0, 1.0 + 200 * np.pi))
    assert x == pytest.approx(y, abs=1e-9)


def test_orientation_records(spark):
    import struct

    raw = struct.pack("<HBBIddd", 2005, 1, 1, 53371, 0.05, 0.38, -0.5) + struct.pack("<HBBIddd", 2005, 1, 2, 53372, 0.06, 0.39, -0.51) + b"rest"
    rows = tables.orientation_records(spark.createDataFrame([(bytearray(raw),), (None,)], "record binary")).collect()
    assert [tuple(r) for r in rows] == [(2005, 1, 1, 53371, 0.05, 0.38, -0.5), (2005, 1, 2, 53372, 0.06, 0.39, -0.51)]


def test_kepler(spark):
    df = spark.range(500).select((F.col("id") % 95 / 100).alias("e"), (F.col("id") / 80).alias("m"))
    a = orbits.eccentric_anomaly(F.col("m"), F.col("e"))
    assert df.withColumn("a", a).select(F.max(F.abs(F.col("a") - F.col("e") * F.sin("a") - F.col("m")))).first()[0] < 1e-10


@pytest.mark.parametrize("array", [1, 2])
def test_raw_frames_round_trip(array):
    rng = np.random.default_rng(array)
    n, outs = 3, rawframes.OUTPUTS[array]
    count = outs * (outs - 1) // 2
    whole = lambda *s: rng.integers(-(1 << 23), 1 << 23, s)
    vis = whole(n, count, 16) + 1j * whole(n, count, 16)
    vis[0, 0, 0], vis[0, 1, 0] = -(1 << 23), (1 << 23) - 1
    auto, delay = rng.integers(0, 1 << 32, (n, outs, 16)), rng.integers(0, 1 << 15, (n, outs))
    header = {k: rng.integers(0, 1 << 32, n) for k in ("frequency_switch", "bandwidth", "quantization", "delay_switch", "strip_switch", "sub_band_switch")}
    header |= {"packed_time": rng.integers(0, 1 << 62, n), "target": np.array([0, 0x101, 0x202]), "array_tag": np.array([0, 0x4E4E, 0]), "loop_code": np.array([0, 3, 7])}
    records = rawframes.encode(np.arange(n), array, header, vis, auto, delay)
    out = {what: rawframes.decode(records, np.arange(n), array, what).to_pandas() for what in rawframes.SCHEMAS}
    a1, a2 = rawframes.pairs(outs)
    use = (a1 < rawframes.ANTENNAS[array]) & (a2 < rawframes.ANTENNAS[array])
    got = (out["vis"]["re"] + 1j * out["vis"]["im"]).to_numpy().reshape(n, use.sum(), 16)
    assert np.array_equal(got, vis[:, use])
    assert np.array_equal(out["autocorr"]["power"].to_numpy().reshape(n, -1, 16), auto[:, : rawframes.ANTENNAS[array]])
    assert np.array_equal(out["delays"]["delay_ns"].to_numpy().reshape(n, -1), delay[:, : rawframes.ANTENNAS[array]])
    for k, v in header.items():
        assert np.array_equal(out["headers"][k].to_numpy(), v), k


def raw_header(n, year=2015, **fields):
    h = {k: np.zeros(n, np.int64) for k in ("frequency_switch", "bandwidth", "quantization", "delay_switch", "strip_switch", "sub_band_switch", "target", "array_tag", "loop_code")}
    return h | {"packed_time": rawframes.packed_times(np.arange(n), year)} | {k: np.asarray(v, np.int64) for k, v in fields.items()}


def modes(array, n, **fields):
    vis = np.zeros((n, rawframes.OUTPUTS[array] * (rawframes.OUTPUTS[array] - 1) // 2, 16)) + 7
    records = rawframes.encode(np.arange(n), array, raw_header(n, **fields), vis + 0j, np.zeros((n, rawframes.OUTPUTS[array], 16)), np.zeros((n, rawframes.OUTPUTS[array]), int))
    assert (rawframes.decode(records, np.arange(n), array, "vis").column(5).to_numpy() == 7).all()
    return rawframes.decode(records, np.arange(n), array, "headers").to_pandas()


def test_modes_of_the_first_array():
    h = modes(1, 8, loop_code=np.arange(8), sub_band_switch=np.full(8, 0x11113333))
    assert h["loop"].all() and h["pol"].tolist() == [0, 1] * 4 and h["freq_hz"].tolist() == [400_000_000 * (k // 2 + 1) for k in range(8)] and h["freqid"].tolist() == [1, 1, 2, 2, 3, 3, 4, 4]
    h = modes(1, 4, sub_band_switch=np.array([0x33333333, 0x77777777, 0xBBBB3333, 0xCCCC0000]), bandwidth=np.full(4, 0x77777777), target=np.array([0, 0x101, 0x202, 9]), array_tag=np.array([0, 0x4E4E, 0, 5]))
    assert not h["loop"].any() and h["sub_band"].tolist() == [0, 1, 2, 3] and h["pol"].tolist() == [0, 1, 0, 1] and (h["if_bandwidth"] == 12_500_000).all()
    assert h["obs_target"].tolist() == ["sun", "satellite", "swan", "other"] and h["real_sub_array"].tolist()[:3] == [1, 2, 1] and np.isnan(h["real_sub_array"][3])
    h = modes(1, 2, loop_code=np.array([8, 255]), sub_band_switch=np.array([0x1111, 0x1111]))
    assert h[["pol", "sub_band", "freq_hz"]].isna().all(None)


def test_modes_of_the_first_array_before_2015():
    """The loop code lies at the record's end, over a part of its body; polarizations alternate."""
    h = modes(1, 4, year=2014, old_loop_code=np.array([0, 0x5555, 0xAAAA, 0xFFFF]), sub_band_switch=np.full(4, 0x11113333), loop_code=np.full(4, 7))
    assert h["loop"].all() and not h["recent"].any() and h["sub_band"].tolist() == [0, 1, 2, 3] and h["pol"].tolist() == [0, 1, 0, 1] and (h["obs_target"] == "sun").all() and (h["real_sub_array"] == 1).all()
    h = modes(1, 4, year=2014, old_loop_code=np.zeros(4), sub_band_switch=np.array([0x33333333, 0x77777777, 0xBBBB3333, 0xCCCC0000]))
    assert not h["loop"].any() and h["sub_band"].tolist() == [0, 1, 2, 3]


def test_modes_of_the_second_array():
    h = modes(2, 66, loop_code=np.arange(66), sub_band_switch=np.full(66, 0xEEEE0000))
    assert h["loop"].all() and h["pol"].tolist() == [0, 1] * 33 and (h["freqid"] == 1).all() and h["freq_hz"].tolist()[::2] == [min(2_000_000_000 + 400_000_000 * k, 14_600_000_000) for k in range(33)]
    h = modes(2, 33, year=2014, sub_band_switch=np.arange(33) * 0x101 << 16)
    assert not h["loop"].any() and h["sub_band"].tolist() == list(range(33)) and h["freqid"].tolist() == list(range(1, 34))


def test_year_is_that_of_universal_time():
    packed = np.array([0, 0])
    for name, values in (("year", [15, 15]), ("month", [1, 1]), ("day", [1, 1]), ("hour", [7, 8])):
        at = 0
        for n, bits in timescale.PACKED:
            if n == name:
                packed |= np.array(values) << at
            at += bits
    assert rawframes.is_recent(packed).tolist() == [False, True]


def test_raw_source_reads_a_file(spark, tmp_path):
    n = 5
    header = {k: np.zeros(n, int) for k in ("frequency_switch", "bandwidth", "quantization", "delay_switch", "strip_switch", "sub_band_switch", "target", "array_tag", "loop_code")}
    header["packed_time"] = rawframes.packed_times(np.arange(n))
    vis = np.arange(n)[:, None, None] + np.zeros((n, 946, 16))
    records = rawframes.encode(np.arange(n), 1, header, vis + 0j, np.zeros((n, 44, 16)), np.zeros((n, 44), int))
    path = tmp_path / "frames.dat"
    path.write_bytes(records.tobytes())
    spark.dataSource.register(rawframes.RawFrameSource)
    v = spark.read.format("rawframes").option("path", str(path)).option("array", 1).option("table", "vis").option("frames", 2).load()
    assert {r["frame_no"]: (r["n"], r["re"]) for r in v.groupBy("frame_no").agg(F.count("*").alias("n"), F.avg("re").alias("re")).collect()} == {i: (12480, float(i)) for i in range(n)}
    assert [(r["frame_no"], r["sub_band"]) for r in spark.read.format("rawframes").option("path", f"{path},{path}").option("array", 1).option("frames", 3).load().orderBy("frame_no").collect()] == [(i, 0) for i in range(n) for _ in range(2)]
    back = rawframes.decode_table(rawframes.read_records(spark, str(path), 1), 1, "headers")
    assert sorted(r["frame_no"] for r in back.collect()) == list(range(n))


def source(l, m, flux, u, v):
    phi = 2 * np.pi * (u * l + v * m)
    return flux * np.cos(phi), flux * np.sin(phi)


def samples(seed=0, n=780):
    rng = np.random.default_rng(seed)
    r, a = rng.uniform(20, 900, n), rng.uniform(0, 2 * np.pi, n)
    return r * np.cos(a), r * np.sin(a)


def test_point_source_peaks_at_its_pixel():
    u, v = samples()
    cell, size = 2e-4, 64
    re, im = source(7 * cell, -5 * cell, 3.0, u, v)
    image, beam = imaging.dirty_image(u, v, re, im, size, cell)
    y, x = np.unravel_index(image.argmax(), image.shape)
    assert (x - size // 2, y - size // 2) == (7, -5)
    assert beam.max() == pytest.approx(1.0)
    assert np.unravel_index(beam.argmax(), beam.shape) == (size // 2, size // 2)
    assert image.max() == pytest.approx(3.0, rel=0.05)


@pytest.mark.parametrize("uniform", [False, True])
def test_image_agrees_with_the_direct_sum(uniform):
    """Samples in the middle of their cells, where the kernel is symmetric: the image is the sum over samples."""
    rng = np.random.default_rng(4)
    cell, size = 2e-4, 64
    du = 1 / (2 * size * cell)
    cells = np.unique(rng.integers(-8, 9, (120, 2)) * 7, axis=0)
    cells = cells[(cells[:, 0] > 3)]
    u, v = (cells[:, 0] + 0.5) * du, (cells[:, 1] + 0.5) * du
    re, im = rng.normal(size=(2, len(u)))
    image, beam = imaging.dirty_image(u, v, re, im, size, cell, uniform)
    y, x = np.mgrid[0:size, 0:size] - size // 2
    phase = 2 * np.pi * cell * (u[:, None, None] * x + v[:, None, None] * y)
    direct, psf = np.mean(re[:, None, None] * np.cos(phase) + im[:, None, None] * np.sin(phase), 0), np.cos(phase).mean(0)
    middle = slice(size // 4, 3 * size // 4)
    assert np.corrcoef(image[middle, middle].ravel(), direct[middle, middle].ravel())[0, 1] > 0.98
    assert np.abs(beam - psf)[middle, middle].max() < 0.15
    assert np.unravel_index(beam.argmax(), beam.shape) == (size // 2, size // 2)


def test_kernel_values():
    """The spheroidal function is 1 in its middle and falls steadily to its end."""
    w = imaging.spheroid(np.linspace(0, 1, 50))
    assert w[0] == pytest.approx(1.0, abs=1e-3) and (np.diff(w) < 0).all() and 0 < w[-1] < 0.01
    assert np.allclose(imaging.spheroid(0.75 - 1e-9), imaging.spheroid(0.75 + 1e-9), atol=1e-4)
    assert len(imaging.KERNEL) == 3 and 1 > imaging.KERNEL[0] > imaging.KERNEL[1] > imaging.KERNEL[2] > 0


def test_levels_of_a_mixture():
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(300, 15, 8000), rng.normal(900, 40, 4000), rng.normal(1500, 30, 1000)])
    bins, counts = np.unique(values.astype(int), return_counts=True)
    found = imaging.levels(bins, counts.astype(float), 3)
    assert found[:, 0] == pytest.approx([300, 900, 1500], abs=5)
    assert found[:, 1] == pytest.approx([15, 40, 30], rel=0.1) and found[:, 2] == pytest.approx([8 / 13, 4 / 13, 1 / 13], abs=0.01)
    assert imaging.levels(np.array([5]), np.array([3.0]), 1)[0, 0] == 5


def test_hybrid_is_on_a_disk_and_trimmed(spark):
    n = 9
    a = [(0, x, y, 10.0 if (x, y) == (4, 4) else -2.0 if (x, y) == (0, 4) else 0.0) for x in range(n) for y in range(n)]
    df = spark.createDataFrame(a, "image_key int, x int, y int, value double")
    got = {(r["x"], r["y"]): r["value"] for r in imaging.hybrid(df, df, 4.0, 3.0, 0.1).collect()}
    assert got[4, 4] == pytest.approx(12 + 1.2) and got[4, 6] == pytest.approx(2 + 1.2)
    assert got[0, 4] == 0.0 and got[0, 0] == 0.0


def test_polynomials(spark):
    rng = np.random.default_rng(0)
    rows = [(g, float(x), float(1.0 + g - 2.0 * x + 0.25 * x * x)) for g in range(3) for x in rng.uniform(1000, 1010, 40)] + [(9, 5.0, 7.0), (8, 1.0, None)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    fits = vistable.polynomials(df, ["g"], "x", ["y"], 2)
    rest = df.join(fits, "g").select("g", (F.col("y") - vistable.fitted("x", "y", 2)).alias("rest")).where("rest IS NOT NULL").collect()
    assert len(rest) == 121 and max(abs(r["rest"]) for r in rest) < 1e-5
    out = flagging.crop(df.withColumn("y", F.when((F.col("g") == 1) & (F.col("x") > 1009.5), F.col("y") + 500).otherwise(F.col("y"))), ["g"], "x", "y", 2.0, order=2, pieces=2)
    hit = {(r["g"], r["x"]) for r in out.where("flag").collect()}
    assert {x for g, x in hit if g == 1} & {x for g, x, _ in rows if g == 1 and x > 1009.5}


def test_frames_are_numbered_and_sampled_over_buckets(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(t)) for k in range(2) for t in np.unique(np.concatenate([rng.integers(0, 4_000, 150), rng.integers(9_000, 9_500, 60), rng.integers(0, 60_000, 40)]))]
    df = spark.createDataFrame(rows, "k int, t_us long")
    n = {(r["k"], r["t_us"]): r["n"] for r in integrate.number_frames(df, ["k"], "t_us", width=1000).collect()}
    picked = sorted((r["k"], r["t_us"]) for r in integrate.sample_chain(df, ["k"], 700, width=1000).collect())
    want = []
    for k in range(2):
        times = sorted(t for g, t in rows if g == k)
        assert [n[k, t] for t in times] == list(range(1, len(times) + 1))
        due = 0
        for t in times:
            if t >= due:
                want.append((k, t))
                due = t + 700
    assert picked == want


def test_bracket_over_buckets(spark):
    import datetime

    day = lambda d: datetime.datetime(2020, 1, 1) + datetime.timedelta(days=d)
    p = spark.createDataFrame([(1, day(d), i, float(d)) for i, d in enumerate((10, 40, 200))], "freq int, ref_time timestamp_ntz, id long, value double")
    probe = spark.createDataFrame([(1, day(d)) for d in (5, 10, 11, 100, 200, 300)] + [(2, day(3))], "freq int, t timestamp_ntz")
    got = {(r["freq"], r["t"]): (r["previous"], r["next"]) for r in params.bracket(probe, p, "freq").collect()}
    assert [got[1, day(d)] for d in (5, 10, 11, 100, 200, 300)] == [(None, 10.0), (10.0, 10.0), (10.0, 40.0), (40.0, 200.0), (200.0, 200.0), (200.0, None)]
    assert got[2, day(3)] == (None, None)


def test_late_frames_leave_the_newer_pair_alone():
    """A pair without its right frame is told, also where a frame of an older pair comes after it."""
    import pandas as pd

    class State:
        hasTimedOut, exists, get = False, False, None

        def update(self, x):
            self.exists, self.get = True, x

        def setTimeoutTimestamp(self, t):
            pass

    state, run = State(), streams._pairs(3125)
    rows = lambda *x: iter([pd.DataFrame([(pd.Timestamp(t, unit="us"), t, p) for t, p in x], columns=["t", "t_us", "pol"])])
    told = [tuple(r) for b in (rows((6250 * 2, 0)), rows((6250 + 3125, 1)), rows((6250 * 3, 0), (6250 * 3 + 3125, 1))) for out in run((0,), b, state) for r in out.to_numpy().tolist()]
    assert told == [(0, 2, streams.LATE), (0, 3, 2)]


def test_clean_recovers_two_sources():
    u, v = samples(1)
    cell, size = 2e-4, 64
    a, b = source(6 * cell, 4 * cell, 5.0, u, v), source(-9 * cell, -3 * cell, 1.0, u, v)
    image, beam = imaging.dirty_image(u, v, a[0] + b[0], a[1] + b[1], size, cell)
    rest, parts = imaging.hogbom(image, beam, gain=0.1, threshold=0.05, steps=1000)
    assert np.abs(rest).max() < 0.5 * np.abs(image).max()
    near = lambda x, y: sum(f for py, px, f in parts if abs(px - 32 - x) <= 1 and abs(py - 32 - y) <= 1)
    assert near(6, 4) == pytest.approx(5.0, rel=0.2)
    assert near(-9, -3) == pytest.approx(1.0, rel=0.5)
    final = imaging.restore(rest, parts, imaging.fit_beam(beam))
    assert np.unravel_index(final.argmax(), final.shape) == (36, 38)


def test_steer_lowers_the_residual():
    u, v = samples(2)
    re, im = source(0.0, 0.0, 2.0, u, v)
    image, beam = imaging.dirty_image(u, v, re, im, 64, 2e-4)
    rest, model = imaging.steer(image, beam)
    assert rest.max() < 0.2 * image.max()
    assert model.sum() > 0


def test_disk_offset():
    y, x = np.mgrid[0:64, 0:64] - 32
    image = ((x - 5) ** 2 + (y + 3) ** 2 <= 100).astype(float)
    assert imaging.disk_offset(image, 10.0) == (5, -3)


def test_refined_peak():
    x = np.arange(60)
    assert imaging.refine_peaks(np.exp(-((x - 30.3) ** 2) / 18), [30]) == [pytest.approx(30.3, abs=1e-6)]


def test_batch_clean_has_the_bands_images_and_all_steps(spark, sf, monkeypatch):
    """Images of 256 x 256 in the lowest band, with its cell, cleaned for 200 steps."""
    from visloom.plans import fixtures as fx
    from visloom.plans import tools

    some = tools._banded(spark, sf).where("sub_band = 0 AND chan = 3").cache()
    monkeypatch.setattr(tools, "_banded", lambda *_: some)
    got = {r["image_key"]: r for r in tools.i14(spark, sf).collect()}
    b = fx.baselines(spark, sf).select("bl", "be", "bn")
    samples = some.groupBy("pol", "bl").agg(F.avg("re").alias("re"), F.avg("im").alias("im")).join(b, "bl").toPandas()
    assert len(got) == samples["pol"].nunique() > 0
    for pol, s in samples.groupby("pol"):
        wave = 299792458.0 / 475e6
        image, beam = imaging.dirty_image(s["be"].to_numpy() / wave, s["bn"].to_numpy() / wave, s["re"].to_numpy(), s["im"].to_numpy(), 256, wave / 9000)
        rest, parts = imaging.hogbom(image, beam, steps=200)
        clean = imaging.restore(rest, parts, imaging.fit_beam(beam))
        r = got[f"0-{pol}-3"]
        assert r["high"] == pytest.approx(clean.max(), rel=1e-4) and r["low"] == pytest.approx(clean.min(), rel=1e-4)
        assert clean[r["y"], r["x"]] == pytest.approx(clean.max(), rel=1e-4)


def test_quantiles(spark):
    rng = np.random.default_rng(6)
    groups = {0: rng.normal(size=501), 1: rng.integers(0, 4, 200) * 1.5, 2: np.array([7.0]), 3: np.full(50, 2.0), 4: np.append(rng.normal(size=99), 1e9)}
    df = spark.createDataFrame([(g, float(x)) for g, some in groups.items() for x in some] + [(1, None), (5, None)], "g int, x double")
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r["g"]: r for r in vistable.quantiles(df, ["g"], "x", shares, bins=7).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    for g, some in groups.items():
        assert [got[g][n] for n in shares] == pytest.approx([np.quantile(some, p) for p in shares.values()])


def test_spectrum_moments(spark):
    x = np.arange(60)
    y = 5 + 10 * np.exp(-((x - 22) ** 2) / 18)
    df = spark.createDataFrame([(k, int(i), float(s * v)) for k, s in enumerate((1, -1)) for i, v in zip(x, y, strict=True)], "k int, i int, v double")
    for r in imaging.spectrum_moments(df, ["k"], "i", "v").collect():
        sign = 1 if r["k"] == 0 else -1
        assert (r["height"], r["amplitude"], r["centre"]) == pytest.approx((sign * 5, sign * 10, 22), abs=0.05)
        assert r["width"] == pytest.approx(0.5 * np.sqrt(2 * np.pi) * 3, rel=0.1)


def test_visibility_files(spark, tmp_path):
    """Groups come back from a file; old and wide baseline ids, files of another kind, one cut short."""
    from visloom.sources import uvfiles

    rng = np.random.default_rng(8)
    data = rng.integers(-1000, 1000, (5, 6)) / 8.0
    p = {"UU": np.arange(5) / 4, "VV": -np.arange(5) / 8, "WW": np.zeros(5), "BASELINE": np.array([258.0, 40 * 256 + 41, 65536 + 2048 * 3 + 300, 257.0, 513.0]), "DATE": 2457388.5 + np.arange(5) / 16, "FREQSEL": np.full(5, 3.0)}
    whole = uvfiles.encode(p, data)
    (tmp_path / "a.uvfits").write_bytes(whole)
    (tmp_path / "b.txt").write_bytes(b"SIMPLE  = T")
    (tmp_path / "c.cut").write_bytes(whole[: uvfiles.cards(whole)[1] + 4 * 13 * 2 + 7])
    files = spark.read.format("binaryFile").load(str(tmp_path)).select(F.regexp_extract("path", "[^/]*$", 0).alias("path"), "content")
    rows = uvfiles.read_groups(files).orderBy("path", "row").collect()
    assert [(r["path"], r["row"]) for r in rows] == [("a.uvfits", i) for i in range(5)] + [("c.cut", i) for i in range(2)]
    assert [(r["ant1"], r["ant2"]) for r in rows[:5]] == [(1, 2), (40, 41), (3, 300), (1, 1), (2, 1)]
    assert [r["data"] for r in rows[:5]] == data.tolist()
    assert [r["date"] for r in rows[:5]] == p["DATE"].tolist() and [r["uu"] for r in rows[:5]] == p["UU"].tolist()
    assert (rows[0]["source"], rows[0]["freqid"], rows[0]["inttim"]) == (1, 3, 1.0)
