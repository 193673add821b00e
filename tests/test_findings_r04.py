"""What the findings of round 4 named, each at the smallest size that shows it."""

import random
import time

import duckdb
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from visloom.operators import imaging, integrate
from visloom.plans.scalars import away
from visloom.streaming import frames as streams


def _sides_as_wide(n=24, count=60):
    """Series of n values, half of them above the mean, whose places above and below are spread alike; the heights differ."""
    rng, out, half = random.Random(4), [], n // 2
    while len(out) < count:
        above = sorted(rng.sample(range(n), half))
        below = [i for i in range(n) if i not in above]
        if half * sum(i * i for i in above) - sum(above) ** 2 == half * sum(i * i for i in below) - sum(below) ** 2:
            out.append([100 + i % 5 if i in above else -100 - i % 7 for i in range(n)])
    return out


def test_moments_of_sides_as_wide(spark):
    """Where neither side is narrower the peak is the lower one, in whatever order and parts rows come."""
    series = _sides_as_wide()
    rows = [(k, i, float(v)) for k, s in enumerate(series) for i, v in enumerate(s)]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        got = imaging.spectrum_moments(spark.createDataFrame(rows, "k int, i int, v double").repartition(5), ["k"], "i", "v").collect()
        assert len(got) == len(series) and all(r["amplitude"] < 0 for r in got)


def test_moments_without_amplitude(spark):
    """Of a series without a peak the width is what SQL makes of a quotient by 0."""
    rows = [(k, i, v) for k, s in enumerate(([3.0] * 5, [3.0, 2.0, 2.0, 2.0, 3.0], [7.0])) for i, v in enumerate(s)]
    got = {r["k"]: (r["amplitude"], str(r["width"])) for r in imaging.spectrum_moments(spark.createDataFrame(rows, "k int, i int, v double"), ["k"], "i", "v").collect()}
    assert got == {0: (0.0, "nan"), 1: (0.0, "inf"), 2: (0.0, "nan")}


def test_rounded_as_sql(spark):
    x = [4.98875, -4.98875, 3.00125, 0.00005, -0.0, 1e300, float("inf"), float("nan"), 2.00015] + [s * n / 1600 for n in range(1, 400, 3) for s in (1, -1)]
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, 4) + 0.0", [v]).fetchone()[0] for v in x]
    got = [r["y"] for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double").select("i", away(F.col("x"), 4).alias("y")).orderBy("i").collect()]
    assert list(map(str, got)) == list(map(str, want))


def test_last_pair_of_a_minute(spark, tmp_path):
    """A minute's last pair is told neither at the stream's end nor when the stream has passed the minute; what lacks a frame before it is."""
    step, minute = 3125, 60_000_000
    held = [m * minute + n * step for m in (0, 1, 2, 5) for n in (0, 1, 2, 5, 6)]
    df = spark.createDataFrame([(t, t // step % 2) for t in held], "t_us long, pol int")
    df.write.parquet(str(tmp_path / "in"))
    stream = streams.frame_stream(spark, str(tmp_path / "in"), "t_us long, pol int")
    got = streams.drain(streams.pair_polarizations(stream, "1 second", step), str(tmp_path / "out")).collect()
    want = [(m, m * minute // step // 2 + k, error) for m in (0, 1, 2, 5) for k, error in ((2, 2), (3, 1))]
    assert sorted(tuple(r) for r in got) == want


def test_many_ranges_over_many_samples(spark, monkeypatch):
    """Samples aren't compared with ranges one by one: 150000 of each, all at once in time, of which hardly any meet."""
    monkeypatch.setattr(integrate, "SAMPLES", 4000)
    n = 150_000
    k = F.col("id")
    v = spark.range(n).select((k % 2).cast("int").alias("source"), F.lit(1).alias("ant1"), F.lit(2).alias("ant2"), F.lit(0).alias("band"), (k * 4 + 1).cast("int").alias("chan"), F.timestamp_seconds(1000 + k % 50).alias("obs_ts"), k.alias("row"))
    f = spark.range(n).select(F.when(k % 2 == 0, 0).alias("source"), F.lit(2).alias("ant_a"), F.when(k % 3 > 0, 1).alias("ant_b"), F.lit(None).cast("int").alias("band"), F.timestamp_seconds(900 + k % 7).alias("t0"), F.timestamp_seconds(1100 + k % 7).alias("t1"), (k * 4 + F.when(k % 1000 == 0, 1).otherwise(2)).cast("int").alias("c0"), (k * 4 + 3).cast("int").alias("c1"))
    begin = time.perf_counter()
    got = sorted(r["row"] for r in integrate.flagged_by_ranges(v, f).select("row").collect())
    assert got == list(range(0, n, 1000))
    assert time.perf_counter() - begin < 80


class _State:
    """A map, a value and timers that count how often they are called."""

    def __init__(self):
        self.calls, self.map, self.value, self.timers = 0, {}, None, set()

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name in ("getMapState", "getValueState"):
                return self
            return {
                "getValue": lambda k: self.map.get(k), "containsKey": lambda k: k in self.map, "updateValue": lambda k, v: self.map.update({k: v}), "removeKey": lambda k: self.map.pop(k),
                "iterator": lambda: iter(list(self.map.items())), "keys": lambda: iter(list(self.map)), "exists": lambda: self.value is not None, "get": lambda: self.value,
                "update": lambda v: setattr(self, "value", v), "registerTimer": lambda t: self.timers.add(t), "getCurrentWatermarkInMs": lambda: 1 << 60,
            }[name](*args)

        return call


def test_pairs_cost_few_calls_to_the_state():
    """20000 pairs in seven lots, out of order and with frames that lack, are told in order with a call to the state for many of them."""
    step, n = 3125, 40_000
    slots = [k for k in range(n) if k % 11 and k % 501 > 3]
    random.Random(5).shuffle(slots)
    state = _State()
    pairs = streams.ArrayPairs(step, 8000, 1_000_000)
    pairs.init(state)
    for lot in (slots[i::7] for i in range(7)):
        list(pairs.handleInputRows((1,), iter([pd.DataFrame({"t_us": [k * step for k in some], "pol": [k % 2 for k in some]}) for some in (lot[:700], lot[700:])]), state))
    told = pd.concat(list(pairs.handleExpiredTimer((1,), state, None)))
    want, before = [], None
    for source in sorted({k // 2 + 1 for k in slots}):
        own = [k for k in (source * 2 - 2, source * 2 - 1) if k % 11 and k % 501 > 3]
        want.append((1, source, 1 if own[0] % 2 else 2 if len(own) == 1 else 3 if before is not None and (own[0] - before) * step > 8000 else 0))
        before = own[0]
    assert list(told.itertuples(index=False, name=None)) == want and not state.map
    assert state.calls < 4000


def test_exports_are_written_by_spark(spark, tmp_path):
    """No row of an export passes through Python, which took nine tenths of its time; a list names all files of all tables."""
    from visloom.sources.exports import read_export, write_export

    rows = spark.range(1000).select("id", F.array("id", F.lit(None).cast("long")).alias("data")).repartition(3)
    for lot in (rows.where("id < 10"), rows):
        write_export({"groups": lot, "none": rows.limit(0)}, str(tmp_path))
    held = read_export(spark, str(tmp_path))
    assert held["groups"].agg(F.count("*"), F.sum("id")).first() == (1000, 499_500) and held["none"].count() == 0
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "groups").rglob("*.parquet")]
    assert sum(f.num_rows for f in files) == 1010 and all(f.created_by.startswith("parquet-mr") for f in files)


@pytest.mark.parametrize("array", [1, 2])
def test_sums_of_decoded_frames(spark, sf, array):
    """Sums by task are those of the decoded rows; tasks share the frames and hand on a row a baseline and channel."""
    from visloom.plans import products
    from visloom.sources import rawframes as raw

    records = products.raw_records(spark, sf, array, parts=3)
    rows = raw.decode_table(products.raw_records(spark, sf, array), array, "vis")
    want = rows.groupBy("ant1", "ant2", "chan").agg(F.count("*"), F.sum("re"), F.sum("im"), F.max("re")).collect()
    got = raw.decode_sums(records, array)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want)) and len(want) > 10_000
    assert raw.decode_sums(records.where("frame_no < 0"), array).count() == 0
    assert records.rdd.getNumPartitions() == 3


def test_versions_are_put_back_in_one_pass(spark, sf, tmp_path):
    """Several ways of restoring are those of one at a time, and rows and versions are read and dealt out once for all of them."""
    import __spark_entry__ as entry
    from visloom.sources.flagversions import MERGES, FlagVersions

    r = random.Random(8)
    flags = lambda n: spark.createDataFrame([(r.randrange(9), r.choice([None, 0, 1]), r.randrange(7), r.randrange(16), r.choice([None, True, False])) for _ in range(n)], "frame_id long, sub_band int, bl int, chan int, flag boolean")
    store = FlagVersions(spark, str(tmp_path))
    store.save(flags(400), "a")
    store.save(flags(300), "b")
    now = flags(500).withColumn("row", F.monotonically_increasing_id()).cache()
    ways = {f"x{i}": w for i, w in enumerate([(m, n) for m in MERGES for n in (("a",), ("a", "b"), ("b", "a"), ())])}
    got = {x["row"]: x for x in store.restore_all(now, ways).collect()}
    for name, (how, names) in ways.items():
        assert all(got[x["row"]][name] == x["flag"] for x in store.restore(now, *names, merge=how).collect())
    plan = entry.queries()["d08_flag_store"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 10
