"""Visibility-shaped views of the given tables, for the registered queries, and the same views as SQL.

Every view is derived row by row from a given table, so that a query's work grows with it. Values are
chosen so that sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visloom.operators.geometry import baseline_index, spiral_antennas, unique_baselines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regular 3.125 ms clock with an 8-frame cycle of bands and polarizations; an event of type error is no frame, which makes holes."""
    e = table(spark, sf_dir, "events").where("event_type <> 'error'")
    return e.select(
        F.col("event_id").alias("frame_id"), (F.col("event_id") * 3125).alias("t_us"), F.floor(F.col("event_id") % 8 / 2).cast("int").alias("sub_band"),
        (F.col("event_id") % 2).cast("int").alias("pol"), F.col("ts").alias("wall_ts"), "value", (F.col("event_id") % 3 + 1).cast("int").alias("sub_array"),
    )


def vis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visibility sample per order line; keys repeat."""
    x = table(spark, sf_dir, "lineitem").where("l_suppkey % 40 <> l_partkey % 40")
    return x.select(
        F.col("l_orderkey").alias("frame_id"), F.least(F.col("l_suppkey") % 40, F.col("l_partkey") % 40).cast("int").alias("ant1"), F.greatest(F.col("l_suppkey") % 40, F.col("l_partkey") % 40).cast("int").alias("ant2"),
        (F.floor("l_extendedprice").cast("long") % 16).cast("int").alias("chan"), (F.col("l_quantity") - 25.5).alias("re"), (F.round(F.col("l_discount") * 100) - 4.5).alias("im"),
        F.col("l_shipdate").alias("obs_ts"), F.col("l_returnflag").alias("scan"),
    )


def visu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vis with unique keys, and the baseline's index."""
    u = vis(spark, sf_dir).groupBy("frame_id", "ant1", "ant2", "chan").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    return u.withColumn("bl", baseline_index(F.col("ant1"), F.col("ant2"), 40))


def cal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phase-only calibration of every band, polarization, baseline and channel that has visibilities."""
    keys = vis(spark, sf_dir).select(baseline_index(F.col("ant1"), F.col("ant2"), 40).alias("bl"), "chan").distinct()
    grid = keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("sub_band")).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("pol"))
    ph = (F.col("bl") * 7 + F.col("chan") * 13 + F.col("sub_band") * 5 + F.col("pol") * 3) % 628 / 100.0 - 3.14
    return grid.select("sub_band", "pol", "bl", "chan", F.cos(ph).alias("re"), F.sin(ph).alias("im"))


def antennas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Antennas that occur in the visibilities, on a log spiral (metres east, north, up)."""
    v = vis(spark, sf_dir)
    return spiral_antennas(v.select(F.col("ant1").alias("ant")).union(v.select("ant2")).distinct())


def baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_baselines(antennas(spark, sf_dir), 40)


def with_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """visu with u and v in metres, of baselines that turn with the frames."""
    a = F.col("frame_id") * 0.001
    b = baselines(spark, sf_dir).select("bl", "be", "bn")
    v = visu(spark, sf_dir).join(b, "bl")
    return v.withColumn("u", F.col("be") * F.cos(a) + F.col("bn") * F.sin(a)).withColumn("v", F.col("bn") * F.cos(a) - F.col("be") * F.sin(a)).drop("be", "bn")


def params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated values of two receivers."""
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 2 + 1).cast("int").alias("freq"), F.col("o_orderdate").alias("ref_time"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"))


def probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 2 + 1).cast("int").alias("freq"), F.col("l_shipdate").alias("t"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An 8 x 8 image of each vector."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_key"), "label", F.posexplode("embedding").alias("i", "v"))
    return e.select("image_key", "label", (F.col("i") % 8).cast("int").alias("x"), F.floor(F.col("i") / 8).cast("int").alias("y"), F.round(F.col("v").cast("double") * 1000).alias("value"))


BAD = {"2015-11-01": (8, 9, 10, 11, 12, 13, 19, 21, 22, 23, 24, 25, 26, 28, 29, 30, 31, 34, 35, 36, 37, 38, 39), "2014-11-11": (4, 7, 10, 11, 12, 13, 16, 17, 18, 19, 24, 25, 26, 36, 38, 39)}  # fixed values


def bad_antennas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(day, a) for day, some in BAD.items() for a in some], "obs_day string, ant int")


VIEWS = {
    "frames": """SELECT event_id AS frame_id, event_id * 3125 AS t_us, CAST(floor((event_id % 8) / 2) AS INT) AS sub_band, CAST(event_id % 2 AS INT) AS pol,
  ts AS wall_ts, value, CAST(event_id % 3 + 1 AS INT) AS sub_array FROM events WHERE event_type <> 'error'""",
    "vis": """SELECT l_orderkey AS frame_id, CAST(least(l_suppkey % 40, l_partkey % 40) AS INT) AS ant1, CAST(greatest(l_suppkey % 40, l_partkey % 40) AS INT) AS ant2,
  CAST(CAST(floor(l_extendedprice) AS BIGINT) % 16 AS INT) AS chan, l_quantity - 25.5 AS re, round(l_discount * 100) - 4.5 AS im, l_shipdate AS obs_ts, l_returnflag AS scan
  FROM lineitem WHERE l_suppkey % 40 <> l_partkey % 40""",
    "visu": """SELECT *, CAST(ant1 * 40 - floor(ant1 * (ant1 + 1) / 2) + (ant2 - ant1 - 1) AS INT) AS bl FROM (SELECT frame_id, ant1, ant2, chan, avg(re) AS re, avg(im) AS im FROM vis GROUP BY 1, 2, 3, 4)""",
    "cal": """SELECT sub_band, pol, bl, chan, cos(ph) AS re, sin(ph) AS im FROM (SELECT *, ((bl * 7 + chan * 13 + sub_band * 5 + pol * 3) % 628) / 100.0 - 3.14 AS ph FROM
  (SELECT DISTINCT CAST(ant1 * 40 - floor(ant1 * (ant1 + 1) / 2) + (ant2 - ant1 - 1) AS INT) AS bl, chan FROM vis), (SELECT CAST(range AS INT) AS sub_band FROM range(4)), (SELECT CAST(range AS INT) AS pol FROM range(2)))""",
    "antennas": """SELECT ant, 8.0 * power(1.1, ant) * cos(2.1 * ant) AS e, 8.0 * power(1.1, ant) * sin(2.1 * ant) AS n, 0.0 AS u FROM (SELECT ant1 AS ant FROM vis UNION SELECT ant2 FROM vis)""",
    "baselines": """SELECT a.ant AS ant1, b.ant AS ant2, CAST(a.ant * 40 - floor(a.ant * (a.ant + 1) / 2) + (b.ant - a.ant - 1) AS INT) AS bl, CAST((a.ant + 1) * 256 + b.ant + 1 AS INT) AS baseline_id,
  b.e - a.e AS be, b.n - a.n AS bn, b.u - a.u AS bu FROM antennas a JOIN antennas b ON a.ant < b.ant""",
    "params": "SELECT CAST(o_custkey % 2 + 1 AS INT) AS freq, o_orderdate AS ref_time, o_orderkey AS id, o_totalprice AS value FROM orders",
    "probe": "SELECT CAST(l_suppkey % 2 + 1 AS INT) AS freq, l_shipdate AS t FROM lineitem",
    "pixels": """SELECT vec_id AS image_key, label, CAST((i - 1) % 8 AS INT) AS x, CAST(floor((i - 1) / 8) AS INT) AS y, round(CAST(embedding[i] AS DOUBLE) * 1000) AS value
  FROM embeddings, (SELECT range + 1 AS i FROM range(64))""",
    "uv": """SELECT v.*, b.be * cos(v.frame_id * 0.001) + b.bn * sin(v.frame_id * 0.001) AS u, b.bn * cos(v.frame_id * 0.001) - b.be * sin(v.frame_id * 0.001) AS v FROM visu v JOIN baselines b USING (bl, ant1, ant2)""",
    "bad": "SELECT * FROM (VALUES " + ", ".join(f"('{d}', {a})" for d, some in BAD.items() for a in some) + ") AS t(obs_day, ant)",
}
NEEDS = {"uv": ["vis", "visu", "antennas", "baselines"], "visu": ["vis"], "cal": ["vis"], "antennas": ["vis"], "baselines": ["vis", "antennas"]}


def with_views(body: str, *names: str) -> str:
    """SQL with the views it names, and those they need, in front."""
    order: list[str] = []
    for name in names:
        for x in [*NEEDS.get(name, []), name]:
            if x not in order:
                order.append(x)
    views = ", ".join(f"{x} AS ({VIEWS[x]})" for x in order)
    if body.lstrip().upper().startswith("WITH"):
        return f"WITH {views}, {body.lstrip()[4:]}"
    return f"WITH {views} {body}"
