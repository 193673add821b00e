"""Flag versions: the four operations against sets, and saves that break off."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from visloom.sources.flagversions import FlagVersions, merged, pack

SCHEMA = "frame_id long, sub_band int, bl int, chan int, flag boolean"


def rows(seed, share, n=600):
    r = random.Random(seed)
    keys = {(r.randrange(5), r.randrange(2), r.choice([0, 3, 4, 5, 1769]), r.randrange(16)) for _ in range(n)}
    return {k: r.random() < 0.4 for k in keys if r.random() < share}


def frame(spark, flags):
    return spark.createDataFrame([(*k, v) for k, v in flags.items()], SCHEMA)


def back(df):
    return {(r["frame_id"], r["sub_band"], r["bl"], r["chan"]): r["flag"] for r in df.collect()}


@pytest.mark.parametrize("how", ["replace", "and", "or"])
def test_restore_and_merged_saves(spark, tmp_path, how):
    now, one, two = rows(1, 0.9), rows(2, 0.5), rows(3, 0.5)
    store = FlagVersions(spark, str(tmp_path / "store"))
    store.save(frame(spark, one), "a", "first")
    put = {"replace": lambda f, s: f if s is None else s, "and": lambda f, s: f and bool(s), "or": lambda f, s: f or bool(s)}[how]
    assert back(store.restore(frame(spark, now), "a", merge=how)) == {k: put(f, one.get(k)) for k, f in now.items()}
    store.save(frame(spark, two), "a", "both", merge=how)
    if how == "replace":
        want = two
    else:
        want = {k: (one[k] and two[k] if how == "and" else one[k] or two[k]) if k in one and k in two else two.get(k, one.get(k)) for k in one | two}
        if how == "and":  # a sample that only the new flags know isn't flagged by the version, and the other way round
            want = {k: two[k] and one.get(k, two[k]) if k in two else False for k in one | two}
    got = {(r["frame_id"], r["sub_band"], r["word"]): (r["known"] % 2**64, r["flagged"] % 2**64) for r in store.words("a").collect()}
    known, flagged = {}, {}
    for (f, s, bl, c), v in want.items():
        at = bl * 16 + c
        key = (f, s, at // 64)
        known[key] = known.get(key, 0) | 1 << at % 64
        flagged[key] = flagged.get(key, 0) | int(v) << at % 64
    if how != "and":
        assert got == {k: (known[k], flagged[k]) for k in known}
    else:
        assert {k: v[0] for k, v in got.items()} == known
    assert store.versions() == [("a", "both")]


def test_a_broken_save_leaves_all_as_it_was(spark, tmp_path):
    store = FlagVersions(spark, str(tmp_path / "store"))
    assert store.versions() == []
    store.save(frame(spark, rows(1, 1)), "a")
    store.save(frame(spark, rows(2, 1)), "b", "two")
    before = store.words("a").count()
    broken = frame(spark, rows(4, 1)).withColumn("flag", F.when(F.col("bl") == 5, F.raise_error(F.lit("lost")).cast("boolean")).otherwise(F.col("flag")))
    with pytest.raises(PySparkException):
        store.save(broken, "a", "broken")
    assert store.versions() == [("a", ""), ("b", "two")] and store.words("a").count() == before
    assert FlagVersions(spark, str(tmp_path / "store")).versions() == store.versions()
    with pytest.raises(KeyError):
        store.delete("b", "none")
    assert len(store.versions()) == 2
    store.sweep()
    (tmp_path / "store" / "words-lost").mkdir()
    assert store.sweep() == 1 and store.sweep() == 0
    store.delete("a")
    assert store.versions() == [("b", "two")]
    with pytest.raises(KeyError):
        store.restore(frame(spark, rows(1, 1)), "a")
    with pytest.raises(ValueError):
        store.restore(frame(spark, rows(1, 1)), "b", merge="xor")


def test_nulls_repeats_and_empty_tables(spark, tmp_path):
    store = FlagVersions(spark, str(tmp_path / "store"))
    odd = [(1, 0, 2, 3, None), (1, 0, 2, 4, True), (1, 0, 2, 4, False), (1, None, 2, 3, True)]
    flags = spark.createDataFrame(odd, SCHEMA)
    store.save(flags, "odd")
    words = {r["sub_band"]: (r["known"], r["flagged"]) for r in store.words("odd").collect()}
    assert words == {0: (1 << 36, 1 << 36), None: (1 << 35, 1 << 35)}
    assert sorted(str(r["flag"]) for r in store.restore(flags, "odd", merge="or").collect()) == ["False", "True", "True", "True"]
    store.save(flags.limit(0), "none")
    assert store.words("none").count() == 0
    assert back(store.restore(frame(spark, rows(1, 1)), "none")) == rows(1, 1)
    assert merged(pack(flags.limit(0)), pack(flags), "or").count() == 2
