"""Raw frames as a stream: files that grow, restarts in the middle of one, pairs by array."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.sources import rawframes as raw
from visloom.streaming import frames as st


def records(first, count):
    """Frames of the first array that differ in time, modes and values."""
    n = np.arange(first, first + count)
    outs = raw.OUTPUTS[1]
    header = {k: n * 0 for k in ("frequency_switch", "bandwidth", "quantization", "delay_switch", "strip_switch", "target", "array_tag")}
    header |= {"packed_time": raw.packed_times(n), "sub_band_switch": n * 0 + 0xEEEE3333, "loop_code": n % 8}
    vis = (n[:, None, None] * 100 + np.arange(outs * (outs - 1) // 2)[None, :, None] % 97 + np.arange(16)) * (1 + 2j)
    return raw.encode(n, 1, header, vis, np.zeros((count, outs, 16)), np.zeros((count, outs)))


def test_clock():
    n = np.array([0, 1, 320, 86_400 * 320 - 1])
    assert (raw.clock_us(raw.packed_times(n)) - st.DAY).tolist() == (n * 3125).tolist()


def test_offsets_close_full_and_overtaken_files(tmp_path):
    reader = raw.RawFrameSource({"path": str(tmp_path), "array": "1", "full": "3"}).streamReader(None)
    assert reader.latestOffset() == reader.initialOffset()
    (tmp_path / "day").mkdir()
    size = raw.LENGTH[1]
    put = lambda name, n: (tmp_path / name).write_bytes(b"\0" * n)
    put("day/a", 2 * size + 17)
    put("_writing", size)
    first = reader.latestOffset()
    assert first == {"done": "", "open": {"day/a": 2}}
    put("day/a", 3 * size)
    put("day/b", size)
    second = reader.latestOffset()
    assert second == {"done": "day/a", "open": {"day/b": 1}}
    cut = lambda a, b: [(r.path.rpartition("/")[2], r.first, r.count) for r in reader.partitions(a, b)]
    assert cut(first, second) == [("a", 2, 1), ("b", 0, 1)]
    assert cut(reader.initialOffset(), first) == [("a", 0, 2)]
    put("day/c", size)
    put("day/d", size)
    third = reader.latestOffset()
    assert third == {"done": "day/b", "open": {"day/c": 1, "day/d": 1}}
    assert cut(second, third) == [("c", 0, 1), ("d", 0, 1)]
    assert cut(second, second) == cut(third, third) == []
    put("day/d", 2 * size)
    assert cut(second, third) == [("c", 0, 1), ("d", 0, 1)], "a batch that runs again reads the same records"


@pytest.mark.parametrize("table", ["headers", "samples"])
def test_restart_in_the_middle_of_a_file_loses_and_repeats_nothing(spark, tmp_path, table):
    files = tmp_path / "files"
    files.mkdir()
    stream = lambda: st.raw_stream(spark, f"file://{files}", 1, table, full=6, frames=4)
    a, b = records(0, 6).tobytes(), records(6, 5).tobytes()
    rows = []
    for name, content in (("0", a[: 250_000]), ("0", a), ("1", b[: 100_000]), ("1", b), ("1", b)):
        (files / name).write_bytes(content)
        rows.append(st.catch_up(stream(), str(tmp_path / "out")).count())
    spark.dataSource.register(raw.RawFrameSource)
    batch = spark.read.format("rawframes").option("path", str(files)).option("array", 1).option("table", table).load()
    per = 12_480 if table == "samples" else 1
    assert rows == [2 * per, 6 * per, 7 * per, 11 * per, 11 * per]
    got = spark.read.parquet(str(tmp_path / "out" / "rows"))
    shared = [c for c in batch.columns if c != "t_us"]
    key = lambda d: d.select(*shared).groupBy(*shared).count().exceptAll
    assert key(got)(batch.select(*shared).groupBy(*shared).count()).count() == 0
    assert got.agg(F.countDistinct("t_us")).first()[0] == 11


def test_pairs_of_late_repeated_and_missing_frames_across_a_minute(spark, tmp_path):
    """Frames come in two lots, out of order and some twice; a pair begins before a minute's end and ends after it."""
    step, minute = 3125, 60_000_000 // 3125
    slots = [s for s in range(minute - 40, minute + 900) if s not in (minute - 11, minute + 6, minute + 7, minute + 31)]
    rows = [(1, s * step, s % 2) for s in slots]
    lots = [rows[:60:2] + rows[:20], rows[1:60:2] + rows[60:], [(1, 0, 0)]]
    schema = "sub_array int, t_us long, pol int"
    for i, lot in enumerate(lots):
        spark.createDataFrame(lot, schema).write.mode("append").parquet(str(tmp_path / "frames"))
        stream = st.frame_stream(spark, str(tmp_path / "frames"), schema)
        got = st.drain(st.pair_by_array(stream, "1 second", step, 8000), str(tmp_path / "out"))
    got = {r["source_id"]: r["error"] for r in got.collect()}
    want, before = {}, None
    for source in sorted({s // 2 + 1 for s in slots}):
        own = [s for s in slots if s // 2 + 1 == source]
        jump = before is not None and (own[0] - before) * step > 8000
        want[source] = 1 if own[0] % 2 else 2 if len(own) == 1 else 3 if jump else 0
        before = own[0]
    assert got == {k: v for k, v in want.items() if k in got}
    assert len(got) > 150 and max(got) < max(want)
    assert {got[(minute - 11) // 2 + 1], got[(minute + 6) // 2 + 2], got[(minute + 31) // 2 + 1]} == {2, 3} and 0 not in got
