"""Raw correlator records: fixed length, decoded with numpy views, many records at a time.

Records are 100000 bytes (first array: 16 channels, 44 receiver outputs of which 40 antennas) or 204800 bytes
(second array: 16 channels, 64 outputs of which 60 antennas). A file of them is split at record bounds, so
partitions hold whole records; nothing is searched for. Only what a table needs is read and decoded, and goes to
Spark as Arrow batches.

Frames before 2015 (universal time) have another header: the first array's loop code is two bytes at 99264, polarizations
alternate, target and array aren't told, and the second array's body begins four bytes earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from visloom.functions.timescale import PACKED, unpack_time

# Layout of the two kinds of records, in bytes.
LENGTH = {1: 100_000, 2: 204_800}
BODY = {1: 2_944, 2: 1_888}
OUTPUTS = {1: 44, 2: 64}
ANTENNAS = {1: 40, 2: 60}
CHANNELS = 16
TIME, SWITCHES, LOOP_CODE, TARGET = 32, 172, {1: 208, 2: 196}, 192

OLD_LOOP_CODE, OLD_BODY = 99_264, 1_884
#: Records of a full file: a minute.
FULL = 19_200
#: Bytes from a record's start that hold its header.
HEAD = 212
#: Codes of the first array's four bands: outside of loop mode, and in it before 2015.
FIXED_LOW, OLD_LOOP_LOW = (0x3333, 0x7777, 0xBBBB, 0xCCCC), (0x0000, 0x5555, 0xAAAA, 0xFFFF)
TARGETS = {0: "sun", 0x0101: "satellite", 0x0202: "swan"}
IF_BANDWIDTH = {0x33333333: 25_000_000, 0x77777777: 12_500_000, 0x88888888: 6_250_000, 0xBBBBBBBB: 3_125_000, 0xCCCCCCCC: 1_562_500}

HEADER = (
    "frame_no long, packed_time long, frequency_switch long, bandwidth long, quantization long, delay_switch long, strip_switch long, sub_band_switch long, target int, array_tag int, loop_code int, "
    "recent boolean, loop boolean, pol int, channel_group int, sub_band int, freq_hz long, freqid int, if_bandwidth long, obs_target string, real_sub_array int"
)
VIS = "frame_no long, bl int, ant1 int, ant2 int, chan int, re double, im double"
AUTO = "frame_no long, ant int, chan int, power double"
DELAY = "frame_no long, ant int, delay_ns double"
SAMPLES = "frame_no long, t_us long, sub_band int, pol int, bl int, ant1 int, ant2 int, chan int, re double, im double"


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two complex values of 12-byte words (..., 12): bytes of each number lie four apart."""
    b = raw.astype(np.int32).reshape(*raw.shape[:-1], 3, 4)
    v = b[..., 0, :] | b[..., 1, :] << 8 | b[..., 2, :] << 16
    v = np.where(v >= 1 << 23, v - (1 << 24), v)
    return v[..., 3] + 1j * v[..., 2], v[..., 1] + 1j * v[..., 0]


def pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _field(packed: np.ndarray, name: str) -> np.ndarray:
    at = 0
    for n, bits in PACKED:
        if n == name:
            return packed >> at & (1 << bits) - 1
        at += bits
    raise KeyError(name)


def clock_us(packed: np.ndarray) -> np.ndarray:
    """Microseconds of packed times since the start of 1970, on their own clock."""
    part = lambda name: _field(packed, name)
    months = (part("year") + 30) * 12 + part("month") - 1
    days = months.astype("M8[M]").astype("M8[D]").astype(np.int64) + part("day") - 1
    return ((((days * 24 + part("hour")) * 60 + part("minute")) * 60 + part("second")) * 1000 + part("ms")) * 1000 + part("us")


def is_recent(packed: np.ndarray) -> np.ndarray:
    """Whether frames are of 2015 or later in universal time, eight hours behind their clock."""
    night = (_field(packed, "month") == 1) & (_field(packed, "day") == 1) & (_field(packed, "hour") < 8)
    return 2000 + _field(packed, "year") - night >= 2015


def headers(head: np.ndarray, old_code: np.ndarray | None, numbers: np.ndarray, array: int) -> dict[str, pa.Array]:
    """Header fields and resolved modes of frames: their first `HEAD` bytes and, of the first array, the two bytes of the old loop code.

    A code that no table knows leaves band, frequency and, in loop mode, polarization null.
    """
    u32 = lambda at: head[:, at : at + 4].copy().view("<u4")[:, 0].astype(np.int64)
    u16 = lambda at: head[:, at : at + 2].copy().view("<u2")[:, 0].astype(np.int32)
    names = ("bandwidth", "quantization", "delay_switch", "strip_switch", "sub_band_switch")
    code = head[:, LOOP_CODE[array]].astype(np.int32) if array == 1 else u16(LOOP_CODE[array])
    f = {"packed_time": head[:, TIME : TIME + 8].copy().view("<i8")[:, 0], "frequency_switch": u32(40)} | {n: u32(SWITCHES + 4 * i) for i, n in enumerate(names)}
    recent = is_recent(f["packed_time"])
    switch = f["sub_band_switch"]
    pol = np.where(recent, (switch & 0xFFFF) != 0x3333, numbers % 2 == 1).astype(np.int32)
    place = lambda codes, x: np.select([x == c for c in codes], range(len(codes)), -1)
    if array == 1:
        band = place(FIXED_LOW, switch >> 16)
        loop = band < 0
        now = loop & recent
        pol = np.where(now, np.where(code < 8, code % 2, -1), pol)
        old = place(OLD_LOOP_LOW, old_code if old_code is not None else np.full(len(head), -1))
        band = np.where(now, np.where(code < 8, code // 2, -1), np.where(loop, old, band))
        hz = 400_000_000 * (band.astype(np.int64) + 1)
        freqid = band + 1
    else:
        fixed = switch >> 16
        band = np.where((fixed % 0x101 == 0) & (fixed // 0x101 < 33), fixed // 0x101, -1)
        loop = band < 0
        pol = np.where(loop, np.where(code < 66, code % 2, -1), pol)
        band = np.where(loop, np.where(code < 66, code // 2, -1), band)
        hz = np.minimum(2_000_000_000 + 400_000_000 * band.astype(np.int64), 14_600_000_000)
        # The second array's loop mode has one frequency id for all bands.
        freqid = np.where(loop, 1, band + 1)
    lost = band < 0
    some = lambda x, kind, none=lost: pa.array(x, kind, mask=none)
    tag = u16(TARGET + 2)
    width = np.array([IF_BANDWIDTH.get(int(x), -1) for x in f["bandwidth"]], np.int64)
    out = {"frame_no": pa.array(numbers, pa.int64())} | {k: pa.array(v, pa.int64()) for k, v in f.items()}
    out |= {"target": pa.array(u16(TARGET)), "array_tag": pa.array(tag), "loop_code": pa.array(code), "recent": pa.array(recent), "loop": pa.array(loop)}
    out |= {"pol": some(pol, pa.int32(), pol < 0), "channel_group": some(band * 16, pa.int32()), "sub_band": some(band, pa.int32()), "freq_hz": some(hz, pa.int64()), "freqid": some(freqid, pa.int32()), "if_bandwidth": some(width, pa.int64(), width < 0)}
    target = [TARGETS.get(int(t), "other") if r else "sun" for t, r in zip(u16(TARGET), recent, strict=True)]
    real = np.where(recent, np.select([tag == 0, tag == 0x4E4E], [1, 2], -1), array)
    return out | {"obs_target": pa.array(target), "real_sub_array": some(real, pa.int32(), real < 0)}


def _blocks(records: np.ndarray, array: int) -> tuple[np.ndarray, int]:
    """The blocks of records (frames, blocks, bytes), and the bytes of visibilities in each."""
    n, outs = len(records), OUTPUTS[array]
    count = outs * (outs - 1) // 2
    if array == 1:
        size = count * 12 + 40 + outs // 4 * 64 + 32
        return records[:, BODY[1] : BODY[1] + 8 * size].reshape(n, 8, size), count * 12
    size = count * 6 + outs // 8 * 64 + 72
    recent = is_recent(records[:, TIME : TIME + 8].copy().view("<i8")[:, 0])
    if recent.all() or not recent.any():
        at = BODY[2] if recent.all() else OLD_BODY
        return records[:, at : at + CHANNELS * size].reshape(n, CHANNELS, size), count * 6
    rows = [r[a : a + CHANNELS * size] for r, a in zip(records, np.where(recent, BODY[2], OLD_BODY), strict=True)]
    return np.stack(rows).reshape(n, CHANNELS, size), count * 6


def visibilities(records: np.ndarray, array: int) -> np.ndarray:
    """Complex values (frames, baselines of receiver outputs, channels)."""
    blocks, size = _blocks(records, array)
    n = len(records)
    if array == 1:
        first, second = _words(blocks[:, :, :size].reshape(n, 8, -1, 12))
        return np.stack([first, second], axis=-1).transpose(0, 2, 1, 3).reshape(n, -1, CHANNELS)
    first, second = _words(blocks[:, :, :size].reshape(n, CHANNELS, -1, 12))
    return np.stack([second, first], axis=-1).reshape(n, CHANNELS, -1).transpose(0, 2, 1)


def autocorrelations(records: np.ndarray, array: int) -> np.ndarray:
    """Powers (frames, outputs, channels)."""
    blocks, size = _blocks(records, array)
    n, outs = len(records), OUTPUTS[array]
    if array == 1:
        tail = blocks[:, :, size + 40 : size + 40 + outs // 4 * 64].reshape(n, 8, outs // 4, 64)
        return tail[..., :32].copy().view("<u4").reshape(n, 8, outs, 2).transpose(0, 2, 1, 3).reshape(n, outs, CHANNELS).astype(float)
    tail = blocks[:, :, size : size + outs // 8 * 64].reshape(n, CHANNELS, outs // 8, 64)
    return tail[..., :32].copy().view("<u4").reshape(n, CHANNELS, outs).transpose(0, 2, 1).astype(float)


def delays(records: np.ndarray, array: int) -> np.ndarray:
    """Nanoseconds (frames, outputs)."""
    blocks, size = _blocks(records, array)
    n, outs = len(records), OUTPUTS[array]
    if array == 1:
        tail = blocks[:, 7, size + 40 : size + 40 + outs // 4 * 64].reshape(n, outs // 4, 64)
        d = tail[..., 40:56].copy().view("<u2").reshape(n, outs, 2).astype(float)
        return d[..., 0] + d[..., 1] * 1e-4
    tail = blocks[:, 14:16, size : size + outs // 8 * 64].reshape(n, 2, outs // 8, 64)
    d = tail[..., 32:48].copy().view("<u4").reshape(n, 2, outs // 8, 4).transpose(0, 2, 1, 3).reshape(n, outs)
    return (d >> 17) + (d & 0x1FFFF) * 1e-5


SCHEMAS = {"headers": HEADER, "vis": VIS, "samples": SAMPLES, "autocorr": AUTO, "delays": DELAY}


def decode(records: np.ndarray, numbers: np.ndarray, array: int, what: str) -> pa.RecordBatch:
    """One table (`headers`, `vis`, `autocorr`, `delays`) of records (frames x bytes); outputs beyond the antennas are left out."""
    n, ants = len(records), ANTENNAS[array]
    frame = lambda k: np.repeat(numbers.astype(np.int64), k)
    small = lambda x: pa.array(np.asarray(x, np.int32))
    if what == "headers":
        old = records[:, OLD_LOOP_CODE : OLD_LOOP_CODE + 2].copy().view("<u2")[:, 0].astype(np.int64) if array == 1 else None
        cols = headers(records[:, :HEAD], old, numbers.astype(np.int64), array)
    elif what in ("vis", "samples"):
        a1, a2 = pairs(OUTPUTS[array])
        use = np.flatnonzero((a1 < ants) & (a2 < ants))
        vis = visibilities(records, array)[:, use]
        each = lambda x: small(np.tile(np.repeat(x, CHANNELS), n))
        cols = {"frame_no": pa.array(frame(len(use) * CHANNELS)), "bl": each(np.arange(len(use))), "ant1": each(a1[use]), "ant2": each(a2[use]), "chan": small(np.tile(np.arange(CHANNELS), n * len(use))), "re": pa.array(vis.real.reshape(-1)), "im": pa.array(vis.imag.reshape(-1))}
        if what == "samples":
            per, modes = len(use) * CHANNELS, decode(records, numbers, array, "headers")
            times = clock_us(modes.column("packed_time").to_numpy())
            cols |= {"t_us": pa.array(np.repeat(times, per))} | {c: modes.column(c).take(pa.array(np.repeat(np.arange(n), per))) for c in ("sub_band", "pol")}
    elif what == "autocorr":
        power = autocorrelations(records, array)[:, :ants]
        cols = {"frame_no": pa.array(frame(ants * CHANNELS)), "ant": small(np.tile(np.repeat(np.arange(ants), CHANNELS), n)), "chan": small(np.tile(np.arange(CHANNELS), n * ants)), "power": pa.array(power.reshape(-1))}
    else:
        cols = {"frame_no": pa.array(frame(ants)), "ant": small(np.tile(np.arange(ants), n)), "delay_ns": pa.array(delays(records, array)[:, :ants].reshape(-1))}
    names = [c.split()[0] for c in SCHEMAS[what].split(", ")]
    return pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)


def decode_table(records: DataFrame, array: int, what: str) -> DataFrame:
    """One of the tables of a DataFrame of records (frame_no, record binary); records of another length are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 8):
                some = batch.slice(lo, 8)
                raw = np.frombuffer(b"".join(some.column(1).to_pylist()), np.uint8).reshape(some.num_rows, LENGTH[array])
                yield decode(raw, some.column(0).to_numpy(), array, what)

    return records.select("frame_no", "record").where(F.length("record") == LENGTH[array]).mapInArrow(run, SCHEMAS[what])


SUMS = "ant1 int, ant2 int, chan int, n long, re double, im double, top double"


def decode_sums(records: DataFrame, array: int) -> DataFrame:
    """ant1, ant2, chan, n, re, im, top of all visibilities: their number, sums, and the highest re.

    A task decodes all of its records and hands on one row a baseline and channel, not one a frame too; sums of up to
    2^29 numbers of 24 bits are exact.
    """
    a1, a2 = pairs(OUTPUTS[array])
    use = np.flatnonzero((a1 < ANTENNAS[array]) & (a2 < ANTENNAS[array]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, top = 0, np.zeros((len(use), CHANNELS), complex), np.full((len(use), CHANNELS), -np.inf)
        for batch in batches:
            for lo in range(0, batch.num_rows, 8):
                some = batch.slice(lo, 8)
                raw = np.frombuffer(b"".join(some.column(0).to_pylist()), np.uint8).reshape(some.num_rows, LENGTH[array])
                vis = visibilities(raw, array)[:, use]
                n, total, top = n + len(vis), total + vis.sum(0), np.maximum(top, vis.real.max(0))
        if n:
            each = lambda x: pa.array(np.repeat(x[use].astype(np.int32), CHANNELS))
            chan = pa.array(np.tile(np.arange(CHANNELS, dtype=np.int32), len(use)))
            cols = [each(a1), each(a2), chan, pa.array(np.full(total.size, n)), *(pa.array(x.reshape(-1)) for x in (total.real, total.imag, top))]
            yield pa.RecordBatch.from_arrays(cols, names=["ant1", "ant2", "chan", "n", "re", "im", "top"])

    parts = records.select("record").where(F.length("record") == LENGTH[array]).mapInArrow(run, SUMS)
    return parts.groupBy("ant1", "ant2", "chan").agg(F.sum("n").alias("n"), F.sum("re").alias("re"), F.sum("im").alias("im"), F.max("top").alias("top"))


def read_records(spark: SparkSession, path: str, array: int) -> DataFrame:
    """frame_no, record of files of records, through Hadoop's fixed-length reader: splittable, any file system.

    frame_no is the frame's slot of 3.125 ms in its day, from the record's own time, so files are read once and in
    any order.
    """
    records = spark.sparkContext.binaryRecords(path, LENGTH[array]).map(lambda r: (bytearray(r),)).toDF("record binary")
    octets = F.reverse(F.transform(F.sequence(F.lit(TIME + 1), F.lit(TIME + 8)), lambda i: F.hex(F.substring("record", i, F.lit(1)))))
    f = unpack_time(F.conv(F.array_join(octets, ""), 16, -10).cast("long"))
    us = ((f["hour"] * 60 + f["minute"]) * 60 + f["second"]) * 1_000_000 + f["ms"] * 1000 + f["us"]
    return records.select(F.floor(us / 3125).alias("frame_no"), "record")


def encode(numbers: np.ndarray, array: int, header: dict[str, np.ndarray], vis: np.ndarray, auto: np.ndarray, delay: np.ndarray) -> np.ndarray:
    """Records of given contents, for derived views and tests: vis (frames, receiver baselines, channels) of whole
    numbers, auto (frames, outputs, channels), delay (frames, outputs) of whole nanoseconds. All are of 2015 and later,
    or all before. old_loop_code in the header is put where it lay before 2015."""
    n, outs = len(numbers), OUTPUTS[array]
    count, out = outs * (outs - 1) // 2, np.zeros((len(numbers), LENGTH[array]), np.uint8)
    out[:, :28] = 0x55

    def put(at: int, values: np.ndarray, kind: str) -> None:
        raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(n, -1)
        out[:, at : at + raw.shape[1]] = raw

    def words(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        v = np.stack([second.imag, second.real, first.imag, first.real], axis=-1).astype(np.int64) & 0xFFFFFF
        return np.stack([v & 255, v >> 8 & 255, v >> 16], axis=-2).astype(np.uint8).reshape(*first.shape, 12)

    put(TIME, header["packed_time"], "<i8")
    put(40, header["frequency_switch"], "<u4")
    for i, name in enumerate(("bandwidth", "quantization", "delay_switch", "strip_switch", "sub_band_switch")):
        put(SWITCHES + 4 * i, header[name], "<u4")
    put(TARGET, header["target"], "<u2")
    put(TARGET + 2, header["array_tag"], "<u2")
    put(LOOP_CODE[array], header["loop_code"], "<u1" if array == 1 else "<u2")
    body = BODY[array] if is_recent(header["packed_time"].astype(np.int64)).all() else OLD_BODY if array == 2 else BODY[1]
    if array == 1:
        size = count * 12 + 40 + outs // 4 * 64 + 32
        for k in range(8):
            at = body + k * size
            out[:, at : at + count * 12] = words(vis[:, :, 2 * k], vis[:, :, 2 * k + 1]).reshape(n, -1)
            tail = np.zeros((n, outs // 4, 64), np.uint8)
            tail[..., :32] = np.ascontiguousarray(auto[:, :, 2 * k : 2 * k + 2].astype("<u4")).view(np.uint8).reshape(n, outs // 4, 32)
            if k == 7:
                both = np.stack([delay, np.zeros_like(delay)], axis=-1).astype("<u2")
                tail[..., 40:56] = both.reshape(n, outs // 4, 8).view(np.uint8).reshape(n, outs // 4, 16)
            out[:, at + count * 12 + 40 : at + count * 12 + 40 + tail[0].size] = tail.reshape(n, -1)
        if "old_loop_code" in header:
            put(OLD_LOOP_CODE, header["old_loop_code"], "<u2")
        return out
    size = count * 6 + outs // 8 * 64 + 72
    for k in range(CHANNELS):
        at = body + k * size
        out[:, at : at + count * 6] = words(vis[:, 1::2, k], vis[:, 0::2, k]).reshape(n, -1)
        tail = np.zeros((n, outs // 8, 64), np.uint8)
        tail[..., :32] = np.ascontiguousarray(auto[:, :, k].astype("<u4")).view(np.uint8).reshape(n, outs // 8, 32)
        if k >= 14:
            half = delay.reshape(n, outs // 8, 2, 4)[:, :, k - 14].astype("<u4") << 17
            tail[..., 32:48] = np.ascontiguousarray(half).view(np.uint8).reshape(n, outs // 8, 16)
        out[:, at + count * 6 : at + count * 6 + tail[0].size] = tail.reshape(n, -1)
    return out


class _Range(InputPartition):
    def __init__(self, path: str, first: int, count: int) -> None:
        super().__init__(None)
        self.path, self.first, self.count = path, first, count


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class RawFrameSource(DataSource):
    """spark.read.format("rawframes").option("path", files).option("array", 1).option("table", "vis").load(), or spark.readStream

    For files (several: with commas, or a folder) that every executor can open by path or address (`file://`, and
    what else pyarrow knows); partitions are runs of whole records of one file, and frame_no counts the frames of a
    file. The table `headers` reads headers only; `samples` are visibilities with their frame's time (microseconds
    since 1970 on the frames' own clock), band and polarization. Use `read_records` for stores that only Hadoop reads.

    As a stream, path is one folder, with folders below it or not, to which files are added and in which they grow; see
    `_StreamReader` for what is read when.
    """

    @classmethod
    def name(cls) -> str:
        return "rawframes"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("table", "headers")]

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


class _Records:
    """Reads runs of records of one file."""

    def __init__(self, options: dict[str, str]) -> None:
        self.paths, self.array, self.table = options["path"].split(","), int(options.get("array", 1)), options.get("table", "headers")
        self.per = int(options.get("frames", 320))

    def cut(self, path: str, first: int, end: int) -> list[_Range]:
        return [_Range(path, i, min(self.per, end - i)) for i in range(first, end, self.per)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        size = LENGTH[self.array]
        store, path = _store(partition.path)
        with store.open_input_file(path) as f:
            if self.table == "headers":
                numbers = np.arange(partition.first, partition.first + partition.count)
                head, old = [], []
                for k in numbers.tolist():
                    f.seek(k * size)
                    head.append(f.read(HEAD))
                    if self.array == 1:
                        f.seek(k * size + OLD_LOOP_CODE)
                        old.append(f.read(2))
                codes = np.frombuffer(b"".join(old), "<u2").astype(np.int64) if self.array == 1 else None
                cols = headers(np.frombuffer(b"".join(head), np.uint8).reshape(-1, HEAD), codes, numbers, self.array)
                names = [c.split()[0] for c in HEADER.split(", ")]
                yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)
                return
            f.seek(partition.first * size)
            for i in range(0, partition.count, 8):
                k = min(8, partition.count - i)
                raw = np.frombuffer(f.read(k * size), np.uint8).reshape(k, size)
                yield decode(raw, np.arange(partition.first + i, partition.first + i + k), self.array, self.table)


class _Reader(_Records, DataSourceReader):
    def partitions(self) -> list[_Range]:
        found = []
        for given in self.paths:
            store, path = _store(given)
            some = [store.get_file_info(path)]
            if some[0].type == fs.FileType.Directory:
                some = sorted(store.get_file_info(fs.FileSelector(path)), key=lambda x: x.path)
            found += [(given[: len(given) - len(path)] + x.path, x.size) for x in some if x.type == fs.FileType.File]
        return [r for f, n in found for r in self.cut(f, 0, n // LENGTH[self.array])]


class _StreamReader(_Records, DataSourceStreamReader):
    """Offsets say how far the files of a folder have been read: `{"done": name, "open": {name: records, ...}}`.

    Files are written in the order of their names. Those up to `done` are closed: full (option `full`, 19200 records),
    or followed by `behind` (2) files or more; they grow no more. Of the others the offset holds the whole records that
    were there, so it stays small, a record that is still being written waits, and a query that starts again goes on
    in the middle of a file, where its checkpoint says. A batch is planned from its two offsets alone, so one that runs
    again reads the same records. Names that begin with a dot or underscore are no frames.
    """

    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        self.full, self.behind = int(options.get("full", FULL)), int(options.get("behind", 2))

    def _files(self) -> list[tuple[str, int]]:
        """(name below the folder, whole records), by name."""
        store, top = _store(self.paths[0])
        some = store.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True))
        named = ((x.path[len(top.rstrip("/")) + 1 :], x.size // LENGTH[self.array]) for x in some if x.type == fs.FileType.File)
        return sorted((n, k) for n, k in named if not any(part[0] in "._" for part in n.split("/")))

    def initialOffset(self) -> dict:
        return {"done": "", "open": {}}

    def latestOffset(self) -> dict:
        files = self._files()
        closed = 0
        while closed < len(files) and (files[closed][1] >= self.full or len(files) - closed > self.behind):
            closed += 1
        return {"done": files[closed - 1][0] if closed else "", "open": dict(files[closed:])}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        out = []
        for name, there in self._files():
            last = there if name <= end["done"] else end["open"].get(name, 0)
            if name > start["done"]:
                out += self.cut(f"{self.paths[0].rstrip('/')}/{name}", start["open"].get(name, 0), last)
        return out


def write_files(records: DataFrame, folder: str, per: int = FULL) -> DataFrame:
    """Write records (frame_no, record) into files of `per` frame numbers each, named by the first; gives file, records.

    Sorted by frame number in each file. A file appears under its name when it is whole, so a task that runs again
    takes its own place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        store.create_dir(top, recursive=True)
        held, out, n, made = None, None, 0, []

        def end() -> None:
            if out is not None:
                out.close()
                store.move(f"{top}/.{held:012d}", f"{top}/{held:012d}")
                made.append((f"{held:012d}", n))

        for batch in batches:
            for file, record in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if file != held:
                    end()
                    held, n = file, 0
                    out = store.open_output_stream(f"{top}/.{held:012d}")
                out.write(record.as_buffer())
                n += 1
        end()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.int64())], names=["file", "records"])

    rows = records.select((F.floor(F.col("frame_no") / per) * per).alias("file"), "frame_no", "record")
    return rows.repartition("file").sortWithinPartitions("file", "frame_no").select("file", "record").mapInArrow(run, "file string, records long")


def packed_times(frame_no: np.ndarray, year: int = 2015) -> np.ndarray:
    """Packed times of a clock that starts a frame's number of 3.125 ms steps after the start of the first of November."""
    us = frame_no.astype(np.int64) * 3125
    parts = {"tick": us * 0, "us": us % 1000, "ms": us // 1000 % 1000, "second": us // 10**6 % 60, "minute": us // (60 * 10**6) % 60, "hour": us // (3600 * 10**6) % 24, "day": us * 0 + 1, "month": us * 0 + 11, "year": us * 0 + year - 2000}
    out, at = us * 0, 0
    for name, bits in PACKED:
        out |= parts[name] << at
        at += bits
    return out
