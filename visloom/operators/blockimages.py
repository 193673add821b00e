"""Images of any size by a transform in blocks: no task holds a plane.

Samples are gridded as rows (`imaging.grid`), onto the Fourier plane of a map twice as wide as the image. Only its half
of u >= 0 is kept, since the other is its mirror. The first pass transforms blocks of `BLOCK` columns of that half
along v, keeps the lines that the image has, and cuts them into blocks of `BLOCK` lines; a shuffle brings the pieces
of a block of lines together; the second pass transforms them along u into lines of the image. Image and beam are told
apart by `plane`, and go the same way. A task holds one block of a pass: `BLOCK` x twice the image's width.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visloom.scratch import store

from .imaging import along_u, along_v, grid, spheroid, spread, weigh

#: Columns of a task of the first pass, and lines of one of the second.
BLOCK = 64
IMAGE, BEAM = 0, 1


def _half_plane(samples: DataFrame, uniform: bool) -> DataFrame:
    """image_key, size, iu, iv, re, im, beam of the half plane u >= 0; iv counts from 0 upwards, cyclically."""
    width = 2 * F.col("size")
    geometry = samples.groupBy("image_key").agg(F.max("size").cast("int").alias("size"), F.max("cell").alias("cell"))
    cells = weigh(grid(samples, 1 / (width * F.col("cell"))), uniform).join(F.broadcast(geometry), "image_key")
    inside = cells.where((F.col("iu") < F.col("size")) & (F.abs("iv") < F.col("size")))
    return inside.select("image_key", "size", F.col("iu").cast("int").alias("iu"), F.pmod("iv", width).cast("int").alias("iv"), "re", "im", "beam")


def _columns(kind: pa.DataType):
    """Pieces of lines from a block of columns."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        image_key, size, block = (k.as_py() for k in key)
        iu, iv = table.column("iu").to_numpy() - block * BLOCK, table.column("iv").to_numpy()
        keys, out = pa.array([image_key]).cast(kind), []
        for plane in (IMAGE, BEAM):
            half = np.zeros((BLOCK, 2 * size), complex)
            half[iu, iv] = table.column("beam").to_numpy() if plane == BEAM else table.column("re").to_numpy() + 1j * table.column("im").to_numpy()
            lines = along_v(half, size).T.astype(np.complex64)
            cuts = range(0, size, BLOCK)
            pieces = [np.ascontiguousarray(lines[a : a + BLOCK]).tobytes() for a in cuts]
            n = len(pieces)
            cols = [keys.take(pa.array([0] * n)), pa.array([size] * n, pa.int32()), pa.array([plane] * n, pa.int32()), pa.array([a // BLOCK for a in cuts], pa.int32()), pa.array([block] * n, pa.int32()), pa.array(pieces, pa.binary())]
            out.append(pa.RecordBatch.from_arrays(cols, names=["image_key", "size", "plane", "lines", "columns", "piece"]))
        return pa.Table.from_batches(out)

    return run


def _lines(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Lines of the image from the pieces of all blocks of columns, before the taper is taken off."""
    image_key, size, plane, block = key
    count = min(BLOCK, size - block * BLOCK)
    half = np.zeros((count, size + 1), np.complex64)
    for k, piece in zip(pdf["columns"], pdf["piece"], strict=True):
        a = k * BLOCK
        part = np.frombuffer(piece, np.complex64).reshape(count, BLOCK)
        half[:, a : a + BLOCK] = part[:, : size + 1 - a]
    lines = along_u(half.astype(complex), size)
    taper = spheroid(np.arange(-(size // 2), size - size // 2) / size)
    at = np.arange(block * BLOCK, block * BLOCK + count)
    lines = lines / (taper[at][:, None] * taper)
    return pd.DataFrame({"image_key": [image_key], "size": [size], "plane": [plane], "y0": [block * BLOCK], "high": [float(lines.max())], "data": [lines.astype(np.float32).reshape(-1)]})


def image_blocks(samples: DataFrame, uniform: bool = False) -> DataFrame:
    """image_key, size, plane (0 image, 1 beam), y0, data: blocks of whole lines, from y0 on, of the dirty image and beam of each image_key, beam peak 1.

    samples are (image_key, u, v, re, im, size, cell): u and v in wavelengths, size in pixels and cell, the pixel in
    radians, the same in all rows of an image. They agree with `imaging.dirty_image` to the precision of the 32-bit
    numbers that are shuffled and kept.
    """
    kind = dict(samples.dtypes)["image_key"]
    arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind]
    half = _half_plane(samples, uniform)
    half = spread(half.withColumn("columns", F.floor(F.col("iu") / BLOCK).cast("int")), "image_key", "size", "columns")
    pieces = half.groupBy("image_key", "size", "columns").applyInArrow(_columns(arrow), f"image_key {kind}, size int, plane int, lines int, columns int, piece binary")
    pieces = spread(pieces, "image_key", "size", "plane", "lines")
    lines = pieces.groupBy("image_key", "size", "plane", "lines").applyInPandas(_lines, f"image_key {kind}, size int, plane int, y0 int, high double, data array<float>")
    peak = F.max(F.when(F.col("plane") == BEAM, F.col("high"))).alias("peak")
    lines = store(lines, "blocks")
    return lines.join(F.broadcast(lines.groupBy("image_key").agg(peak)), "image_key").select("image_key", "size", "plane", "y0", F.transform("data", lambda v: (v / F.col("peak")).cast("float")).alias("data"))


def block_pixels(blocks: DataFrame) -> DataFrame:
    """image_key, plane, x, y, value of all pixels of blocks."""
    p = blocks.select("image_key", "plane", "size", "y0", F.posexplode("data").alias("i", "value"))
    return p.select("image_key", "plane", (F.col("i") % F.col("size")).alias("x"), (F.col("y0") + F.floor(F.col("i") / F.col("size"))).cast("int").alias("y"), F.col("value").cast("double").alias("value"))


def block_extrema(blocks: DataFrame) -> DataFrame:
    """image_key, plane, high, low, x, y of the highest pixel, as `imaging.extrema`, without a row a pixel."""
    high = F.array_max("data")
    at = F.array_position("data", high) - 1
    own = blocks.select("image_key", "plane", F.struct(high.cast("double").alias("value"), (-F.col("y0") - F.floor(at / F.col("size"))).alias("my"), (-(at % F.col("size"))).alias("mx")).alias("top"), F.array_min("data").cast("double").alias("low"))
    m = own.groupBy("image_key", "plane").agg(F.max("top").alias("top"), F.min("low").alias("low"))
    return m.select("image_key", "plane", F.col("top.value").alias("high"), "low", (-F.col("top.mx")).cast("int").alias("x"), (-F.col("top.my")).cast("int").alias("y"))
