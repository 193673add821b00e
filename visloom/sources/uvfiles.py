"""Visibility files of random groups: a header of 80-character cards in blocks of 2880 bytes, then groups of big-endian floats.

A group is its parameters (baseline vector, baseline id, date in two parts and, where the file has them, source, frequency
and integration time) and an array of (re, im, weight) by polarization and channel. Files are read whole, one a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK, CARD = 2880, 80
GROUPS = "path string, row long, baseline int, ant1 int, ant2 int, uu double, vv double, ww double, date double, source int, freqid int, inttim double, data array<double>"
_NAMES = [c.split()[0] for c in GROUPS.split(", ")]


def cards(content: bytes) -> tuple[dict[str, str], int]:
    """The values of a header, as text, and where it ends."""
    found: dict[str, str] = {}
    for at in range(0, len(content), CARD):
        card = content[at : at + CARD].decode("ascii", "replace")
        key = card[:8].strip()
        if key == "END":
            return found, -(-(at + CARD) // BLOCK) * BLOCK
        if card[8:10] == "= ":
            value = card[10:].strip()
            found[key] = value[1 : value.index("'", 1)].strip() if value.startswith("'") and "'" in value[1:] else value.split("/")[0].strip()
    return found, len(content)


def groups(content: bytes) -> dict[str, np.ndarray]:
    """Parameters by name (repeated ones summed, scaled) and `data` of the groups of a file; of no other file any."""
    head, at = cards(content)
    if head.get("GROUPS") != "T" or head.get("BITPIX") != "-32":
        return {}
    count, params = int(head["GCOUNT"]), int(head["PCOUNT"])
    size = int(np.prod([int(head[f"NAXIS{i}"]) for i in range(2, int(head["NAXIS"]) + 1)]))
    count = min(count, (len(content) - at) // (4 * (params + size)))
    raw = np.frombuffer(content, ">f4", count * (params + size), at).reshape(count, params + size)
    out: dict[str, np.ndarray] = {}
    for i in range(params):
        name = head.get(f"PTYPE{i + 1}", "").split("-")[0].rstrip("-")
        value = raw[:, i].astype(float) * float(head.get(f"PSCAL{i + 1}", "1")) + float(head.get(f"PZERO{i + 1}", "0"))
        out[name] = out[name] + value if name in out else value
    return out | {"data": raw[:, params:].astype(float)}


def read_groups(files: DataFrame) -> DataFrame:
    """A row a group of files (path, content), as spark.read.format("binaryFile") gives them; see `tables.flux_rows` for its FLUX.

    row counts the groups of a file. Source, freqid and inttim are 1 where the file doesn't have them; antennas come from
    the baseline id, also of more than 255 antennas. A file of another kind gives no row, a group cut short neither.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                g = groups(content.as_py() or b"")
                if not g:
                    continue
                n, size = g["data"].shape
                one = np.ones(n)
                b = np.rint(g["BASELINE"]).astype(np.int64)
                wide = b > 65536
                ant1, ant2 = np.where(wide, (b - 65536) // 2048, b // 256), np.where(wide, (b - 65536) % 2048, b % 256)
                ints = lambda x: pa.array(np.asarray(x, np.int32))
                data = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(g["data"].reshape(-1)))
                cols = [pa.array([path] * n, pa.string()), pa.array(np.arange(n)), ints(b), ints(ant1), ints(ant2), *(pa.array(g.get(x, 0 * one)) for x in ("UU", "VV", "WW", "DATE"))]
                cols += [ints(np.rint(g.get("SOURCE", one))), ints(np.rint(g.get("FREQSEL", one))), pa.array(g.get("INTTIM", one)), data]
                yield pa.RecordBatch.from_arrays(cols, names=_NAMES)

    return files.select("path", "content").mapInArrow(run, GROUPS)


def encode(params: dict[str, np.ndarray], data: np.ndarray) -> bytes:
    """A file of such groups, for derived views and tests: data (groups, values) of whole triples; DATE is split into day and rest."""
    day = np.floor(params["DATE"])
    columns = [(k, v) for k, v in params.items() if k != "DATE"] + [("DATE", 0 * day), ("DATE", params["DATE"] - day)]
    zero = float(day.min(initial=0.0)) if len(day) else 0.0
    columns[-2] = ("DATE", day - zero)
    n, size = data.shape
    lines = ["SIMPLE  = T", "BITPIX  = -32", "NAXIS   = 3", "NAXIS1  = 0", "NAXIS2  = 3", f"NAXIS3  = {size // 3}", "GROUPS  = T", f"PCOUNT  = {len(columns)}", f"GCOUNT  = {n}"]
    for i, (name, _) in enumerate(columns, 1):
        lines += [f"PTYPE{i:<3}= '{name}'", f"PSCAL{i:<3}= 1.0", f"PZERO{i:<3}= {zero if i == len(columns) - 1 else 0.0!r}"]
    head = "".join(x.ljust(CARD) for x in [*lines, "END"]).encode()
    body = np.concatenate([np.stack([v for _, v in columns], 1), data], axis=1).astype(">f4").tobytes()
    pad = lambda x, fill: x + fill * (-len(x) % BLOCK)
    return pad(head, b" ") + pad(body, b"\0")
