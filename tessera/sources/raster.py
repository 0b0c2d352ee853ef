"""Raster files (binary PGM, PPM, PAM) as a splittable Spark data source.

``spark.read.format("raster")`` cuts every file into byte ranges; a task reads the
header and then only the image rows that begin in its range, so one large image
is read by many tasks and no image is ever whole in one.  Rows come as strips of
bytes ``(image_id, path, y0, h, w, channels, data, reason)``.  A file that cannot
be read gives one row with a ``reason`` and no data.

``df.write.format("raster")`` writes strips as files of their own.  Tasks write into
a staging folder; the files move into place when the job commits, and a job that
fails leaves nothing.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from tessera.functions.pixel import gray as gray_expr
from tessera.operators import tiles as tl
from tessera.sources.stores import delete_folder, list_files, open_store, write_file

SPLIT_BYTES = 8 << 20     # bytes of a task
STRIP_BYTES = 1 << 20     # bytes of a strip (one image row at least)
SUFFIXES = (".pgm", ".ppm", ".pam", ".pnm")

SCHEMA = ("image_id long, path string, y0 int, h int, w int, channels int, data binary, "
          "reason string")
_ARROW = pa.schema([("image_id", pa.int64()), ("path", pa.string()), *(
    (c, pa.int32()) for c in ("y0", "h", "w", "channels")), ("data", pa.binary()), ("reason", pa.string())])
STRIP_COLUMNS = ("image_id", "y0", "h", "w", "channels", "data")


# -------------------------------------------------------------------- headers
@dataclass
class Header:
    offset: int
    w: int
    h: int
    channels: int
    image_id: int | None
    y0: int


_OWN = re.compile(rb"#\s*image (-?\d+) row (\d+)")


def parse_header(head: bytes) -> Header:
    """Header of a binary netpbm file with 8-bit samples."""
    own = _OWN.search(head)
    image_id, y0 = (int(own[1]), int(own[2])) if own else (None, 0)
    if head[:2] in (b"P5", b"P6"):
        m = re.match(rb"P[56](?:\s+|\s*#[^\n]*\n)+(\d+)(?:\s+|\s*#[^\n]*\n)+(\d+)(?:\s+|\s*#[^\n]*\n)+(\d+)\s",
                     head)
        if not m:
            raise ValueError("bad header")
        w, h, top, channels = int(m[1]), int(m[2]), int(m[3]), 1 if head[:2] == b"P5" else 3
        offset = m.end()
    elif head[:2] == b"P7":
        end = head.find(b"ENDHDR\n")
        if end < 0:
            raise ValueError("bad header")
        f = dict(re.findall(rb"(?m)^([A-Z]+)\s+(\S+)", head[:end]))
        try:
            w, h, channels, top = (int(f[k]) for k in (b"WIDTH", b"HEIGHT", b"DEPTH", b"MAXVAL"))
        except (KeyError, ValueError):
            raise ValueError("bad header") from None
        offset = end + len(b"ENDHDR\n")
    else:
        raise ValueError("not a raster file")
    if top != 255 or channels not in (1, 3, 4) or w < 1 or h < 1:
        raise ValueError("unsupported layout")
    return Header(offset, w, h, channels, image_id, y0)


def header_bytes(image_id: int, y0: int, h: int, w: int, channels: int) -> bytes:
    note = f"# image {image_id} row {y0}\n"
    if channels == 4:
        return (f"P7\n{note}WIDTH {w}\nHEIGHT {h}\nDEPTH 4\nMAXVAL 255\n"
                "TUPLTYPE RGB_ALPHA\nENDHDR\n").encode()
    return f"P{5 if channels == 1 else 6}\n{note}{w} {h}\n255\n".encode()


# --------------------------------------------------------------------- reader
class Ranges(InputPartition):
    """Byte ranges ``(path, size, start, stop)`` of a task."""

    def __init__(self, ranges):
        super().__init__(ranges)
        self.ranges = ranges


def plan_ranges(files: list[tuple[str, int]], split: int) -> list[Ranges]:
    """Tasks of about ``split`` bytes: large files are cut, small ones share a task."""
    out, open_, size = [], [], 0
    for path, n in files:
        for start in range(0, max(n, 1), split):
            stop = min(start + split, n)
            open_.append((path, n, start, stop))
            size += stop - start
            if size >= split:
                out.append(Ranges(open_))
                open_, size = [], 0
    return out + ([Ranges(open_)] if open_ else [])


class RasterReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self):
        return plan_ranges(list_files(self.path, SUFFIXES), self.split) or [Ranges([])]

    def read(self, partition):
        store, _ = open_store(self.path)
        for path, size, start, stop in partition.ranges:
            own = xxhash.xxh64_intdigest(path.encode(), 42)
            own -= (own >> 63) << 64
            try:
                with store.open_input_file(path) as f:
                    head = parse_header(f.read(4096))
                    line = head.w * head.channels
                    if size < head.offset + line * head.h:
                        raise ValueError("truncated")
                    # Image rows whose first byte lies in the range.
                    first, last = (min(head.h, max(0, -(-(x - head.offset) // line))) for x in (start, stop))
                    last = head.h if stop >= size else last
                    step = max(1, STRIP_BYTES // line)
                    for y in range(first, last, step):
                        h = min(step, last - y)
                        f.seek(head.offset + y * line)
                        yield self._strip(head.image_id if head.image_id is not None else own, path,
                                          head.y0 + y, h, head.w, head.channels, f.read(h * line), None)
            except (OSError, ValueError) as exc:
                if start == 0:                        # once per file
                    yield self._strip(own, path, 0, 0, 0, 0, None, str(exc))

    @staticmethod
    def _strip(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _ARROW.types)],
                                          schema=_ARROW)


# --------------------------------------------------------------------- writer
@dataclass
class Written(WriterCommitMessage):
    files: list


class RasterWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"
        store, at = open_store(path)
        store.create_dir(posixpath.join(at, self.staging), recursive=True)

    def write(self, iterator):
        store, at = open_store(self.path)
        files = []
        for batch in iterator:
            for r in batch.select(list(STRIP_COLUMNS)).to_pylist():
                if r["data"] is None or len(r["data"]) != r["h"] * r["w"] * r["channels"]:
                    raise ValueError("strip without all its bytes")
                suffix = {1: "pgm", 3: "ppm", 4: "pam"}[r["channels"]]
                name = f"{r['image_id']}_{r['y0']:09d}.{suffix}"
                part = posixpath.join(at, self.staging, uuid.uuid4().hex)
                write_file(store, part, header_bytes(r["image_id"], r["y0"], r["h"], r["w"], r["channels"])
                           + r["data"])
                files.append((part, posixpath.join(at, name)))
        return Written(files)

    def commit(self, messages):
        store, at = open_store(self.path)
        if self.overwrite:
            for old, _ in list_files(self.path, SUFFIXES):
                store.delete_file(old)
        for m in messages:
            for part, name in m.files if m else ():
                store.move(part, name)
        delete_folder(store, posixpath.join(at, self.staging))

    def abort(self, messages):
        store, at = open_store(self.path)
        delete_folder(store, posixpath.join(at, self.staging))


class RasterSource(DataSource):
    @classmethod
    def name(cls):
        return "raster"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return RasterReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite):
        return RasterWriter(self.options["path"], overwrite)


def read_raster(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Strips of all raster files under ``path``, with rejects (``reason`` not null)."""
    spark.dataSource.register(RasterSource)
    return spark.read.format("raster").option("splitBytes", str(split_bytes)).load(path)


def write_raster(strips: DataFrame, path: str, mode: str = "append") -> None:
    """Write strips ``(image_id, y0, h, w, channels, data)``, one file each."""
    strips.sparkSession.dataSource.register(RasterSource)
    strips.select(*STRIP_COLUMNS).write.format("raster").mode(mode).save(path)


# ----------------------------------------------------------------- conversions
def tiles_to_strips(tiles: DataFrame) -> DataFrame:
    """Strips of full image rows from 8-bit tiles; a group is one band of an image."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                parts = sorted(r["parts"], key=lambda p: p["tile"])
                grid = np.concatenate([tl._grid(p) for p in parts], 1)
                h, w, channels = grid.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["image_id"]], pa.int64()), *(pa.array([v], pa.int32()) for v in (
                        r["band"] * tl.BAND_ROWS, h, w, channels)), pa.array([grid.tobytes()], pa.binary())],
                    names=list(STRIP_COLUMNS))

    whole = tiles.groupBy(F.col("image_id").cast("long").alias("image_id"), "band").agg(
        F.collect_list(F.struct("tile", "h", "w", "channels", "kind", "data")).alias("parts"))
    return whole.mapInArrow(run, "image_id long, y0 int, h int, w int, channels int, data binary")


def strips_to_tiles(strips: DataFrame, channels: int) -> DataFrame:
    """Packed tiles of the strips with so many channels; no pixel is ever a row."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                grid = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], channels)
                y = r["y0"] + np.arange(r["h"])
                for band in np.unique(y // tl.BAND_ROWS).tolist():
                    rows = np.flatnonzero(y // tl.BAND_ROWS == band)
                    for tile in range(-(-r["w"] // tl.TILE_COLS)):
                        part = grid[rows[0]:rows[-1] + 1, tile * tl.TILE_COLS:(tile + 1) * tl.TILE_COLS]
                        start = (y[rows] % tl.BAND_ROWS) * tl.TILE_COLS
                        out.append({"image_id": r["image_id"], "band": band, "tile": tile,
                                    "starts": start.astype("<i4").tobytes(),
                                    "lengths": np.full(len(rows), part.shape[1], "<i4").tobytes(),
                                    "data": part.tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("image_id", pa.int64()), ("band", pa.int32()), ("tile", pa.int32()),
                 *((c, pa.binary()) for c in ("starts", "lengths", "data"))]))

    good = strips.where((F.col("channels") == channels) & F.col("data").isNotNull())
    return tl.tiles_of_fragments(good.select(*STRIP_COLUMNS).mapInArrow(
        run, "image_id long, band int, tile int, starts binary, lengths binary, data binary"),
        channels, "|u1")


def raster_pixels(strips: DataFrame, as_: str = "color") -> DataFrame:
    """Pixel rows of the strips that could be read, in the forms of
    :func:`tessera.sources.images.image_pixels`: ``"color"``, ``"gray"`` or ``"rgba"``.
    A gray file repeats its sample; a file without alpha is opaque."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                grid = np.frombuffer(r["data"], np.uint8).reshape(-1, r["channels"]).astype(np.int32)
                n, c = grid.shape
                red, green, blue = (grid[:, i if c > 1 else 0] for i in range(3))
                alpha = grid[:, 3] if c == 4 else np.full(n, 255, np.int32)
                at = np.arange(n, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r["image_id"], np.int64)), *map(pa.array, (
                        r["y0"] + at // r["w"], at % r["w"], red, green, blue, alpha))],
                    names=["image_id", "y", "x", "r", "g", "b", "a"])

    px = strips.where(F.col("data").isNotNull()).select(*STRIP_COLUMNS).mapInArrow(
        run, "image_id long, y int, x int, r int, g int, b int, a int")
    keys = ["image_id", "y", "x"]
    if as_ == "color":
        return px.select(*keys, "b", "g", "r")
    if as_ == "rgba":
        return px.select(*keys, "r", "g", "b", "a")
    if as_ == "gray":
        return px.select(*keys, gray_expr("r", "g", "b", rounding="half_even").alias("gray"))
    raise ValueError("as_ must be 'color', 'rgba' or 'gray'")


def raster_rejects(strips: DataFrame) -> DataFrame:
    """Files that could not be read, with the reason."""
    return strips.where(F.col("reason").isNotNull()).select("image_id", "path", "reason")
