"""Packed tiles: images as rows of bytes, and stencils on them.

A tile is a row ``(image_id, band, tile, h, w, channels, kind, data, present)``: up
to ``BAND_ROWS`` x ``TILE_COLS`` pixels as one binary value, row-major, channels
interleaved.  ``kind`` is the NumPy type of a sample.  ``present`` is a bitmap of
the pixels that exist, null if all of them do.  Tile ``(band, tile)`` starts at row
``band * BAND_ROWS`` and column ``tile * TILE_COLS``.

* ``pack`` builds tiles from pixel rows once: each task packs what it reads into
  fragments (runs of neighbouring pixels), and only fragments are shuffled.
* Stencils exchange the ``radius`` edge rows and columns of each tile with its
  eight neighbours, and work on whole tiles; nothing is sorted or shuffled by
  pixel.  A result is a tile table again.
* A mask is applied as a sum of products of a column and a row (its exact
  rational rank), if that is less work than all its weights.

An image may be a third of the corpus: no group is larger than a tile.
"""

from __future__ import annotations

from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.stencil import BORDERS, SOBEL_X, TILE_COLS, _check_mask

BAND_ROWS = 256
KEYS = ["image_id", "band", "tile"]
# NumPy type of a packed column by its Spark type.
KINDS = {"tinyint": "<i4", "smallint": "<i4", "int": "<i4", "bigint": "<i8", "float": "<f8",
         "double": "<f8"}
_SHAPE = "band int, tile int, h int, w int, channels int, kind string, data binary, present binary"


def _schema(id_type: str) -> str:
    return f"image_id {id_type}, {_SHAPE}"


def _id_type(df: DataFrame) -> str:
    return dict(df.dtypes)["image_id"]


# ---------------------------------------------------------------------- pack
def _runs(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(off[1:] != off[:-1] + 1) + 1
    start = np.concatenate(([0], cut))
    return off[start], np.diff(np.append(start, len(off)))


def _fragments(values: list[str], kind: str, id_type):
    """Pixels of one tile in one batch: offsets in runs, and samples."""
    dt = np.dtype(kind)

    def run(batches):
        for batch in batches:
            for v in values:                          # a pixel without all samples is absent
                if batch.column(v).null_count:
                    batch = batch.filter(batch.column(v).is_valid())
            if batch.num_rows == 0:
                continue
            y, x = (batch.column(c).to_numpy().astype(np.int64) for c in ("y", "x"))
            ids = batch.column("image_id").dictionary_encode()
            band, tile = y // BAND_ROWS, x // TILE_COLS
            off = (y % BAND_ROWS) * TILE_COLS + x % TILE_COLS
            raw = np.stack([batch.column(v).to_numpy(zero_copy_only=False) for v in values], 1)
            data = raw.astype(dt)
            if dt.kind != "f" and (data != raw).any():
                raise ValueError(f"samples do not fit {kind}")
            image = ids.indices.to_numpy()
            step = np.zeros(len(y), bool)
            order = None
            if len(y) > 1 and not _ascending(image, band, tile, off):
                order = np.lexsort((off, tile, band, image))
                image, band, tile, off, data = (a[order] for a in (image, band, tile, off, data))
            step[1:] = (image[1:] != image[:-1]) | (band[1:] != band[:-1]) | (tile[1:] != tile[:-1])
            first = np.concatenate(([0], np.flatnonzero(step)))
            out = {"starts": [], "lengths": [], "data": []}
            for a, b in zip(first, np.append(first[1:], len(off))):
                s, n = _runs(off[a:b])
                out["starts"].append(s.astype("<i4").tobytes())
                out["lengths"].append(n.astype("<i4").tobytes())
                out["data"].append(data[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.dictionary.take(pa.array(image[first])), pa.array(band[first], pa.int32()),
                 pa.array(tile[first], pa.int32()), *(pa.array(c, pa.binary()) for c in out.values())],
                names=[*KEYS, *out])
    return run


def _ascending(*cols) -> bool:
    """Whether rows are in lexicographic order, strictly in the last column."""
    equal = np.ones(len(cols[0]) - 1, bool)
    for c in cols:
        if (equal & (c[1:] < c[:-1])).any():
            return False
        equal &= c[1:] == c[:-1]
    return not equal.any()


def _assembled(channels: int, kind: str):
    dt = np.dtype(kind)

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                off = np.concatenate([_offsets(f) for f in r["fragments"]])
                data = np.concatenate([np.frombuffer(f["data"], dt) for f in r["fragments"]])
                h, w = int((off // TILE_COLS).max()) + 1, int((off % TILE_COLS).max()) + 1
                grid, seen = np.zeros((h, w, channels), dt), np.zeros((h, w), bool)
                grid[off // TILE_COLS, off % TILE_COLS] = data.reshape(-1, channels)
                seen[off // TILE_COLS, off % TILE_COLS] = True
                out.append({k: r[k] for k in KEYS} | _row(grid, None if seen.all() else seen))
            yield from _batches(out, batch.schema.field("image_id").type)
    return run


def _offsets(f: dict) -> np.ndarray:
    s, n = (np.frombuffer(f[k], "<i4").astype(np.int64) for k in ("starts", "lengths"))
    return np.repeat(s - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def _row(grid: np.ndarray, seen: np.ndarray | None) -> dict:
    return {"h": grid.shape[0], "w": grid.shape[1], "channels": grid.shape[2], "kind": grid.dtype.str,
            "data": grid.tobytes(), "present": None if seen is None else np.packbits(seen).tobytes()}


def _batches(rows: list[dict], id_type) -> list[pa.RecordBatch]:
    schema = pa.schema([("image_id", id_type), ("band", pa.int32()), ("tile", pa.int32()),
                        ("h", pa.int32()), ("w", pa.int32()), ("channels", pa.int32()),
                        ("kind", pa.string()), ("data", pa.binary()), ("present", pa.binary())])
    return [pa.RecordBatch.from_pylist([r], schema=schema) for r in rows]


def pack(df: DataFrame, values=("gray",), kind: str | None = None) -> DataFrame:
    """Tiles of the pixel rows ``(image_id, y, x, *values)``.

    ``kind`` defaults to the NumPy type of the first value column; integer kinds
    refuse samples that do not fit.  A pixel with a NULL sample is absent, and
    of pixel rows that repeat one stays.  No rows give no tiles.
    """
    values = [values] if isinstance(values, str) else list(values)
    kind = np.dtype(kind or KINDS[dict(df.dtypes)[values[0]]]).str
    id_type = _id_type(df)
    parts = df.select("image_id", "y", "x", *values).mapInArrow(
        _fragments(values, kind, id_type),
        f"image_id {id_type}, band int, tile int, starts binary, lengths binary, data binary")
    return tiles_of_fragments(parts, len(values), kind)


def tiles_of_fragments(parts: DataFrame, channels: int, kind: str) -> DataFrame:
    """Tiles from fragments ``(image_id, band, tile, starts, lengths, data)``: runs of
    neighbouring pixels by their offsets in the tile, and their samples."""
    whole = parts.groupBy(*KEYS).agg(
        F.collect_list(F.struct("starts", "lengths", "data")).alias("fragments"))
    return whole.mapInArrow(_assembled(channels, kind), _schema(_id_type(parts)))


# -------------------------------------------------------------------- unpack
def _grid(r: dict) -> np.ndarray:
    return np.frombuffer(r["data"], r["kind"]).reshape(r["h"], r["w"], r["channels"])


def _seen(r: dict) -> np.ndarray | None:
    if r["present"] is None:
        return None
    bits = np.unpackbits(np.frombuffer(r["present"], np.uint8), count=r["h"] * r["w"])
    return bits.reshape(r["h"], r["w"]).astype(bool)


def unpack(tiles: DataFrame, values=("gray",), types=("int",)) -> DataFrame:
    """Pixel rows ``(image_id, y, x, *values)`` of a tile table."""
    values, id_type = list(values), _id_type(tiles)
    arrow = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                grid, seen = _grid(r), _seen(r)
                y, x = np.nonzero(np.ones(grid.shape[:2], bool) if seen is None else seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["image_id"]], batch.schema.field("image_id").type).take(
                        pa.array(np.zeros(len(y), np.int32))),
                     pa.array(y + r["band"] * BAND_ROWS, pa.int32()),
                     pa.array(x + r["tile"] * TILE_COLS, pa.int32()),
                     *(pa.array(grid[y, x, i].astype(arrow[t].to_pandas_dtype()))
                       for i, t in enumerate(types))],
                    names=["image_id", "y", "x", *values])

    cols = ", ".join(f"`{v}` {t}" for v, t in zip(values, types))
    return tiles.mapInArrow(run, f"image_id {id_type}, y int, x int, {cols}")


# ------------------------------------------------------------------ per pixel
def gray(tiles: DataFrame) -> DataFrame:
    """Gray tiles of 8-bit tiles with the channels blue, green, red."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                b, g, red = (_grid(r)[..., i].astype(np.float64) for i in range(3))
                lum = np.floor(red * 0.299 + g * 0.587 + b * 0.114).astype(np.uint8)
                out.append({k: r[k] for k in KEYS} | _row(lum[..., None], None)
                           | {"present": r["present"]})
            yield from _batches(out, batch.schema.field("image_id").type)

    return tiles.mapInArrow(run, _schema(_id_type(tiles)))


# ------------------------------------------------------------------- stencils
def factors(mask) -> tuple[list[tuple[list[int], list[int]]], int]:
    """``(columns and rows, divisor)``: integer vectors whose outer products sum
    to ``divisor`` times the integer mask, as few as its rank (elimination over
    rationals, so nothing is rounded)."""
    rest = [[Fraction(int(w)) for w in row] for row in mask]
    found = []
    for i, row in enumerate(rest):
        at = next((j for j, w in enumerate(row) if w), None)
        if at is None:
            continue
        pivot = list(row)
        col = [r[at] / pivot[at] for r in rest]
        for r, c in zip(rest, col):
            for j, w in enumerate(pivot):
                r[j] -= c * w
        found.append((col, pivot))
    out, divisor = [], 1
    scaled = []
    for col, row in found:
        dc, dr = lcm(*(c.denominator for c in col)), lcm(*(w.denominator for w in row))
        scaled.append(([int(c * dc) for c in col], [int(w * dr) for w in row], dc * dr))
        divisor = lcm(divisor, dc * dr)
    for col, row, d in scaled:
        out.append(([c * (divisor // d) for c in col], row))
    return out, divisor


def _plan(mask: np.ndarray):
    """Factors of an integer mask if they are less work, else None."""
    if mask.dtype.kind == "f":
        return None
    parts, divisor = factors(mask.tolist())
    work = sum(np.count_nonzero(c) + np.count_nonzero(r) for c, r in parts)
    most = sum(sum(map(abs, c)) * sum(map(abs, r)) for c, r in parts)
    if work >= np.count_nonzero(mask) or most >= 1 << 31:
        return None
    return parts, divisor


def _correlate(padded: np.ndarray, mask: np.ndarray, plan, h: int, w: int) -> np.ndarray:
    k = len(mask)
    acc = np.zeros((h, w), padded.dtype)
    if plan is None:
        for i, j in zip(*np.nonzero(mask)):
            acc += mask[i, j] * padded[i:i + h, j:j + w]
        return acc
    parts, divisor = plan
    for col, row in parts:
        line = np.zeros((h + k - 1, w), padded.dtype)
        for j, c in enumerate(row):
            if c:
                line += c * padded[:, j:j + w]
        for i, c in enumerate(col):
            if c:
                acc += c * line[i:i + h]
    return acc // divisor if divisor != 1 else acc


_SIDES = [(db, dt) for db in (-1, 0, 1) for dt in (-1, 0, 1) if (db, dt) != (0, 0)]


def _strips(radius: int):
    """The edge rows and columns of each tile, addressed to its neighbours."""
    def cut(grid, db, dt):
        rows = slice(None) if db == 0 else slice(0, radius) if db < 0 else slice(-radius, None)
        cols = slice(None) if dt == 0 else slice(0, radius) if dt < 0 else slice(-radius, None)
        return grid[rows, cols]

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                grid = _grid(r)[..., 0]
                for db, dt in _SIDES:
                    # Only a full tile has a neighbour below or to the right.
                    if r["band"] + db < 0 or r["tile"] + dt < 0 or (db > 0 and r["h"] < BAND_ROWS) \
                            or (dt > 0 and r["w"] < TILE_COLS):
                        continue
                    part = cut(grid, db, dt)
                    out.append({"image_id": r["image_id"], "band": r["band"] + db, "tile": r["tile"] + dt,
                                "db": -db, "dt": -dt, "h": part.shape[0], "w": part.shape[1],
                                "data": part.tobytes()})
            ids = batch.schema.field("image_id").type
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("image_id", ids), *((c, pa.int32()) for c in ("band", "tile", "db", "dt", "h", "w")),
                 ("data", pa.binary())]))
    return run


def _surrounded(r: dict, radius: int, border: str, dtype) -> np.ndarray:
    """The tile in its frame: strips of its neighbours, then the border rule."""
    core = _grid(r)[..., 0]
    dt = core.dtype
    strips = {(s["db"], s["dt"]): np.frombuffer(s["data"], dt).reshape(s["h"], s["w"])
              for s in r["strips"] or ()}
    top, bottom, left, right = (strips[s].shape[axis] if s in strips else 0 for s, axis in (
        ((-1, 0), 0), ((1, 0), 0), ((0, -1), 1), ((0, 1), 1)))
    h, w = core.shape
    frame = np.zeros((top + h + bottom, left + w + right), dtype)
    frame[top:top + h, left:left + w] = core
    rows = {-1: 0, 0: top, 1: top + h}
    cols = {-1: 0, 0: left, 1: left + w}
    for (db, dx), s in strips.items():
        if (db < 0 and not top) or (db > 0 and not bottom) or (dx < 0 and not left) or (dx > 0 and not right):
            continue                                  # a corner without its sides
        a, b = rows[db], cols[dx]
        # The last strip of a ragged edge may be shorter or longer than the tile.
        part = s[:frame.shape[0] - a, :frame.shape[1] - b]
        frame[a:a + part.shape[0], b:b + part.shape[1]] = part
    lack = [(radius - top, radius - bottom), (radius - left, radius - right)]
    if border == "zero":
        return np.pad(frame, lack)
    for axis in (0, 1):
        wide = [(0, 0), (0, 0)]
        wide[axis] = lack[axis]
        frame = np.pad(frame, wide, mode="reflect" if frame.shape[axis] > 1 else "edge")
    return frame


def convolve(tiles: DataFrame, mask, border: str = "zero", clamp: bool = True) -> DataFrame:
    """Cross-correlate one-channel tiles with an odd k x k mask.

    ``border="zero"``: samples outside the image or absent count as zero.
    ``"reflect101"`` mirrors at the image's edges and takes images to be
    rectangular.  ``clamp`` saturates to 0..255.  Integer samples and weights
    give exact integers.
    """
    k = _check_mask(mask)
    radius = k // 2
    if border not in BORDERS:
        raise ValueError(f"border must be one of {BORDERS}")
    if radius > min(BAND_ROWS, TILE_COLS):
        raise ValueError("the mask is larger than a tile")
    whole = all(isinstance(w, (int, np.integer)) for row in mask for w in row)
    weights = np.asarray(mask, np.int64 if whole else np.float64)
    plan = _plan(weights)
    reach = int(np.abs(weights).sum()) if plan is None and whole else 0 if plan is None else sum(
        sum(map(abs, c)) * sum(map(abs, r)) for c, r in plan[0])
    id_type = _id_type(tiles)
    narrow = tiles.select(*KEYS, "h", "w", "channels", "kind", "data", "present")
    if radius:
        strips = narrow.mapInArrow(
            _strips(radius), f"image_id {id_type}, band int, tile int, db int, dt int, h int, w int, data binary")
        around = strips.groupBy(*KEYS).agg(
            F.collect_list(F.struct("db", "dt", "h", "w", "data")).alias("strips"))
        narrow = narrow.join(around, KEYS, "left")
    else:
        narrow = narrow.withColumn("strips", F.lit(None))

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                kind = np.dtype(r["kind"])
                if not whole or kind.kind == "f":
                    dtype = np.dtype(np.float64)
                else:                                 # 32 bits if no sum can leave them
                    dtype = np.dtype(np.int32 if kind.itemsize == 1 and reach * 255 < 1 << 31 else np.int64)
                frame = _surrounded(r, radius, border, dtype)
                m = weights.astype(dtype)
                acc = _correlate(frame, m, plan if dtype.kind == "i" else None, r["h"], r["w"])
                if clamp:
                    acc = np.clip(acc, 0, 255)
                    acc = acc if dtype.kind == "f" else acc.astype(np.uint8)
                elif dtype.kind == "i":
                    acc = acc.astype(np.int64)
                out.append({c: r[c] for c in KEYS} | _row(acc[..., None], None) | {"present": r["present"]})
            yield from _batches(out, batch.schema.field("image_id").type)

    return narrow.mapInArrow(run, _schema(id_type))


def sobel_x(tiles: DataFrame, border: str = "zero", clamp: bool = True) -> DataFrame:
    """Horizontal Sobel gradient of one-channel tiles."""
    return convolve(tiles, SOBEL_X, border, clamp)
