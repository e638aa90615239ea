"""Geometry columns: WKB, bounding boxes and grid cells.

Only the WKB codecs run in Python, as Arrow functions over whole columns; the
rest are built-in expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SRID = 4326

# Little-endian flag and geometry type of a 2-D point, then two doubles.
_POINT_HEAD = np.frombuffer(b"\x01\x01\x00\x00\x00", dtype="u1")
_POINT_SIZE = 21


def _point_to_wkb(x: pa.Array, y: pa.Array) -> pa.Array:
    xs, ys = (a.to_numpy(zero_copy_only=False).astype("<f8") for a in (x, y))
    missing = ~(np.asarray(x.is_valid()) & np.asarray(y.is_valid()))
    out = np.empty((len(xs), _POINT_SIZE), dtype="u1")
    out[:, :5] = _POINT_HEAD
    out[:, 5:13] = xs.view("u1").reshape(-1, 8)
    out[:, 13:] = ys.view("u1").reshape(-1, 8)
    points = pa.Array.from_buffers(
        pa.binary(_POINT_SIZE), len(xs), [None, pa.py_buffer(out.tobytes())]
    )
    return pc.if_else(pa.array(missing), pa.scalar(None, pa.binary()), points.cast(pa.binary()))


def _wkb_to_points(wkb: pa.Array) -> pa.Array:
    wkb = wkb.cast(pa.large_binary())
    offsets = np.frombuffer(wkb.buffers()[1], "<i8")[wkb.offset:wkb.offset + len(wkb) + 1] if len(wkb) else np.zeros(1, "<i8")
    known = (np.diff(offsets) == _POINT_SIZE) & np.asarray(wkb.is_valid())
    data = np.frombuffer(wkb.buffers()[2] or b"", dtype="u1")
    raw = np.zeros((len(wkb), _POINT_SIZE), dtype="u1")
    raw[known] = data[offsets[:-1][known, None] + np.arange(_POINT_SIZE)]
    known &= (raw[:, :5] == _POINT_HEAD).all(axis=1)
    xy = np.ascontiguousarray(raw[:, 5:]).view("<f8").reshape(-1, 2)
    gone = ~known
    return pa.StructArray.from_arrays(
        [pa.array(xy[:, 0], mask=gone), pa.array(xy[:, 1], mask=gone)], names=["x", "y"]
    )


def point_wkb(x: Column, y: Column) -> Column:
    """WKB of a point; NULL when a coordinate is NULL."""

    @F.arrow_udf("binary")
    def encode(x: pa.Array, y: pa.Array) -> pa.Array:
        return _point_to_wkb(x, y)

    return encode(x.cast("double"), y.cast("double"))


def wkb_point(wkb: Column) -> Column:
    """Coordinates ``struct<x, y>`` of a point WKB; NULL members otherwise."""

    @F.arrow_udf("struct<x: double, y: double>")
    def decode(wkb: pa.Array) -> pa.Array:
        return _wkb_to_points(wkb)

    return decode(wkb)


# WKB types whose members are geometries of their own, and how deep they may stand in each other.
_POINT, _LINE, _POLYGON, _COLLECTIONS = 1, 2, 3, (4, 5, 6, 7)
_DEPTH = 8

RUNS = "array<struct<part:int,ring:int,xy:array<double>>>"


def _at(data: np.ndarray, at: np.ndarray, width: int, kind: str) -> np.ndarray:
    """Numbers of ``width`` bytes at some places."""
    if not len(at):
        return np.zeros((0, width // np.dtype(kind).itemsize), kind)
    return np.lib.stride_tricks.sliding_window_view(data, width)[at].view(kind)


def _buffers(wkb: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a column, where each value begins and ends, with NULLs empty."""
    wkb = wkb.cast(pa.large_binary())
    if not len(wkb):
        return np.zeros(0, "u1"), np.zeros(0, "i8"), np.zeros(0, "i8")
    offsets = np.frombuffer(wkb.buffers()[1], "<i8")[wkb.offset:wkb.offset + len(wkb) + 1]
    known = np.asarray(wkb.is_valid())
    return np.frombuffer(wkb.buffers()[2] or b"", dtype="u1"), offsets[:-1], np.where(known, offsets[1:], offsets[:-1])


def _runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of points in a column of WKB: row, part, ring, first byte and number of points, in order by row.

    Every value has a place to read at and a stack of what is still to come, all values' in arrays. A step reads a
    head or a ring for all values that are not done, so there are as many steps as the longest value has heads and
    rings. What is big-endian, cut off, of another type or followed by more bytes has no runs, and is told as bad.
    """
    n = len(begin)
    at, depth, bad = begin.copy(), np.zeros(n, "i8"), begin == end
    left = np.zeros((n, _DEPTH), "i8")  # members to come, by depth
    left[:, 0] = 1
    rings = np.zeros(n, "i8")  # rings to come of the polygon being read
    part, ring = np.full(n, -1), np.zeros(n, "i8")
    found: list[tuple[np.ndarray, ...]] = []

    def points(rows: np.ndarray, ring_of: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        fits = first + 16 * count <= end[rows]
        bad[rows[~fits]] = True
        rows, ring_of, first, count = (x[fits] for x in (rows, ring_of, first, count))
        found.append((rows, part[rows], ring_of, first, count))
        at[rows] = first + 16 * count

    while True:
        # What has no members left at its depth goes back up.
        while True:
            up = np.flatnonzero(~bad & (rings == 0) & (depth > 0) & (left[np.arange(n), depth] == 0))
            if not len(up):
                break
            depth[up] -= 1
        more = ~bad & ((rings > 0) | (left[np.arange(n), depth] > 0))
        inner = np.flatnonzero(more & (rings > 0))
        outer = np.flatnonzero(more & (rings == 0))
        if not len(inner) and not len(outer):
            break
        short = inner[at[inner] + 4 > end[inner]]
        bad[short] = True
        inner = np.setdiff1d(inner, short, assume_unique=True)
        if len(inner):
            count = _at(data, at[inner], 4, "<u4")[:, 0].astype("i8")
            rings[inner] -= 1
            points(inner, ring[inner].copy(), at[inner] + 4, count)
            ring[inner] += 1
        short = outer[at[outer] + 5 > end[outer]]
        bad[short] = True
        outer = np.setdiff1d(outer, short, assume_unique=True)
        if not len(outer):
            continue
        kind = _at(data, at[outer] + 1, 4, "<u4")[:, 0].astype("i8")
        wrong = (data[at[outer]] != 1) | ~np.isin(kind, (_POINT, _LINE, _POLYGON, *_COLLECTIONS))
        wrong |= (kind != _POINT) & (at[outer] + 9 > end[outer])
        wrong |= np.isin(kind, _COLLECTIONS) & (depth[outer] + 1 >= _DEPTH)
        bad[outer[wrong]] = True
        outer, kind = outer[~wrong], kind[~wrong]
        left[outer, depth[outer]] -= 1
        group = np.isin(kind, _COLLECTIONS)
        part[outer[~group]] += 1
        lone = outer[kind == _POINT]
        points(lone, np.zeros(len(lone), "i8"), at[lone] + 5, np.ones(len(lone), "i8"))
        counted, kind = outer[kind != _POINT], kind[kind != _POINT]
        count = _at(data, at[counted] + 5, 4, "<u4")[:, 0].astype("i8")
        at[counted] += 9
        line = kind == _LINE
        points(counted[line], np.zeros(int(line.sum()), "i8"), at[counted[line]], count[line])
        area = kind == _POLYGON
        rings[counted[area]], ring[counted[area]] = count[area], 0
        group = ~line & ~area
        depth[counted[group]] += 1
        left[counted[group], depth[counted[group]]] = count[group]
    bad |= at != end
    runs = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, "i8")] * 5
    order = np.flatnonzero(~bad[runs[0]])
    order = order[np.lexsort((runs[3][order], runs[0][order]))]
    return (*(x[order] for x in runs), bad)


def _coordinates(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Coordinates of runs of points, one run after the other."""
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return _at(data, np.repeat(first, count) + 16 * within, 16, "<f8").ravel() if len(within) else np.zeros(0)


def _lists(counts: np.ndarray, bad: np.ndarray | None, values: pa.Array) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=None if bad is None else pa.array(bad))


def _wkb_to_runs(wkb: pa.Array) -> pa.Array:
    data, begin, end = _buffers(wkb)
    row, part, ring, first, count, bad = _runs(data, begin, end)
    xy = _lists(2 * count, None, pa.array(_coordinates(data, first, count)))
    runs = pa.StructArray.from_arrays([pa.array(part, pa.int32()), pa.array(ring, pa.int32()), xy], ["part", "ring", "xy"])
    return _lists(np.bincount(row, minlength=len(wkb)), bad, runs)


def _wkb_to_coordinates(wkb: pa.Array) -> pa.Array:
    data, begin, end = _buffers(wkb)
    row, _, _, first, count, bad = _runs(data, begin, end)
    return _lists(np.bincount(row, weights=2 * count, minlength=len(wkb)).astype("i8"), bad, pa.array(_coordinates(data, first, count)))


def wkb_runs(wkb: Column) -> Column:
    """The runs of points of any WKB geometry: ``array<struct<part, ring, xy>>``.

    A run is a point, a line or a ring; ``part`` counts the points, lines and polygons of a collection, ``ring`` the
    rings of a polygon (0: its shell). NULL for NULL and for what is no little-endian WKB of two dimensions.
    """

    @F.arrow_udf(RUNS)
    def decode(wkb: pa.Array) -> pa.Array:
        return _wkb_to_runs(wkb)

    return decode(wkb)


def wkb_coordinates(wkb: Column) -> Column:
    """Coordinates of all points of any WKB geometry, in order: ``array<double>``; NULL where ``wkb_runs`` is."""

    @F.arrow_udf("array<double>")
    def decode(wkb: pa.Array) -> pa.Array:
        return _wkb_to_coordinates(wkb)

    return decode(wkb)


def srid(value: int | None = None) -> Column:
    """Spatial reference tag of a table."""
    return F.lit(DEFAULT_SRID if value is None else value).cast("int")


def to_geometry(wkb: Column, value: int | None = None) -> Column:
    """Spark's own GEOMETRY with its spatial reference.

    For use at the edge only: it needs ``spark.sql.geospatial.enabled`` and cannot
    be written to Parquet.
    """
    return F.call_function("st_setsrid", F.call_function("st_geomfromwkb", wkb), srid(value))


def grid_cell(x: Column, y: Column, size: float, origin: tuple[float, float] = (0.0, 0.0)) -> Column:
    """Grid cell of a coordinate as one BIGINT that keeps near cells near.

    The bits of the two cell numbers are interleaved (Z-order), so a sort by the
    result keeps both axes local.  Each axis has 2**20 cells around ``origin``; a
    coordinate outside of them is an error that asks for larger cells or another
    origin.
    """

    def spread(cell: Column) -> Column:
        # Standard bit spreading: put a gap between neighbouring bits.
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF),
                            (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                            (1, 0x5555555555555555)):
            cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask))
        return cell

    def axis(v: Column, zero: float) -> Column:
        cell = F.floor((v - F.lit(float(zero))) / F.lit(float(size))).cast("bigint") + F.lit(1 << 19).cast("bigint")
        outside = F.raise_error(F.concat(F.lit("no grid cell for coordinate "), v.cast("string"))).cast("bigint")
        return F.when(v.isNull() | cell.between(0, (1 << 20) - 1), cell).otherwise(outside)

    return spread(axis(x, origin[0])).bitwiseOR(F.shiftleft(spread(axis(y, origin[1])), 1))


def box_overlaps(xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Rows whose bounding box meets the window.

    Four plain comparisons, so Parquet statistics prune row groups.
    """
    return (
        (F.col("xmin") <= F.lit(float(xmax)))
        & (F.col("xmax") >= F.lit(float(xmin)))
        & (F.col("ymin") <= F.lit(float(ymax)))
        & (F.col("ymax") >= F.lit(float(ymin)))
    )
