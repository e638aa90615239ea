"""Shapefiles as a Spark source: attributes, WKB geometry and bounding box.

The index file holds one fixed-width entry per record, so tasks take ranges of
records.  A batch of shapes is listed, sorted and written as arrays of its parts and
points; none is looked at by itself.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from centerline.sources import dbf, ranges, scans

GEOMETRY_FIELDS = [
    T.StructField("geometry", T.BinaryType()),
    T.StructField("xmin", T.DoubleType()),
    T.StructField("ymin", T.DoubleType()),
    T.StructField("xmax", T.DoubleType()),
    T.StructField("ymax", T.DoubleType()),
    T.StructField("srid", T.IntegerType()),
]
BOX = ["xmin", "ymin", "xmax", "ymax"]

# Names of coordinate systems in ``.prj`` files and their numbers.
SRIDS = {
    "GCS_NORTH_AMERICAN_1983": 4269, "NAD83": 4269, "GCS_WGS_1984": 4326, "WGS 84": 4326,
    "GCS_NORTH_AMERICAN_1927": 4267, "NAD27": 4267, "WGS_1984_WEB_MERCATOR_AUXILIARY_SPHERE": 3857,
}

# WKB geometry types.
POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON = range(1, 7)


def _head(kind: int, count: int | None = None) -> bytes:
    return struct.pack("<BI", 1, kind) if count is None else struct.pack("<BII", 1, kind, count)


def _rows(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes from each of some places, as rows."""
    if len(at) and (at.min() < 0 or at.max() + width > len(data)):
        raise ValueError("a shape ends beyond its file")
    windows = np.lib.stride_tricks.sliding_window_view(data, width) if len(data) >= width else np.empty((0, width), "u1")
    return windows[at]


def _put(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Write rows of bytes to places that do not overlap."""
    if len(at):
        np.lib.stride_tricks.sliding_window_view(out, rows.shape[1], writeable=True)[at] = rows


def _ints(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _rows(data, at, 4).view("<i4").ravel().astype("i8")


def _numbers(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of some runs, one run after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _fixed(values: np.ndarray, kind: str = "<u4") -> np.ndarray:
    return np.ascontiguousarray(values, dtype=kind).view("u1").reshape(len(values), np.dtype(kind).itemsize)


def _inside(x: np.ndarray, y: np.ndarray, xy: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Even-odd test of points, each against the closed ring of ``size`` points from ``first`` on."""
    out = np.zeros(len(x), dtype=bool)
    edges = np.maximum(size - 1, 0)
    # Some million edges at a time; a longer ring is alone.
    group = np.cumsum(edges) >> 22
    for own in np.split(np.arange(len(x)), np.flatnonzero(np.diff(group)) + 1):
        own = own[edges[own] > 0]
        if not len(own):
            continue
        at = np.repeat(first[own], edges[own]) + _numbers(edges[own])
        (xa, ya), (xb, yb) = xy[at].T, xy[at + 1].T
        px, py = np.repeat(x[own], edges[own]), np.repeat(y[own], edges[own])
        spans = (ya > py) != (yb > py)
        cross = xa + (py - ya) * (xb - xa) / np.where(spans, yb - ya, 1)
        starts = np.cumsum(edges[own]) - edges[own]
        out[own] = np.add.reduceat((spans & (px < cross)).astype("i8"), starts) % 2 == 1
    return out


def _shells_of(owner: np.ndarray, xy: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every ring of polygons: whether it is a shell, and the shell it belongs to.

    Clockwise rings are shells (the first ring, if there is none); a hole goes to the smallest shell around its first
    point, or to the first shell of its shape. ``owner`` is the shape of each ring, in ascending order; ``xy`` has the
    points of all rings one after the other.
    """
    step = np.arange(len(xy) - 1) if len(xy) else np.zeros(0, "i8")
    cross = np.append(xy[step, 0] * xy[step + 1, 1] - xy[step + 1, 0] * xy[step, 1], 0.0)
    last = (first + size - 1)[size > 0]
    cross[last] = 0.0  # from the end of a ring to the next one
    area = np.zeros(len(size))
    some = size > 0
    area[some] = np.add.reduceat(cross, first[some]) / 2 if some.any() else 0.0
    begins = np.flatnonzero(np.diff(owner, prepend=-1))
    shell = area <= 0
    lone = ~np.logical_or.reduceat(shell, begins) if len(begins) else np.zeros(0, bool)
    shell[begins[lone]] = True
    number = np.cumsum(np.diff(owner, prepend=-1) != 0) - 1  # of the shape of each ring
    places = np.flatnonzero(shell)
    shells = np.bincount(number[places], minlength=len(begins))
    first_shell = places[np.cumsum(shells) - shells] if len(begins) else np.zeros(0, "i8")
    belongs = np.where(shell, np.arange(len(size)), first_shell[number] if len(number) else 0)
    holes = np.flatnonzero(~shell & (shells[number] > 1) & some)
    if not len(holes):
        return shell, belongs
    # Pairs of a hole and a shell of its shape whose box holds the hole's first point.
    low, high = (f.reduceat(xy, np.minimum(first, len(xy) - 1), axis=0) for f in (np.minimum, np.maximum))
    ends = np.cumsum(shells)
    options = shells[number[holes]]
    hole = np.repeat(holes, options)
    around = places[np.repeat(ends[number[holes]] - options, options) + _numbers(options)]
    point = xy[first[hole]]
    near = ((low[around] <= point) & (point <= high[around])).all(axis=1) & (size[around] > 0)
    hole, around, point = hole[near], around[near], point[near]
    held = _inside(point[:, 0], point[:, 1], xy, first[around], size[around])
    hole, around = hole[held], around[held]
    order = np.lexsort((around, np.abs(area[around]), hole))
    hole, around = hole[order], around[order]
    smallest = np.flatnonzero(np.diff(hole, prepend=-1))
    belongs[hole[smallest]] = around[smallest]
    return shell, belongs


def wkb_of_shapes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """WKB and bounding boxes of the record contents at ``starts``; NULL shapes give none.

    All records go together: parts and points of the whole batch are listed, rings are told apart and dealt to their
    shells by reductions over the list, and the results are put into one buffer by their offsets. Z and M variants
    keep their plane coordinates, which come first.
    """
    n = len(starts)
    kinds = _ints(data, starts)
    boxes = np.full((n, 4), np.nan)
    points, multi = np.isin(kinds, (1, 11, 21)), np.isin(kinds, (8, 18, 28))
    lines, areas = np.isin(kinds, (3, 13, 23)), np.isin(kinds, (5, 15, 25))
    odd = ~(points | multi | lines | areas | (kinds == 0))
    if odd.any():
        raise ValueError(f"shape type {kinds[odd][0]}")
    needs = np.select([points, multi, lines | areas], [20, 40, 44], 4)
    if (needs > sizes).any():
        raise ValueError("a shape is cut off")
    boxed = np.flatnonzero(multi | lines | areas)
    boxes[boxed] = _rows(data, starts[boxed] + 4, 32).view("<f8")
    lone = np.flatnonzero(points)
    xy = _rows(data, starts[lone] + 4, 16)
    boxes[lone] = np.tile(xy.view("<f8"), 2)

    count, total = np.zeros(n, "i8"), np.zeros(n, "i8")  # parts and points
    split = np.flatnonzero(lines | areas)
    count[split], total[split] = _ints(data, starts[split] + 36), _ints(data, starts[split] + 40)
    total[multi] = _ints(data, starts[multi] + 36)
    if (count < 0).any() or (total < 0).any() or (needs + 4 * count + 16 * total * ~points > sizes).any():
        raise ValueError("a shape is cut off")
    empty = (lines | areas) & (count == 0)
    boxes[empty] = np.nan
    none = (kinds == 0) | empty

    # Every part of lines and areas: its shape, first point and number of points in the list of all their points.
    owner = np.repeat(split, count[split])
    place = _numbers(count[split])
    begin = _ints(data, np.repeat(starts[split] + 44, count[split]) + 4 * place)
    next_begin = np.append(begin[1:], 0)
    ends_shape = place == count[owner] - 1
    size = np.where(ends_shape, total[owner], next_begin) - begin
    if (size < 0).any() or (begin < 0).any() or (begin[place == 0] != 0).any():
        raise ValueError("parts of a shape are out of order")
    before = np.zeros(n, "i8")
    used = split[count[split] > 0]
    before[used] = np.cumsum(total[used]) - total[used]
    first = before[owner] + begin
    from_at = np.repeat(starts[used] + 44 + 4 * count[used], total[used]) + 16 * _numbers(total[used])
    raw = _rows(data, from_at, 16)
    ring = areas[owner]
    shell, belongs = np.zeros(len(owner), bool), np.arange(len(owner))
    if ring.any():
        at = np.flatnonzero(ring)
        points_of = np.repeat(first[at], size[at]) + _numbers(size[at])
        shell[at], own = _shells_of(owner[at], raw[points_of].view("<f8"), np.cumsum(size[at]) - size[at], size[at])
        belongs[at] = at[own]

    # Parts in the order of the result: a shell, then its holes. In front of a part stand its number of points,
    # for a line or a shell its head, and in front of the first part the head of the collection.
    order = np.lexsort((np.arange(len(owner)), ~shell & ring, belongs, owner))
    owner, ring, shell, belongs, first, size = (x[order] for x in (owner, ring, shell, belongs, first, size))
    bodies = np.bincount(owner[~ring | shell], minlength=n)  # lines or polygons of a shape
    several = bodies > 1
    opens = np.diff(owner, prepend=-1) != 0
    heads = ~ring | shell
    front = np.where(heads, np.where(ring, 13, 9), 4) + 9 * (opens & several[owner])
    length = np.where(points, 21, np.where(multi, 9 + 21 * total, 0))
    length += np.bincount(owner, weights=front + 16 * size, minlength=n).astype("i8")
    offsets = np.concatenate(([0], np.cumsum(length)))
    out = np.zeros(int(offsets[-1]), dtype="u1")
    skipped = np.bincount(owner, weights=front + 16 * size, minlength=n).astype("i8")
    within = np.cumsum(front + 16 * size) - (front + 16 * size)
    within -= np.repeat((np.cumsum(skipped) - skipped)[split], np.bincount(owner, minlength=n)[split])
    at = offsets[owner] + within
    _put(out, offsets[lone], np.hstack([np.tile(np.frombuffer(_head(POINT), "u1"), (len(lone), 1)), xy]))
    groups = np.flatnonzero(opens & several[owner])
    kind = np.where(ring[groups], MULTIPOLYGON, MULTILINE)
    _put(out, at[groups], np.hstack([np.ones((len(groups), 1), "u1"), _fixed(kind), _fixed(bodies[owner[groups]])]))
    at = at + 9 * (opens & several[owner])
    own_line = np.flatnonzero(~ring)
    _put(out, at[own_line], np.tile(np.frombuffer(_head(LINE), "u1"), (len(own_line), 1)))
    own_shell = np.flatnonzero(shell)
    rings = np.bincount(belongs, minlength=len(belongs))[belongs[own_shell]] if len(own_shell) else np.zeros(0, "i8")
    _put(out, at[own_shell], np.hstack([np.tile(np.frombuffer(_head(POLYGON), "u1"), (len(own_shell), 1)), _fixed(rings)]))
    at = at + np.where(heads, np.where(ring, 9, 5), 0)
    _put(out, at, _fixed(size))
    _put(out, np.repeat(at + 4, size) + 16 * _numbers(size), raw[np.repeat(first, size) + _numbers(size)])
    many = np.flatnonzero(multi)
    _put(out, offsets[many], np.hstack([np.tile(np.frombuffer(_head(MULTIPOINT), "u1"), (len(many), 1)), _fixed(total[many])]))
    members = _rows(data, np.repeat(starts[many] + 40, total[many]) + 16 * _numbers(total[many]), 16)
    _put(out, np.repeat(offsets[many] + 9, total[many]) + 21 * _numbers(total[many]),
         np.hstack([np.tile(np.frombuffer(_head(POINT), "u1"), (len(members), 1)), members]))
    valid = pa.array(~none).buffers()[1]
    wkb = pa.Array.from_buffers(pa.large_binary(), n, [valid, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(out)])
    return wkb.cast(pa.binary()), boxes


def shape_to_wkb(content: bytes) -> tuple[bytes | None, tuple | None]:
    """WKB and bounding box of one record's content."""
    wkb, boxes = wkb_of_shapes(np.frombuffer(content, "u1"), np.array([0]), np.array([len(content)]))
    return wkb[0].as_py(), None if np.isnan(boxes[0]).all() else tuple(boxes[0].tolist())


def srid_of(projection: str | None) -> int | None:
    """Number of the coordinate system a ``.prj`` text describes, if it is told.

    The authority code of the whole system counts, which comes last; else its name.
    """
    if not projection:
        return None
    codes = re.findall(r'AUTHORITY\s*\[\s*"EPSG"\s*,\s*"?(\d+)"?\s*\]\s*\]\s*$', projection.strip())
    name = re.match(r'\s*(?:PROJCS|GEOGCS|PROJCRS|GEOGCRS)\s*\[\s*"([^"]*)"', projection, re.I)
    return int(codes[-1]) if codes else SRIDS.get(name[1].upper()) if name else None


def _index(shx: pa.NativeFile, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and content lengths, in bytes, of records ``[first, last)``."""
    entries = np.frombuffer(shx.read_at(8 * (last - first), 100 + 8 * first), ">i4").reshape(-1, 2)
    return entries[:, 0].astype("i8") * 2, entries[:, 1].astype("i8") * 2


def _shapes(shp: pa.NativeFile, shx: pa.NativeFile, first: int, last: int) -> dict[str, pa.Array]:
    """Geometry and box columns of records ``[first, last)``."""
    offsets, lengths = _index(shx, first, last)
    low, high = int(offsets.min()), int((offsets + lengths).max()) + 8
    if low < 100 or (lengths < 4).any() or high > shp.size():
        raise ValueError("the index points outside the shapes")
    wkb, boxes = wkb_of_shapes(np.frombuffer(shp.read_at(high - low, low), "u1"), offsets - low + 8, lengths)
    columns = {"geometry": wkb}
    for i, side in enumerate(BOX):
        columns[side] = pa.array(boxes[:, i], pa.float64(), mask=np.isnan(boxes[:, i]))
    return columns


def shapefile_batches(
    shp: pa.NativeFile, shx: pa.NativeFile, table: pa.NativeFile, schema: pa.Schema,
    options: dict, stem: str, first: int = 0, last: int | None = None, page: bytes | None = None,
    projection: str | None = None,
) -> Iterator[pa.RecordBatch]:
    """Rows of records ``[first, last)`` of an open shapefile.

    ``page`` and ``projection`` are the texts of its ``.cpg`` and ``.prj`` files.
    """
    if struct.unpack(">i", shp.read_at(4, 0))[0] != 9994:
        raise ValueError("no shapefile header")
    count = (shx.size() - 100) // 8
    last = count if last is None else min(last, count)
    header = dbf.read_header(table)
    if header.records != count:
        raise ValueError(f"{count} shapes and {header.records} records")
    if page is not None:
        header.encoding = dbf.code_page(page) or header.encoding
    number = srid_of(projection)
    # Each batch holds about BATCH_BYTES of shapes.
    step = max(1, ranges.BATCH_BYTES * max(count, 1) // max(shp.size(), 1))
    source = options.get("sourcecolumn")
    shaped = any(f.name in ("geometry", *BOX) for f in schema)
    for begin in range(first, last, step):
        end = min(begin + step, last)
        for start, keep, columns in dbf.decode_records(table, header, begin, end, schema, options):
            if shaped:
                columns |= ranges.or_first_fault(
                    lambda a, z: _shapes(shp, shx, a, z), start, start + len(keep), 0, (ValueError, LookupError)
                )
            if any(f.name == "srid" for f in schema) and "srid" not in columns:
                columns["srid"] = pa.array([number] * len(keep), pa.int32())
            if source:
                columns[source] = pa.array([stem] * len(keep), pa.string())
            yield dbf.to_batch(schema, columns, keep)


def shapefile_schema(header: dbf.Header, strict: bool = False, dates_as_text: bool = False) -> T.StructType:
    """Attributes in file order, then geometry, bounding box and coordinate system."""
    return T.StructType(dbf.header_schema(header, strict, dates_as_text).fields + GEOMETRY_FIELDS)


def _piece_batches(piece: ranges.Piece, schema: pa.Schema, options: dict) -> Iterator[pa.RecordBatch]:
    filesystem, plain = ranges.open_fs(piece.path)
    names = {s: dbf.sibling(filesystem, plain, s) for s in (".shx", ".dbf", ".cpg", ".prj")}
    lacking = [s for s in (".shx", ".dbf") if names[s] is None]
    if lacking:
        raise ValueError(f"no {' and no '.join(lacking)} file")
    texts = {}
    for suffix in (".cpg", ".prj"):
        if names[suffix]:
            with filesystem.open_input_file(names[suffix]) as file:
                texts[suffix] = file.read()
    with (
        filesystem.open_input_file(plain) as shp,
        filesystem.open_input_file(names[".shx"]) as shx,
        filesystem.open_input_file(names[".dbf"]) as table,
    ):
        count, size = (shx.size() - 100) // 8, max(shp.size(), 1)
        # The byte share of the .shp file becomes the same share of records.
        first, last = (count * at // size for at in (piece.start, piece.stop))
        yield from shapefile_batches(
            shp, shx, table, schema, options, ranges.stem_of(piece.path), first, last,
            texts.get(".cpg"), texts.get(".prj", b"").decode("latin-1"),
        )


def _fields(path: str, options: dict) -> list[T.StructField]:
    """Attributes of a shapefile, from the header of its table; none without one."""
    filesystem, plain = ranges.open_fs(path)
    table = dbf.sibling(filesystem, plain, ".dbf")
    return dbf.table_fields(path[: len(path) - len(plain)] + table, options) if table else []


FORMAT = scans.Format(".shp", _fields, _piece_batches, (ValueError, LookupError, struct.error), GEOMETRY_FIELDS)


class ShapefileSource(DataSource):
    """``spark.read.format("shapefile").load(path)``; options as for ``dbf``."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> T.StructType:
        return scans.driver_schema(FORMAT, ranges.lower_options(self.options))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return scans.Reader(FORMAT, schema, ranges.lower_options(self.options))


def read_shapefile(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Rows of the shapefiles below a path; without a schema tasks read the headers of all files."""
    return scans.scan(spark, ShapefileSource, FORMAT, path, schema, options)
