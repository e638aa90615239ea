"""Scans of binary files: whole files or none, whatever the split; columns by a job; shapes and WKB in arrays."""

import os
import random
import struct

import formats
import numpy as np
import pyarrow as pa
import pytest

from centerline.functions import geometry
from centerline.sources import dbf, ranges, scans, shapefile

SPLITS = (100, 300, 1 << 20)


def bag(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def spoiled(tmp_path):
    """Three files of 31 records; one has two numbers that cannot be read."""
    fields = [("ID", "N", 6, 0), ("T", "C", 4, 0)]
    for name, bad in (("a", ()), ("b", (17, 25)), ("c", ())):
        records = [[b"x%d" % i if i in bad else b"%d" % i, b"t"] for i in range(31)]
        (tmp_path / f"{name}.dbf").write_bytes(formats.dbf(fields, records))
    return str(tmp_path)


def test_a_bad_record_takes_its_file_along_whatever_the_split(spark, spoiled):
    good = [(i, "t", s, None) for s in "ac" for i in range(31)]
    for split in SPLITS:
        found = bag(dbf.read_dbf(spark, spoiled, splitBytes=split, sourceColumn="src", errorColumn="err"))
        (report,) = [r for r in found if r[3]]
        assert sorted(set(found) - {report}, key=str) == sorted(good, key=str) and len(found) == 63
        assert report[:3] == (None, None, "b") and report[3].startswith("b: ValueError: record 18: ") and "x17" in report[3]
        assert bag(dbf.read_dbf(spark, spoiled, splitBytes=split, mode="DROPMALFORMED")) == sorted([r[:2] for r in good], key=str)
        for options in ({}, {"mode": "FAILFAST"}, {"mode": "FAILFAST", "errorColumn": "err"}):
            with pytest.raises(Exception, match="record 18: .*x17|record 26: .*x25"):
                dbf.read_dbf(spark, spoiled, splitBytes=split, **options).collect()
        # Columns that are not read are not judged.
        assert dbf.read_dbf(spark, spoiled, splitBytes=split, columns="t", mode="DROPMALFORMED").count() == 93


def test_the_format_by_itself_judges_whole_files(spark, spoiled):
    spark.dataSource.register(dbf.DbfSource)
    for split in SPLITS:
        found = spark.read.format("dbf").options(splitBytes=split, mode="DROPMALFORMED").load(spoiled)
        assert found.count() == 62


def test_batches_of_a_whole_file_are_judged_first(tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "BATCH_BYTES", 60)
    fields = [("ID", "N", 6, 0)]
    for bad in (None, 3, 29):
        records = [[b"x" if i == bad else b"%d" % i] for i in range(31)]
        (tmp_path / "a.dbf").write_bytes(formats.dbf(fields, records))
        schema = dbf.header_schema(dbf.read_header(pa.BufferReader(formats.dbf(fields, records)))).add("err", "string")
        reader = scans.Reader(dbf.FORMAT, schema, {"path": str(tmp_path), "errorcolumn": "err"})
        (partition,) = reader.partitions()
        rows = [r for batch in reader.read(partition) for r in batch.to_pylist()]
        if bad is None:
            assert [r["id"] for r in rows] == list(range(31))
        else:
            assert [r["id"] for r in rows] == [None] and f"record {bad + 1}: " in rows[0]["err"]


def test_small_splits_of_many_files_share_tasks():
    for count in (10, 2000, 20_000):
        files = [(f"f{i:05d}", 7900 + i % 3) for i in range(count)]
        tasks = ranges.split_pieces(files, 3200)
        pieces = [(p.path, p.start, p.stop, p.whole) for t in tasks for p in t.pieces]
        assert pieces == [(f, a, min(a + 3200, size), False) for f, size in files for a in (0, 3200, 6400)]
        assert len(tasks) <= 300 and (count > 10 or len(tasks) >= 20)
    # Splits of the usual size stay tasks of their own.
    big = [(f"b{i}", 3 * ranges.SPLIT_BYTES) for i in range(400)]
    assert [len(t.pieces) for t in ranges.split_pieces(big, ranges.SPLIT_BYTES)] == [1] * 1200


def test_a_bad_shape_takes_its_file_along(spark, tmp_path):
    for name, bad in (("tl_2025_06001_edges", None), ("tl_2025_06003_edges", 30)):
        shapes = [formats.poly(3, [[(i, 0), (i + 1, i)]]) for i in range(40)]
        if bad is not None:
            shapes[bad] = struct.pack("<i", 99) + shapes[bad][4:]
        shp, shx = formats.shapefile(3, shapes)
        for suffix, content in (("shp", shp), ("shx", shx), ("dbf", formats.dbf([("TLID", "N", 10, 0)], [[b"%d" % i] for i in range(40)]))):
            (tmp_path / f"{name}.{suffix}").write_bytes(content)
    for split in (500, 1 << 20):
        found = shapefile.read_shapefile(spark, str(tmp_path), splitBytes=split, errorColumn="err", sourceColumn="src")
        assert sorted(r.tlid for r in found.where("err IS NULL").collect()) == list(range(40))
        (row,) = found.where("err IS NOT NULL").collect()
        assert row.src == "tl_2025_06003_edges" and "record 31: shape type 99" in row.err
        assert shapefile.read_shapefile(spark, str(tmp_path), splitBytes=split, mode="DROPMALFORMED").count() == 40
    # A scan that needs no shapes does not look at them.
    assert shapefile.read_shapefile(spark, str(tmp_path), columns="tlid", mode="DROPMALFORMED").count() == 80


def test_whole_numbers_with_a_point_are_read_by_themselves(spark, tmp_path):
    fields = [("N", "N", 18, 0)]
    records = [[b"9007199254740993"], [b"1.0"], [b"2e3"], [b"-7"], [b""]]
    (tmp_path / "a.dbf").write_bytes(formats.dbf(fields, records))
    for split in (40, 1 << 20):
        got = [r.n for r in dbf.read_dbf(spark, str(tmp_path), splitBytes=split).collect()]
        assert sorted(got, key=str) == sorted([9007199254740993, 1, 2000, -7, None], key=str)


def test_headers_of_many_files_are_read_by_tasks(spark, tmp_path, monkeypatch):
    for i in range(10_000):
        width = 3 + i % 7
        (tmp_path / f"f{i:05d}.dbf").write_bytes(formats.dbf([("ID", "N", 9, 0), (f"C{i % 5}", "C", width, 0)], [[b"%d" % i, b"v"]]))
    (tmp_path / "bad.dbf").write_bytes(b"short")

    real, driver = dbf.read_header, os.getpid()

    def watched(*args, **options):
        assert os.getpid() != driver, "a header was read on the driver"
        return real(*args, **options)

    monkeypatch.setattr(dbf, "read_header", watched)
    frame = dbf.read_dbf(spark, str(tmp_path), mode="DROPMALFORMED")
    assert frame.columns == ["id", "c0", "c1", "c2", "c3", "c4"]
    assert frame.count() == 10_000 and frame.where("c3 = 'v'").count() == 2000


# Shapes


def ring(rng, cx, cy, r, clockwise):
    n = rng.randint(3, 9)
    angles = [2 * np.pi * i / n for i in range(n)]
    points = [(cx + r * float(np.cos(a)), cy + r * float(np.sin(a))) for a in angles]
    points = points[::-1] if clockwise else points
    return [*points, points[0]]


def area(points):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:])) / 2


def holds(points, p):
    inside = False
    for (xa, ya), (xb, yb) in zip(points, points[1:]):
        if (ya > p[1]) != (yb > p[1]) and p[0] < xa + (p[1] - ya) * (xb - xa) / (yb - ya):
            inside = not inside
    return inside


def expected(kind, parts):
    """Nested coordinates of a shape, one ring after the other."""
    if kind in (3, 13, 23):
        lines = [(2, p) for p in parts]
        return lines[0] if len(lines) == 1 else (5, lines)
    shells = [i for i, p in enumerate(parts) if area(p) <= 0] or [0]
    own = {i: [parts[i]] for i in shells}
    for i, p in enumerate(parts):
        if i not in own:
            around = [s for s in shells if holds(parts[s], p[0])] or shells[:1]
            own[min(around, key=lambda s: abs(area(parts[s])))].append(p)
    bodies = [(3, rings) for rings in own.values()]
    return bodies[0] if len(bodies) == 1 else (6, bodies)


def test_a_batch_of_shapes_of_all_kinds():
    rng = random.Random(7)
    shapes, want = [], []
    for _ in range(1500):
        kind = rng.choice([0, 1, 8, 3, 13, 23, 5, 5, 15, 25])
        if kind == 0:
            shapes.append(formats.null_shape())
            want.append(None)
        elif kind == 1:
            p = (rng.random(), rng.random())
            shapes.append(formats.point(*p))
            want.append((1, p))
        elif kind == 8:
            points = [(rng.random(), rng.random()) for _ in range(rng.randint(1, 5))]
            shapes.append(struct.pack("<i4di", 8, 0, 0, 1, 1, len(points)) + b"".join(struct.pack("<2d", *p) for p in points))
            want.append((4, [(1, p) for p in points]))
        else:
            if kind in (3, 13, 23):
                parts = [[(rng.random(), rng.random()) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
            else:
                parts = []
                for _ in range(rng.randint(1, 3)):
                    x, y = rng.randint(0, 3) * 4, rng.randint(0, 3) * 4
                    parts.append(ring(rng, x, y, 2, True))
                    parts += [ring(rng, x, y, 1.6, True)] * (rng.random() < 0.4)
                    parts += [ring(rng, x + rng.uniform(-0.5, 0.5), y, 0.2, False) for _ in range(rng.randint(0, 3))]
                if rng.random() < 0.2:
                    parts = [ring(rng, 0, 0, 1, False) for _ in range(rng.randint(1, 3))]
                rng.shuffle(parts)
            shapes.append(formats.poly(kind, parts))
            want.append(expected(kind, parts))
    shapes.append(struct.pack("<i4d2i", 5, 0, 0, 0, 0, 0, 0))
    want.append(None)
    sizes = np.array([len(s) for s in shapes])
    data = np.frombuffer(b"".join(b"a record" + s for s in shapes), "u1")
    wkb, boxes = shapefile.wkb_of_shapes(data, np.cumsum(sizes + 8) - sizes, sizes)
    assert [b and formats.read_wkb(b) for b in wkb.to_pylist()] == want
    for shape, box, w in zip(shapes, boxes, want):
        if w is None:
            assert np.isnan(box).all()
        elif w[0] != 1:
            assert tuple(box) == struct.unpack_from("<4d", shape, 4)


@pytest.mark.parametrize("spoil, message", [
    (lambda s: s[:30], "cut off"), (lambda s: s[:40] + struct.pack("<i", 10**6) + s[44:], "cut off"),
    (lambda s: s[:44] + struct.pack("<2i", 2, 0) + s[52:], "out of order"), (lambda s: b"\x09" + s[1:], "shape type 9"),
])
def test_broken_shapes(spoil, message):
    whole = formats.poly(5, [ring(random.Random(1), 0, 0, 2, True), ring(random.Random(1), 0, 0, 1, False)])
    with pytest.raises(ValueError, match=message):
        shapefile.shape_to_wkb(spoil(whole))


def some_wkb(rng, depth=0):
    def points(n):
        return b"".join(struct.pack("<2d", rng.random(), rng.random()) for _ in range(n))

    def many(kind, member):
        n = rng.randint(0, 4)
        return struct.pack("<BII", 1, kind, n) + b"".join(member() for _ in range(n))

    def point():
        return struct.pack("<BI", 1, 1) + points(1)

    def line():
        n = rng.randint(0, 5)
        return struct.pack("<BII", 1, 2, n) + points(n)

    def polygon():
        rings = [rng.randint(0, 6) for _ in range(rng.randint(0, 4))]
        return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", n) + points(n) for n in rings)

    kinds = [point, line, polygon, lambda: many(4, point), lambda: many(5, line), lambda: many(6, polygon)]
    if depth < 3:
        kinds.append(lambda: many(7, lambda: some_wkb(rng, depth + 1)))
    return rng.choice(kinds)()


def plain_runs(blob):
    def parts(value):
        return [p for member in value[1] for p in parts(member)] if value[0] > 3 else [value]

    out = []
    for number, (kind, items) in enumerate(parts(formats.read_wkb(blob))):
        for place, points in enumerate(items if kind == 3 else [[items] if kind == 1 else items]):
            out.append({"part": number, "ring": place, "xy": [c for p in points for c in p]})
    return out


def test_runs_of_every_wkb_type():
    rng = random.Random(3)
    blobs = [some_wkb(rng) for _ in range(1500)]
    want = [plain_runs(b) for b in blobs]
    broken = [
        None, b"", b"\x01", b"\0" + blobs[0][1:], blobs[1] + b"x", b"\x01\x09\0\0\0\0\0\0\0", b"\x01\x02\0\0\0\xff\xff\xff\xff",
        *(b[:-1] for b in blobs[:300]),
    ]
    for i, b in enumerate(broken):
        blobs.insert(4 * i, b)
        want.insert(4 * i, None)
    column = pa.array(blobs, pa.binary())
    assert geometry._wkb_to_runs(column).to_pylist() == want
    flat = [None if w is None else [c for run in w for c in run["xy"]] for w in want]
    assert geometry._wkb_to_coordinates(column[5:]).to_pylist() == flat[5:]
    assert geometry._wkb_to_runs(column[:0]).to_pylist() == []
