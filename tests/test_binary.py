import datetime
import decimal
import io
import os
import struct
import zipfile

import formats
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centerline.functions import geometry
from centerline.operators import consolidate
from centerline.plans import import_streets
from centerline.sources import archive_tables, dbf, files, shapefile

FIELDS = [("CODE", "C", 6, 0), ("WHOLE", "N", 8, 0), ("PART", "N", 10, 3), ("REAL", "F", 12, 4),
          ("INT4", "I", 4, 0), ("DAY", "D", 8, 0), ("FLAG", "L", 1, 0), ("MEMO", "M", 4, 0)]
RECORDS = [
    [b"00501", b"42", b"1.250", b"-2.5", struct.pack("<i", -7), b"20250131", b"T", b"m"],
    [b"", b"", b"", b"", struct.pack("<i", 0), b"", b"?", b""],
    [b"gone", b"1", b"1", b"1", struct.pack("<i", 1), b"20250101", b"F", b""],
    ["né".encode(), b"-3", b"***", b"1e3", struct.pack("<i", 2**31 - 1), b"00000000", b"n", b""],
]
WANT = [
    ("00501", 42, 1.25, -2.5, -7, datetime.date(2025, 1, 31), True, "m"),
    (None, None, None, None, 0, None, None, None),
    ("né", -3, None, 1000.0, 2**31 - 1, None, False, None),
]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_dbf_types_blanks_and_deleted_records(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(formats.dbf(FIELDS, RECORDS, deleted={2}))
    frame = dbf.read_dbf(spark, str(tmp_path))
    assert frame.dtypes == [
        ("code", "string"), ("whole", "bigint"), ("part", "double"), ("real", "double"), ("int4", "int"),
        ("day", "date"), ("flag", "boolean"), ("memo", "string"),
    ]
    assert rows(frame) == sorted(WANT, key=str)
    strict = dbf.read_dbf(spark, str(tmp_path), strictTypes="true", columns="whole,day", datesAsText="true")
    assert strict.dtypes == [("whole", "double"), ("day", "string")]
    assert ("2025-01-31" in {r.day for r in strict.collect()})
    assert {r.code for r in dbf.read_dbf(spark, str(tmp_path), blankAsNull="false").collect()} == {"00501", "", "né"}


def test_dbf_code_pages(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(formats.dbf([("C", "C", 4, 0)], [["né".encode("latin-1")], [b"x"]]))
    assert rows(dbf.read_dbf(spark, str(tmp_path))) == [("né",), ("x",)]
    (tmp_path / "a.dbf").write_bytes(formats.dbf([("C", "C", 4, 0)], [["é".encode("cp437")]]))
    assert rows(dbf.read_dbf(spark, str(tmp_path), encoding="cp437")) == [("é",)]


def test_dbf_splits_small_files_and_errors(spark, tmp_path):
    fields = [("ID", "N", 9, 0), ("T", "C", 20, 0)]
    for n in range(3):
        (tmp_path / f"f{n}.dbf").write_bytes(formats.dbf(fields, [[b"%d" % (n * 1000 + i), b"x%d" % i] for i in range(1000)]))
    (tmp_path / "zero.dbf").write_bytes(formats.dbf(fields, []))
    (tmp_path / "wide.dbf").write_bytes(formats.dbf([("T", "C", 5, 0), ("EXTRA", "C", 3, 0)], [[b"w", b"q"]]))
    frame = dbf.read_dbf(spark, str(tmp_path), splitBytes=777)
    assert frame.rdd.getNumPartitions() > 20
    assert sorted(r.id for r in frame.collect() if r.id is not None) == list(range(3000))
    assert [tuple(r) for r in frame.where("id IS NULL").collect()] == [(None, "w", "q")]
    assert dbf.read_dbf(spark, str(tmp_path)).rdd.getNumPartitions() == 1

    (tmp_path / "bad.dbf").write_bytes(b"short")
    reported = dbf.read_dbf(spark, str(tmp_path), sourceColumn="src", errorColumn="err")
    (bad,) = reported.where("err IS NOT NULL").collect()
    assert bad.src == "bad" and "no DBF header" in bad.err
    assert reported.where("src = 'f1'").count() == 1000
    assert dbf.read_dbf(spark, str(tmp_path), mode="DROPMALFORMED").count() == 3001
    with pytest.raises(Exception, match="no DBF header"):
        dbf.read_dbf(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="no DBF header"):
        dbf.read_dbf(spark, str(tmp_path), mode="FAILFAST").count()


def test_dbf_names_narrow_the_scan(spark, tmp_path):
    fields = [("ID", "N", 9, 0)]
    for n, name in enumerate(("tl_2025_13001_addr", "tl_2025_06001_addr", "tl_2025_06001_featnames")):
        (tmp_path / f"{name}.dbf").write_bytes(formats.dbf(fields, [[b"%d" % n]]))
    assert rows(dbf.read_dbf(spark, str(tmp_path), state="6", dataset="addr")) == [(1,)]
    assert rows(dbf.read_dbf(spark, str(tmp_path / "tl_2025_13001_addr.dbf"))) == [(0,)]


SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]  # clockwise: a shell
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
FAR = [(10.0, 0.0), (10.0, 1.0), (11.0, 1.0), (11.0, 0.0), (10.0, 0.0)]


@pytest.mark.parametrize("kind, content, want, box", [
    (0, formats.null_shape(), None, None),
    (1, formats.point(1.5, -2.0), (1, (1.5, -2.0)), (1.5, -2.0, 1.5, -2.0)),
    (3, formats.poly(3, [[(0, 0), (1, 2)]]), (2, [(0, 0), (1, 2)]), (0, 0, 1, 2)),
    (3, formats.poly(3, [[(0, 0), (1, 2)], [(5, 5), (6, 6), (7, 5)]]),
     (5, [(2, [(0, 0), (1, 2)]), (2, [(5, 5), (6, 6), (7, 5)])]), (0, 0, 7, 6)),
    (5, formats.poly(5, [SQUARE, HOLE]), (3, [SQUARE, HOLE]), (0, 0, 4, 4)),
    (5, formats.poly(5, [FAR, SQUARE, HOLE]), (6, [(3, [FAR]), (3, [SQUARE, HOLE])]), (0, 0, 11, 4)),
])
def test_shapes(kind, content, want, box):
    wkb, got_box = shapefile.shape_to_wkb(content)
    assert (formats.read_wkb(wkb) if wkb else None, got_box) == (want, box)


def write_shapefile(folder, name, shapes, records, fields=(("TLID", "N", 10, 0), ("STATEFP", "C", 2, 0)), kind=3):
    shp, shx = formats.shapefile(kind, shapes)
    members = {f"{name}.shp": shp, f"{name}.shx": shx, f"{name}.dbf": formats.dbf(list(fields), records)}
    if folder is not None:
        for member, content in members.items():
            (folder / member).write_bytes(content)
    return members


def test_shapefile_scan(spark, tmp_path):
    shapes = [formats.poly(3, [[(i, 0), (i + 1, i)]]) for i in range(500)]
    shapes[7] = formats.null_shape()
    write_shapefile(tmp_path, "tl_2025_06001_edges", shapes, [[b"%d" % i, b"06"] for i in range(500)])
    frame = shapefile.read_shapefile(spark, str(tmp_path), splitBytes=4000, sourceColumn="src")
    assert frame.columns == ["tlid", "statefp", "geometry", "xmin", "ymin", "xmax", "ymax", "srid", "src"]
    assert frame.rdd.getNumPartitions() > 5
    got = {r.tlid: r for r in frame.collect()}
    assert sorted(got) == list(range(500))
    assert got[7].geometry is None and got[7].xmin is None and got[7].statefp == "06"
    assert formats.read_wkb(got[20].geometry) == (2, [(20, 0), (21, 20)])
    assert tuple(got[20])[3:7] == (20, 0, 21, 20)
    only = shapefile.read_shapefile(spark, str(tmp_path), columns="tlid")
    assert only.columns == ["tlid"] and only.count() == 500


def test_points_as_wkb(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (-0.5, 1e300)], "x double, y double")
    coded = frame.select("x", "y", geometry.point_wkb(F.col("x"), F.col("y")).alias("wkb"))
    blobs = [r.wkb for r in coded.collect()]
    assert blobs[1] is None and formats.read_wkb(blobs[2]) == (1, (-0.5, 1e300))
    back = coded.select(geometry.wkb_point(F.col("wkb")).alias("p")).collect()
    assert [tuple(r.p) for r in back] == [(1.0, 2.0), (None, None), (-0.5, 1e300)]


def test_geometry_at_the_edge(spark):
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:
        wkb = geometry.point_wkb(F.lit(1.5), F.lit(-2.0))
        one = spark.range(1).select(wkb.alias("wkb")).select("wkb", geometry.to_geometry(F.col("wkb")).alias("g"))
        row = one.select(F.expr("st_srid(g)").alias("srid"), F.expr("st_asbinary(g)").alias("back"), "wkb").first()
        assert row.srid == 4326 and row.back == row.wkb
    finally:
        spark.conf.unset("spark.sql.geospatial.enabled")


def test_grid_cells_against_bits(spark):
    def want(x, y):
        a, b = (int(v // 0.5) + 2**19 for v in (x, y))
        return sum(((a >> i & 1) << 2 * i) | ((b >> i & 1) << (2 * i + 1)) for i in range(20))

    points = [(-122.25, 37.75), (0.0, 0.0), (179.9, -89.9), (-0.1, 0.6)]
    frame = spark.createDataFrame(points, "x double, y double")
    got = [r[0] for r in frame.select(geometry.grid_cell(F.col("x"), F.col("y"), 0.5)).collect()]
    assert got == [want(*p) for p in points]


@pytest.fixture
def archive_dir(tmp_path):
    root = tmp_path / "zips"
    (root / "deep").mkdir(parents=True)
    addr = [("TLID", "N", 10, 0), ("FROMHN", "C", 12, 0), ("TOHN", "C", 12, 0), ("SIDE", "C", 1, 0), ("ZIP", "C", 5, 0), ("PLUS4", "C", 4, 0)]
    edge = [("STATEFP", "C", 2, 0), ("COUNTYFP", "C", 3, 0), ("TLID", "N", 10, 0), ("FULLNAME", "C", 20, 0), ("ZIPL", "C", 5, 0),
            ("MTFCC", "C", 5, 0)]
    for state, county, folder in (("13", "001", root), ("13", "003", root / "deep"), ("06", "001", root)):
        ids = [int(state + county) * 10 + i for i in range(3)]
        base = f"tl_2025_{state}{county}"
        table = formats.dbf(addr, [[b"%d" % i, b"1", b"99", b"L", b"00501", b""] for i in ids])
        (folder / f"{base}_addr.zip").write_bytes(formats.archive({f"{base}_addr.dbf": table}))
        shapes = [formats.poly(3, [[(i, 1), (i + 1, 2)]]) for i in range(3)]
        members = write_shapefile(None, f"{base}_edges", shapes, [
            [state.encode(), county.encode(), b"%d" % i, b"Main St", b"00501", b"S1400"] for i in ids
        ], edge)
        (folder / f"{base}_edges.zip").write_bytes(formats.archive({**members, f"{base}_edges.prj": b"GEOGCS"}))
    (root / "tl_2025_13005_addr.zip").write_bytes(b"this is no archive")
    (root / "tl_2025_13007_addr.zip").write_bytes(formats.archive({"readme.txt": b"nothing"}))
    (root / "tl_2025_13001_addrfeat.zip").write_bytes(formats.archive({"tl_2025_13001_addrfeat.dbf": b"bad"}))
    return root


def test_inventory_and_archives(spark, archive_dir):
    root = str(archive_dir)
    flat = files.list_archives(spark, root)
    assert flat.count() == 7 and files.list_archives(spark, root, recursive=True).count() == 9
    some = files.list_archives(spark, root, True, state="13", dataset="addr")
    assert sorted(r.name for r in some.collect()) == [
        "tl_2025_13001_addr.zip", "tl_2025_13001_addrfeat.zip", "tl_2025_13003_addr.zip",
        "tl_2025_13005_addr.zip", "tl_2025_13007_addr.zip",
    ]
    relative = some.select(files.relative_path(F.col("path"), root).alias("p")).collect()
    assert "deep/tl_2025_13003_addr.zip" in {r.p for r in relative}
    os.utime(archive_dir / "tl_2025_06001_addr.zip", (4e9, 4e9))
    assert files.newest_file(files.list_files(spark, root)).first().name == "tl_2025_06001_addr.zip"
    assert "content" not in files.list_files(spark, root).columns

    members = files.expand_archives(files.list_archives(spark, root, True, "13", "addr"))
    got = sorted((r.archive.rsplit("/", 1)[1], r.member, r.error is None) for r in members.collect())
    assert got == [
        ("tl_2025_13001_addr.zip", "tl_2025_13001_addr.dbf", True),
        ("tl_2025_13001_addrfeat.zip", "tl_2025_13001_addrfeat.dbf", True),
        ("tl_2025_13003_addr.zip", "tl_2025_13003_addr.dbf", True),
        ("tl_2025_13005_addr.zip", None, False),
        ("tl_2025_13007_addr.zip", "readme.txt", True),
    ]


def test_archives_are_shared_out_by_table_and_faults_stay_apart(spark, tmp_path):
    tables = {f"tl_2025_13{n:03d}_addr.dbf": formats.dbf([("TLID", "N", 9, 0)], [[b"%d" % n]]) for n in range(4)}
    raw = bytearray(formats.archive(tables))
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        info = archive.infolist()[2]
        raw[info.header_offset + 30 + len(info.filename) + 3] ^= 0xFF  # spoils one member
    (tmp_path / "tl_2025_13999_addr.zip").write_bytes(bytes(raw))
    listing = files.list_archives(spark, str(tmp_path))
    assert files.archive_units(listing).count() == 4
    got = archive_tables.read_tables(listing, archive_tables.archive_schema(listing))
    assert sorted(r.tlid for r in got.where("error IS NULL").collect()) == [0, 1, 3]
    assert [r.source_table for r in got.where("error IS NOT NULL").collect()] == ["tl_2025_13002_addr"]
    members = files.expand_archives(listing)
    assert members.where("error IS NULL").count() == 3
    assert [r.member for r in members.where("error IS NOT NULL").collect()] == ["tl_2025_13002_addr.dbf"]


def test_short_files_are_errors(spark, tmp_path):
    whole = formats.dbf([("ID", "N", 9, 0)], [[b"%d" % i] for i in range(10)])
    (tmp_path / "cut.dbf").write_bytes(whole[:-50])
    with pytest.raises(Exception, match="cut off"):
        dbf.read_dbf(spark, str(tmp_path)).count()
    (row,) = dbf.read_dbf(spark, str(tmp_path), errorColumn="err").collect()
    assert "cut off" in row.err
    shapes = [formats.poly(3, [[(i, 0), (i + 1, i)]]) for i in range(10)]
    (tmp_path / "s").mkdir()
    write_shapefile(tmp_path / "s", "tl_2025_06001_edges", shapes, [[b"%d" % i, b"06"] for i in range(6)])
    with pytest.raises(Exception, match="10 shapes and 6 records"):
        shapefile.read_shapefile(spark, str(tmp_path / "s")).count()
    (tmp_path / "s" / "tl_2025_06001_edges.shx").unlink()
    with pytest.raises(Exception, match="no .shx file"):
        shapefile.read_shapefile(spark, str(tmp_path / "s")).count()


def test_encoding_comes_from_the_file(spark, tmp_path):
    fields = [("C", "C", 4, 0)]
    raw = bytearray(formats.dbf(fields, [["né".encode("cp850")]]))
    raw[29] = 0x02
    (tmp_path / "a.dbf").write_bytes(bytes(raw))
    assert rows(dbf.read_dbf(spark, str(tmp_path))) == [("né",)]
    (tmp_path / "a.dbf").write_bytes(formats.dbf(fields, [["ż".encode("cp1250")]]))
    (tmp_path / "a.cpg").write_text("1250")
    assert rows(dbf.read_dbf(spark, str(tmp_path))) == [("ż",)]
    (tmp_path / "a.cpg").write_text("UTF-8")
    assert rows(dbf.read_dbf(spark, str(tmp_path), encoding="cp1250")) == [("ż",)]
    # A value that is cut inside a character leaves the others alone.
    (tmp_path / "a.cpg").unlink()
    (tmp_path / "a.dbf").write_bytes(formats.dbf(fields, [["né".encode()], [b"abc\xc3"], ["é".encode()]]))
    for size in (1, 1000):
        assert {r.c for r in dbf.read_dbf(spark, str(tmp_path), splitBytes=size).collect()} == {"né", "abcÃ", "é"}
    assert [dbf.code_page(x) for x in (b"", b"utf8\n", b"ISO 88591", b"ANSI 1252", b"OEM 850", b"8859-2")] == [
        None, "utf-8", "iso8859-1", "cp1252", "cp850", "iso8859-2"
    ]


def test_headers_of_all_files_are_merged(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(formats.dbf([("N", "N", 3, 0), ("C", "C", 4, 0), ("X", "N", 4, 0)], [[b"7", b"a", b"1"]]))
    (tmp_path / "b.dbf").write_bytes(formats.dbf([("N", "N", 5, 2), ("X", "C", 4, 0), ("Y", "D", 8, 0)], [[b"1.25", b"t", b"20250102"]]))
    frame = dbf.read_dbf(spark, str(tmp_path))
    assert frame.dtypes == [("n", "double"), ("c", "string"), ("x", "string"), ("y", "date")]
    assert rows(frame) == sorted([(7.0, "a", "1", None), (1.25, None, "t", datetime.date(2025, 1, 2))], key=str)


def test_wide_numbers_keep_their_digits(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(formats.dbf([("N", "N", 20, 0)], [[b"12345678901234567891"], [b""]]))
    frame = dbf.read_dbf(spark, str(tmp_path))
    assert frame.dtypes == [("n", "decimal(20,0)")]
    assert rows(frame) == sorted([(decimal.Decimal("12345678901234567891"),), (None,)], key=str)


@pytest.mark.parametrize("text, want", [
    ('GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983"]]', 4269),
    ('GEOGCS["WGS 84",DATUM["WGS_1984",AUTHORITY["EPSG","6326"]],AUTHORITY["EPSG","4326"]]', 4326),
    ('PROJCS["Mine",GEOGCS["WGS 84",AUTHORITY["EPSG","4326"]],UNIT["metre",1]]', None), ("", None), (None, None),
])
def test_srid_of_projection(text, want):
    assert shapefile.srid_of(text) == want


def test_table_that_fails_midway_gives_no_rows(spark, tmp_path, monkeypatch):
    shapes = [formats.poly(3, [[(0, 0), (1, 1)]]), b"\x63\0\0\0" + bytes(40)]
    members = write_shapefile(None, "tl_2025_13001_edges", shapes, [[b"1", b"13"], [b"2", b"13"]])
    (tmp_path / "tl_2025_13001_edges.zip").write_bytes(formats.archive(members))
    listing = files.list_archives(spark, str(tmp_path))
    (row,) = archive_tables.read_tables(listing, archive_tables.archive_schema(listing)).collect()
    assert row.source_table == "tl_2025_13001_edges" and "shape type 99" in row.error


def test_tables_of_archives(spark, archive_dir):
    archives = files.list_archives(spark, str(archive_dir), True, "13", "addr")
    schema = T.StructType([T.StructField("tlid", T.LongType()), T.StructField("zip", T.StringType())])
    got = archive_tables.read_tables(archives, schema)
    assert sorted(r.tlid for r in got.where("error IS NULL").collect()) == [
        130010, 130011, 130012, 130030, 130031, 130032,
    ]
    bad = {r.source_table for r in got.where("error IS NOT NULL").collect()}
    assert bad == {"tl_2025_13005_addr", "tl_2025_13001_addrfeat"}


def test_import_from_archives_to_tables(spark, archive_dir, tmp_path, database):
    root, out = str(archive_dir), str(tmp_path / "out")
    counts = import_streets.import_streets(spark, root, out, database, ("edges", "addr"), year="2025")
    assert sorted(tuple(r) for r in counts.collect()) == [("addr", 9), ("edges", 9)]
    edges = spark.table(f"{database}.edges")
    assert {"geometry", "xmin", "ymin", "xmax", "ymax", "srid", "mtfcc"} <= set(edges.columns)
    (row,) = edges.where("tlid = 60011").collect()
    assert (row.statefp, row.countyfp, row.zipl, row.mtfcc) == ("06", "001", "00501", "S1400")
    assert formats.read_wkb(row.geometry) == (2, [(1, 1), (2, 2)])
    failed = import_streets.load_errors(spark, f"{out}/addr").collect()
    assert {r.source_table for r in failed} == {"tl_2025_13005_addr", "tl_2025_13001_addrfeat"}
    # An archive that cannot be read any more leaves what was loaded alone.
    spoiled = archive_dir / "tl_2025_13001_addr.zip"
    whole = spoiled.read_bytes()
    spoiled.write_bytes(b"this is no archive")
    import_streets.load_dataset(spark, root, out, "addr")
    assert import_streets.loaded_rows(spark, f"{out}/addr", "addr").count() == 9
    failed = {r.source_table for r in import_streets.load_errors(spark, f"{out}/addr").collect()}
    assert failed == {"tl_2025_13001_addr", "tl_2025_13005_addr", "tl_2025_13001_addrfeat"}
    spoiled.write_bytes(whole)
    # Loading one state again replaces its counties and leaves the others.
    import_streets.load_dataset(spark, root, out, "addr", state="13")
    assert import_streets.loaded_rows(spark, f"{out}/addr", "addr").count() == 9
    kept = consolidate.read_partitions(spark, f"{out}/addr", import_streets.FILE_KEYS)
    assert {r.file_state for r in kept.select("file_state").distinct().collect()} == {"06", "13"}
