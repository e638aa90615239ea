import pytest
from pyspark.sql import functions as F

from centerline.functions import names, typemap
from centerline.operators import inventory
from centerline.sources import dims


def values(spark, rows, schema, **columns):
    frame = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in frame.select(*[c.alias(n) for n, c in columns.items()]).collect()]


@pytest.mark.parametrize("stem, want", [
    ("tl_2025_13001_edges", ("2025", "13", "001", "edges")),
    ("tl_2025_13001", ("2025", "13", "001", None)),
    ("tl_2025_13001_addr.shp", ("2025", "13", "001", "addr")),
    ("tl_2025_13001_edges_v2", ("2025", "13", "001", "edges_v2")),
    ("tl_2025_130011_faces", ("2025", "13", "001", None)),
    ("tl_2025_06_place", None),
    ("tl_2025_us_state", None),
    ("xtl_2025_13001_edges", None),
])
def test_parse_name(spark, stem, want):
    ((got,),) = values(spark, [(stem,)], "s string", p=names.parse_name(F.col("s")))
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize("name, want", [
    ("a.zip", "a"), ("a.b.zip", "a.b"), (".hidden", ".hidden"), ("plain", "plain"), ("a.", "a."),
])
def test_file_stem(spark, name, want):
    assert values(spark, [(name,)], "s string", p=names.file_stem(F.col("s"))) == [(want,)]


@pytest.mark.parametrize("state, name, keep", [
    ("13", "tl_2025_13001_edges.zip", True),
    ("13", "tl_2025_013001_edges.zip", True),
    ("13", "x_tl_2025_13001_edges.zip", True),
    ("13", "tl_2025_13_place.zip", False),
    ("13", "tl_2025_us_state.zip", False),
    ("13", "tl_2025_130011_edges.zip", False),
    ("13", "tl_2025_13001.zip", False),
    ("6", "tl_2025_06001_edges.zip", True),
    (".3", "tl_2025_13001_edges.zip", False),
])
def test_state_in_name(spark, state, name, keep):
    assert values(spark, [(name,)], "s string", k=names.in_state(F.col("s"), state)) == [(keep,)]


def test_dataset_and_table_tests(spark):
    rows = [("tl_2025_13001_addrfeat.zip",), ("tl_2025_13001_ADDR.zip",), ("tlx2025_addr",)]
    got = values(spark, rows, "s string", d=names.of_dataset(F.col("s"), "addr"),
                 t=names.table_of_type(F.col("s"), "addr"))
    assert got == [(True, False), (False, False), (True, True)]


@pytest.mark.parametrize("dataset, tail", [
    ("EDGES", "EDGES/tl_2025_06001_edges.zip"),
    ("TRACT", "TRACT/tl_2025_06_tract.zip"),
    ("COUNTY", "COUNTY/tl_2025_06_county.zip"),
    ("STATE", "STATE/tl_2025_us_state.zip"),
    ("ZCTA520", "ZCTA520/tl_2025_06_zcta520.zip"),
    ("edges", "EDGES/tl_2025_06_edges.zip"),
])
def test_file_url(spark, dataset, tail):
    url = names.file_url(F.lit(2025), F.lit("06"), F.lit("001"), F.col("d"))
    path = names.target_path("out", F.lit("06"), url)
    got = values(spark, [(dataset,)], "d string", u=url, p=path)
    assert got == [(f"{names.BASE_URL}2025/{tail}", "out/06/" + tail.split("/")[1])]


def test_describe_files(spark):
    paths = [
        "2024/06/001/roads/notes.txt", "2024/06/x", "2024/06/12/a", "2024/6/001/a/b",
        "2024/06/001/EDGES/tl_2025_13001_edges.shp", "tl_2025_13001.dbf", "readme",
        "2024/06/00123/f", "2024/06",
    ]
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: tuple(r)[1:] for r in inventory.describe_files(rows).collect()}
    no = (False, False)
    assert got == {
        paths[0]: ("2024", "06", "001", None, "roads", *no),
        paths[1]: ("2024", "06", None, None, None, *no),
        paths[2]: ("2024", "06", None, None, "a", *no),
        paths[3]: (None, None, None, None, None, *no),
        paths[4]: ("2025", "13", "001", "edges", None, True, True),
        paths[5]: ("2025", "13", "001", None, None, True, True),
        paths[6]: (None, None, None, None, None, *no),
        paths[7]: ("2024", "06", "00123", None, "f", *no),
        paths[8]: ("2024", "06", None, None, None, *no),
    }
    total = [r for r in inventory.count_files(inventory.describe_files(rows)).collect() if r.level == 1]
    assert [r.n_files for r in total] == [len(paths)]


def test_layouts(spark):
    rows = spark.createDataFrame([
        ("a/tl_2025_13001_EDGES.dbf",), ("b/tl_2025_13001_EDGES.dbf",), ("tl_2025_13001.dbf",),
        ("2025/EDGES/tl_2025_13003_EDGES.dbf",), ("readme.txt",),
    ], "path string")

    def plan(layout):
        return sorted(tuple(r) for r in inventory.plan_layout(rows, layout).collect())

    assert plan("year_statecounty") == [
        ("2025/EDGES/tl_2025_13003_EDGES.dbf", "2025/13003/tl_2025_13003_EDGES.dbf", 1),
        ("a/tl_2025_13001_EDGES.dbf", "2025/13001/tl_2025_13001_EDGES.dbf", 2),
        ("b/tl_2025_13001_EDGES.dbf", "2025/13001/tl_2025_13001_EDGES.dbf", 2),
        ("tl_2025_13001.dbf", "2025/13001/tl_2025_13001.dbf", 1),
    ]
    assert [d for _, d, _ in plan("year_state_type")] == [
        "2025/13/EDGES/tl_2025_13003_EDGES.dbf", *["2025/13/EDGES/tl_2025_13001_EDGES.dbf"] * 2,
    ]
    assert plan("year_type") == [
        ("a/tl_2025_13001_EDGES.dbf", "2025/EDGES/tl_2025_13001_EDGES.dbf", 2),
        ("b/tl_2025_13001_EDGES.dbf", "2025/EDGES/tl_2025_13001_EDGES.dbf", 2),
    ]
    clash = inventory.layout_collisions(inventory.plan_layout(rows, "year_type")).collect()
    assert [tuple(r) for r in clash] == [
        ("2025/EDGES/tl_2025_13001_EDGES.dbf", 2, "a/tl_2025_13001_EDGES.dbf")
    ]
    with pytest.raises(ValueError):
        inventory.plan_layout(rows, "flat")


def test_standalone_dbf(spark):
    rows = spark.createDataFrame([("x/a.shp",), ("y/a.dbf",), ("y/b.dbf",), ("z/b.dbf",)], "path string")
    assert sorted(r.path for r in inventory.standalone_dbf(rows).collect()) == ["y/b.dbf", "z/b.dbf"]
    # The shapefile of another state is not seen, and neither is its table.
    rows = spark.createDataFrame([
        ("tl_2025_13001_edges.shp",), ("tl_2025_13001_edges.dbf",), ("tl_2025_13001_addr.dbf",),
        ("tl_2025_06001_addr.dbf",),
    ], "path string")
    got = [r.path for r in inventory.standalone_dbf(rows, state="13").collect()]
    assert got == ["tl_2025_13001_addr.dbf"]


def test_dimensions(spark):
    states, datasets = dims.states(spark), dims.datasets(spark)
    assert (states.count(), states.where("territory").count()) == (56, 5)
    assert (datasets.count(), datasets.where("by_default").count()) == (18, 3)
    assert len(dims.default_states()) == 51 and "11" in dims.default_states()


def test_type_maps():
    kinds = {c: typemap.dbf_spark_type(c, strict=True).simpleString() for c in "CNFIDLX"}
    assert kinds == {"C": "string", "N": "double", "F": "double", "I": "int", "D": "date",
                     "L": "boolean", "X": "string"}
    assert typemap.dbf_spark_type("N", 10, 0).simpleString() == "bigint"
    assert typemap.dbf_spark_type("N", 19, 0).simpleString() == "decimal(19,0)"
    assert typemap.dbf_spark_type("N", 10, 2).simpleString() == "double"
    assert typemap.dbf_spark_type("N", 20).simpleString() == "decimal(20,0)"
