import re

import pytest
from pyspark.sql import functions as F

from centerline.operators import consolidate as con
from centerline.operators import layout
from centerline.plans import schemas
from centerline.sources import catalog


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def county_tables(spark, database):
    def make(name, rows, schema):
        spark.createDataFrame(rows, schema).write.saveAsTable(f"{database}.{name}")

    make("tl_2025_13001_addr", [(1, "a"), (2, "b")], "tlid bigint, side string")
    make("tl_2025_13003_addr", [(3, "c"), (4, "d"), (5, "e")], "line bigint, s string")
    make("tl_2025_13005_addr", [(6, "f", 1)], "tlid bigint, side string, more int")
    make("tl_2025_13007_addr", [("7", "g"), ("8", "h")], "tlid string, side string")
    make("tl_2025_13009_addr", [("9", "i"), ("x9", "j")], "tlid string, side string")
    make("tl_2025_13011_addr", [(10, ["k"])], "tlid bigint, side array<string>")
    make("other", [(1,)], "a int")


REASONS = {
    "tl_2025_13005_addr": "3 columns, expected 2",
    "tl_2025_13009_addr": "1 rows do not fit",
    "tl_2025_13011_addr": "column side is array<string>",
}


def test_consolidate(spark, database):
    county_tables(spark, database)
    assert [r.table_name for r in catalog.list_tables(spark, database).collect()][0] == "other"
    assert catalog.list_tables(spark, database, "addr").count() == 6
    assert catalog.has_table(spark, "other", database) and not catalog.has_table(spark, "addr", database)
    assert catalog.has_column(spark, "other", "a", database)
    for _ in range(2):  # a second run gives the same table
        counts, rejects = con.consolidate_catalog(spark, database, ("addr", "edges"))
        assert [tuple(r) for r in counts.collect()] == [("addr", 7)]
        assert {r.source_table: r.reason for r in rejects.collect()} == REASONS
    table = spark.table(f"{database}.addr")
    assert sorted(tuple(r) for r in table.collect()) == [(i, c) for i, c in zip([1, 2, 3, 4, 5, 7, 8], "abcdegh")]
    counts, _ = con.consolidate_catalog(spark, database, ("addr",), mode="append")
    assert counts.first().n_rows == 14
    previews = catalog.preview(spark, database, 3)
    assert previews["addr"].count() == 3 and "tl_2025_13001_addr" in previews


def test_only_written_sources_are_dropped(spark, database):
    county_tables(spark, database)
    con.consolidate_catalog(spark, database, ("addr",), drop_sources=True)
    left = {r.table_name for r in catalog.list_tables(spark, database).collect()}
    assert left == {"addr", "other", *REASONS}


def test_consolidate_by_name_and_nothing(spark, database):
    county_tables(spark, database)
    sources = [s for s in con.catalog_sources(spark, "addr", database) if s.name[8:13] in ("13001", "13003", "13005")]
    result = con.consolidate(spark, sources, by_name=True)
    assert result.written == ["tl_2025_13001_addr"]
    assert result.rejects.count() == 2
    with pytest.raises(ValueError):
        con.consolidate(spark, [])


def test_values_that_do_not_survive_a_cast(spark, database):
    def make(name, rows, schema, kind="parquet"):
        spark.createDataFrame(rows, schema).write.format(kind).saveAsTable(f"{database}.{name}")

    make("tl_2025_13001_addr", [(1, "a")], "tlid bigint, side string")
    make("tl_2025_13002_addr", [("x7", "b")], "tlid string, side string")
    make("tl_2025_13003_addr", [(1.9, "c"), (2.0, "d")], "tlid double, side string")
    make("tl_2025_13004_addr", [(4.0, "e")], "tlid double, side string")
    make("tl_2025_13005_addr", [(5, "f")], "tlid bigint, side string", "json")
    for by_name in (False, True):
        result = con.consolidate(spark, con.catalog_sources(spark, "addr", database), by_name=by_name)
        assert sorted(tuple(r)[:2] for r in result.rows.collect()) == [(1, "a"), (4, "e"), (5, "f")]
        assert {r.source_table: r.reason for r in result.rejects.collect()} == {
            "tl_2025_13002_addr": "1 rows do not fit", "tl_2025_13003_addr": "1 rows do not fit",
        }


def test_codes_keep_their_zeros(spark, tmp_path, monkeypatch):
    def make(name, values, kind="string"):
        spark.createDataFrame([(v,) for v in values], f"x {kind}").write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    reads = []
    real = con._read_group
    monkeypatch.setattr(con, "_read_group", lambda spark, group: reads.append(len(group)) or real(spark, group))
    whole = [("t1", ["01001"]), ("t2", ["1001", None, "-7"]), ("t3", ["+5"]), ("t4", [" 6"]), ("t5", ["7 "]), ("t6", ["1.0"]), ("t7", ["0"])]
    paths = {"t0": make("t0", [1], "bigint")} | {n: make(n, v) for n, v in whole}
    result = con.consolidate(spark, con.path_sources(spark, paths))
    assert sorted(r.x for r in result.rows.collect() if r.x is not None) == [-7, 0, 1, 1001]
    assert {r.source_table for r in result.rejects.collect()} == {"t1", "t3", "t4", "t5", "t6"}
    assert result.written == ["t0", "t2", "t7"]
    assert reads == [1, 7]  # one reading of each group
    assert not any(str(tmp_path / n) in plan(result.rows) for n, _ in whole)

    part = [("d1", ["0.50", "1.5", "1e3", "-0.25", "7"]), ("d2", ["007"]), ("d3", ["-01.5"]), ("d4", ["nothing"])]
    paths = {"d0": make("d0", [0.5], "double")} | {n: make(n, v) for n, v in part}
    result = con.consolidate(spark, con.path_sources(spark, paths))
    assert sorted(r.x for r in result.rows.collect()) == [-0.25, 0.5, 0.5, 1.5, 7.0, 1000.0]
    assert {r.source_table for r in result.rejects.collect()} == {"d2", "d3", "d4"}


def test_many_tables_are_one_scan(spark, tmp_path):
    paths = {}
    for n in range(12):
        name = f"tl_2025_13{n:03d}_addr"
        spark.range(n).selectExpr("id AS tlid").write.parquet(str(tmp_path / name))
        paths[name] = str(tmp_path / name)
    result = con.consolidate(spark, con.path_sources(spark, paths))
    assert plan(result.rows).count("(1) Scan parquet") == 1 and "Union" not in plan(result.rows)
    counts = {r.source_table: r["count"] for r in result.rows.groupBy("source_table").count().collect()}
    assert counts == {f"tl_2025_13{n:03d}_addr": n for n in range(1, 12)}


def test_create_or_append_and_replace(spark, database):
    rows = spark.createDataFrame([(1, "a")], "x int, y string")
    con.create_or_append(rows, f"{database}.t")
    con.create_or_append(rows.toDF("p", "q"), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 2
    con.replace_table(rows, f"{database}.t")
    assert spark.table(f"{database}.t").count() == 1


def test_partitioned_writes(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([("06", 1), ("13", 2)], "state string, v int")
    con.write_partitions(rows, path, ["state"])
    con.write_partitions(rows.where("state = '06'").withColumn("v", F.lit(9)), path, ["state"])
    got = sorted((r.state, r.v) for r in con.read_partitions(spark, path, ["state"]).collect())
    assert got == [("06", 9), ("13", 2)]
    con.write_partitions(rows, path, ["state"], idempotent=False)
    assert con.read_partitions(spark, path, ["state"]).count() == 4


@pytest.fixture(scope="module")
def streets(spark):
    spark.sql("CREATE DATABASE streets")
    edges = spark.range(2000).selectExpr(
        "lpad(CAST(id % 4 AS STRING), 2, '0') AS statefp", "lpad(CAST(id % 3 AS STRING), 3, '0') AS countyfp",
        "id AS tlid", "concat('name', id % 50) AS fullname", "lpad(CAST(id % 40 AS STRING), 5, '0') AS zipl",
        "lpad(CAST(id % 41 AS STRING), 5, '0') AS zipr", "CAST(NULL AS BINARY) AS geometry",
        "id / 10.0D AS xmin", "0.0D AS ymin", "id / 10.0D + 1 AS xmax", "1.0D AS ymax",
    )
    edges.write.saveAsTable("streets.edges")
    # A third of the address rows belong to one line.
    addr = spark.range(6000).selectExpr("IF(id % 3 = 0, 7, id) AS tlid", "lpad(CAST(id % 40 AS STRING), 5, '0') AS zip")
    addr.write.saveAsTable("streets.addr")
    layout.create_star_schema(spark, "streets")
    layout.create_star_schema(spark, "streets")
    written = layout.build_access_paths(spark, "streets", buckets=4)
    yield written
    spark.sql("DROP DATABASE streets CASCADE")


def test_access_paths(spark, streets):
    assert sorted(streets) == sorted(
        f"streets.{n}" for n in (
            "edges_by_statefp_countyfp", "edges_by_fullname", "edges_by_zipl", "edges_by_zipr", "edges_by_tlid",
            "addr_by_tlid", "addr_by_zip", "place_by_city_phone_state", "place_by_zip_priority",
            "feature_by_street_phone_zip", "feature_edge_by_fid", "range_by_tlid",
        )
    )
    for name in streets:
        base = name.split("_by_")[0]
        assert spark.table(name).count() == spark.table(base).count()
    assert spark.table("streets.range").columns == [f.split()[0] for f in schemas.STAR["range"].split(", ")]
    assert spark.sql("SELECT count(*) FROM range(5)").first()[0] == 5


def test_join_on_id_has_no_shuffle(spark, streets):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = layout.join_on_id(spark, "streets.edges_by_tlid", "streets.addr_by_tlid")
        joined.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Exchange" not in plan(joined)
        want = spark.table("streets.edges").join(spark.table("streets.addr"), "tlid").count()
        assert joined.count() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_read_little(spark, streets):
    one = layout.look_up(spark, "streets.edges_by_tlid", tlid=77)
    assert re.search(r"SelectedBucketsCount: 1 out of 4", plan(one)) and one.count() == 1
    county = layout.look_up(spark, "streets.edges_by_statefp_countyfp", statefp="02", countyfp="001")
    text = plan(county)
    assert "PartitionFilters: [isnotnull(statefp" in text and "(statefp" in text
    assert county.count() == spark.table("streets.edges").where("statefp = '02' AND countyfp = '001'").count() > 0
    for table, column, value in (
        ("edges_by_fullname", "fullname", "name7"), ("edges_by_zipl", "zipl", "00007"),
        ("edges_by_zipr", "zipr", "00007"), ("addr_by_zip", "zip", "00007"),
    ):
        found = layout.look_up(spark, f"streets.{table}", **{column: value})
        assert f"EqualTo({column},{value})" in plan(found)
        base = table.split("_by_")[0]
        assert found.count() == spark.table(f"streets.{base}").where(F.col(column) == value).count() > 0


def test_a_set_of_keys_reads_its_folders(spark, database):
    rows = spark.range(4000).selectExpr("id % 500 AS fid", "id AS tlid")
    rows.write.saveAsTable(f"{database}.feature_edge")
    (name,) = layout.build_access_paths(spark, database, 64, {"feature_edge": [["fid"]]})
    asked = spark.createDataFrame([(3,), (499,), (3,), (None,), (77777,)], "fid int")
    found = layout.look_up_set(spark, name, asked)
    assert found.columns == ["fid", "tlid"]
    assert sorted(tuple(r) for r in found.collect()) == sorted((i % 500, i) for i in range(4000) if i % 500 in (3, 499))
    read = [line for line in plan(found).split("\n") if "PartitionFilters" in line]
    assert any("key_part" in line and "IN" in line for line in read)
    folders = {f.split("key_part=")[1].split("/")[0] for f in spark.table(name).inputFiles()}
    pruned = found._jdf.queryExecution().executedPlan().toString()
    assert len(folders) == 64 and "key_part" in pruned
    one = layout.look_up(spark, name, fid=3)
    assert sorted(r.tlid for r in one.collect()) == list(range(3, 4000, 500)) and "key_part" in plan(one)
    assert layout.look_up_set(spark, name, asked.limit(0)).count() == 0
    with pytest.raises(ValueError, match="not laid out"):
        layout.look_up_set(spark, f"{database}.feature_edge", asked)


def test_a_few_keys_read_a_share_of_the_copy(spark, database):
    rows = spark.range(200_000).selectExpr("lpad(CAST(id % 5000 AS STRING), 5, '0') AS zip", "id AS tlid")
    layout.write_keyed(rows, f"{database}.addr_by_zip", ["zip"], 50)
    few = spark.createDataFrame([("00007",), ("04000",)], "zip string")
    found = layout.look_up_set(spark, f"{database}.addr_by_zip", few)
    assert found.count() == 80
    node = found._jdf.queryExecution().executedPlan()
    while "FileSourceScan" not in node.getClass().getSimpleName():
        node = node.executedPlan() if "Adaptive" in node.getClass().getSimpleName() else node.children().head()
    found.collect()
    read = node.metrics().apply("numFiles").value()
    assert 0 < read <= 2 < len(spark.table(f"{database}.addr_by_zip").inputFiles())


def test_hot_key_spans_files_of_a_sorted_copy(spark, tmp_path):
    rows = spark.range(40000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS zip", "id AS tlid")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_sorted(rows, "default.hot_zip", ["zip"], ["tlid"], str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.table("default.hot_zip").where("zip = 'hot'").select(F.input_file_name()).distinct().count()
    spark.sql("DROP TABLE default.hot_zip")
    assert files > 1


def test_spatial_window(spark, streets, tmp_path):
    (path,) = layout.build_spatial_paths(spark, str(tmp_path), "streets", size=5.0)
    found = layout.in_window(spark.read.parquet(path), 10.0, 0.5, 12.0, 3.0)
    assert "GreaterThanOrEqual(xmax,10.0)" in plan(found) and "LessThanOrEqual(xmin,12.0)" in plan(found)
    got = sorted(r.tlid for r in found.collect())
    assert got == [i for i in range(2000) if i / 10 <= 12.0 and i / 10 + 1 >= 10.0]


def test_manifest_layout_prunes(spark, tmp_path):
    files = spark.createDataFrame([
        ("p1", "u1", "completed", "06", 1, None, None, 1.0), ("p2", "u2", "failed", "13", None, None, "e", 2.0),
        ("p3", "u3", "failed", "", None, None, "e", 2.0), ("p4", "u4", "failed", None, None, None, "e", 2.0),
    ], schemas.FILES)
    layout.write_manifest(files, str(tmp_path / "m"))
    back = layout.read_manifest(spark, str(tmp_path / "m"))
    assert sorted((r.path, r.state_fips) for r in back.collect()) == [("p1", "06"), ("p2", "13"), ("p3", ""), ("p4", None)]
    one = layout.read_manifest(spark, str(tmp_path / "m"), "06").where("status = 'completed'")
    assert "PartitionFilters: [isnotnull(state_folder" in plan(one) and "EqualTo(status,completed)" in plan(one)
    assert [r.path for r in one.collect()] == ["p1"]


def test_scratch_is_cleared(spark):
    from centerline import session

    session.clear_scratch(spark)
    path = session.scratch_dir(spark, "mine")
    spark.range(3).write.option("path", path).saveAsTable("mine_table")
    session.scratch_dir(spark, "never_written")
    assert session.clear_scratch(spark) == 1
    assert not spark.catalog.tableExists("mine_table") and session.clear_scratch(spark) == 0
