"""Table layouts that take the place of indexes.

An id becomes a bucket, the county a partition folder, every other key a copy
sorted by it, so that a lookup reads one bucket, one folder, or the few row groups
whose statistics match.  The star tables, which are asked for many keys at a time,
lie in folders by a hash of the key: a set of keys reads the folders it falls into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centerline.functions import geometry
from centerline.operators.consolidate import read_partitions
from centerline.plans import schemas

# The columns looked up in each table.
ACCESS_PATHS = {
    "edges": [["statefp", "countyfp"], ["fullname"], ["zipl"], ["zipr"], ["tlid"]],
    "featnames": [["tlid"], ["name"], ["fullname"]],
    "addr": [["tlid"], ["zip"]],
    "place": [["city_phone", "state"], ["zip", "priority"]],
    "feature": [["street_phone", "zip"]],
    "feature_edge": [["fid"]],
    "range": [["tlid"]],
}

# What a lookup by another key gives besides the ids, by table.
COPIED = {
    "edges": ["fullname", "statefp", "countyfp", "zipl", "zipr", "lfromadd", "ltoadd", "rfromadd", "rtoadd"],
    "featnames": ["fullname", "name"],
    "addr": ["fromhn", "tohn", "side", "zip", "plus4"],
    "place": ["zip", "city", "state", "priority", "lat", "lon"],
    "feature": ["street", "paflag", "zip"],
}

# Tables with a spatial access path, if they hold a geometry.
SPATIAL_TABLES = ["edges", "places", "counties", "zcta5"]

BUCKET_KEYS = ("tlid", "fid")
PARTITION_KEYS = ("statefp", "countyfp")


def create_star_schema(spark: SparkSession, database: str = "default") -> None:
    """Create the empty address tables that do not exist yet."""
    for name, columns in schemas.STAR.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def access_table(table: str, keys: list[str]) -> str:
    return f"{table}_by_{'_'.join(keys)}"


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Bucketed and sorted by an id.

    The rows are first brought together by bucket, for one file per bucket; a
    bucket with far more rows than the others is split into several files by
    Spark at run time, so no task writes it alone.
    """
    near = rows.hint("rebalance", buckets, F.col(key))
    writer = near.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_partitioned(rows: DataFrame, table: str, keys: list[str], path: str | None = None) -> None:
    """One folder per key; a hot key is split over several tasks at run time."""
    near = rows.hint("rebalance", *[F.col(k) for k in keys])
    writer = near.write.format("parquet").mode("overwrite").partitionBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# Position of a row in its table: tells copies of a row apart.
ROW_KEYS = ["_row_file", "_row_index"]


def with_row_keys(table: DataFrame) -> DataFrame:
    """Adds the position of each row of a Parquet table."""
    return table.select(
        "*", F.col("_metadata.file_name").alias(ROW_KEYS[0]), F.col("_metadata.row_index").alias(ROW_KEYS[1])
    )


def write_sorted(
    rows: DataFrame, table: str, keys: list[str], tie: list[str], path: str | None = None
) -> None:
    """A copy in key order, for pruning by Parquet statistics.

    ``tie`` names further columns of the range key, so that a key with very many
    rows spans several ranges; row keys among them are not written.
    """
    ordered = rows.repartitionByRange(*keys, *tie).sortWithinPartitions(*keys, *tie)
    writer = ordered.drop(*ROW_KEYS).write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# Folder of a row whose table is laid out by a hash of its keys.
KEY_PART = "key_part"


def _key_part(keys: list[Column], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def write_keyed(rows: DataFrame, table: str, keys: list[str], parts: int, path: str | None = None) -> None:
    """Folders by a hash of the keys, each sorted by them; a folder with very many rows gets several files.

    The table knows its keys and the number of folders.
    """
    placed = rows.withColumn(KEY_PART, _key_part([F.col(k) for k in keys], parts))
    near = placed.hint("rebalance", F.col(KEY_PART)).sortWithinPartitions(KEY_PART, *keys)
    writer = near.write.format("parquet").mode("overwrite").partitionBy(KEY_PART)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    rows.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('key_columns' = '{','.join(keys)}', 'key_parts' = '{parts}')")


def _keyed(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """Keys of a table in folders by their hash, and the number of folders; no keys for other tables."""
    known = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return [k for k in known.get("key_columns", "").split(",") if k], int(known.get("key_parts", 0))


def look_up_set(spark: SparkSession, table: str, asked: DataFrame) -> DataFrame:
    """Rows whose keys are among the rows of ``asked``, which has the key columns.

    The folders that the keys fall into are found first, at most as many numbers as there are folders, and no others
    are read.  Keys that repeat count once; a key with a NULL finds nothing.
    """
    keys, parts = _keyed(spark, table)
    if not keys:
        raise ValueError(f"{table} is not laid out by a hash of its keys")
    rows = spark.table(table)
    wanted = asked.select(*[F.col(k).cast(rows.schema[k].dataType).alias(k) for k in keys]).dropna().distinct()
    folders = [r[0] for r in wanted.select(_key_part([F.col(k) for k in keys], parts)).distinct().collect()]
    return rows.where(F.col(KEY_PART).isin(folders)).join(wanted, keys, "left_semi").drop(KEY_PART)


def build_access_paths(
    spark: SparkSession, database: str = "default", buckets: int | None = None,
    tables: dict[str, list[list[str]]] = ACCESS_PATHS, columns: dict[str, list[str]] = COPIED,
) -> list[str]:
    """Write every access path of the tables that exist; names of what was written.

    A copy has its keys, the table's ids and the ``columns`` of the table that are
    looked up by them, not the geometry; the whole row is found by its id.  There
    are as many buckets, and folders of the star tables, as the session has shuffle
    partitions, unless told.  An existing copy is replaced.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = []
    for table, paths in tables.items():
        if not spark.catalog.tableExists(f"{database}.{table}"):
            continue
        whole = spark.table(f"{database}.{table}")
        ids = [c for c in BUCKET_KEYS if c in whole.columns]
        for keys in paths:
            target = f"{database}.{access_table(table, keys)}"
            if table in schemas.STAR:
                wanted = whole.columns if keys[0] in BUCKET_KEYS else dict.fromkeys([*keys, *ids, *columns.get(table, ())])
                write_keyed(whole.select(*[c for c in wanted if c in whole.columns]), target, keys, buckets)
                done.append(target)
                continue
            if keys[0] in BUCKET_KEYS:
                # The id leads to the row, so this copy alone has all of it.
                write_bucketed(whole, target, keys[0], buckets)
                done.append(target)
                continue
            wanted = dict.fromkeys([*keys, *ids, *columns.get(table, ())])
            kept = [c for c in wanted if c in whole.columns]
            if keys[0] in PARTITION_KEYS:
                write_partitioned(whole.select(*kept), target, keys)
            else:
                write_sorted(with_row_keys(whole).select(*kept, *ROW_KEYS), target, keys, ids + ROW_KEYS)
            done.append(target)
    return done


def _lookup_session(spark: SparkSession) -> SparkSession:
    # A session of its own: the settings must hold when the lookup is planned.
    session = spark.newSession()
    session.conf.set("spark.sql.sources.bucketing.enabled", "true")
    session.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    return session


def look_up(spark: SparkSession, table: str, **keys) -> DataFrame:
    """Rows of an access path with the given key values; prunes buckets and folders too."""
    rows = _lookup_session(spark).table(table)
    for column, value in keys.items():
        rows = rows.where(F.col(column) == F.lit(value))
    if KEY_PART in rows.columns:
        by, parts = _keyed(spark, table)
        if set(by) <= set(keys):
            given = [F.lit(keys[k]).cast(rows.schema[k].dataType) for k in by]
            rows = rows.where(F.col(KEY_PART) == _key_part(given, parts))
        rows = rows.drop(KEY_PART)
    return rows


def join_on_id(spark: SparkSession, left: str, right: str, key: str = "tlid", how: str = "inner") -> DataFrame:
    """Join two tables bucketed by an id, without a shuffle.

    A bucket is one task's work: the number of buckets is chosen when the tables
    are written.  For an id so crowded that no number helps, join the tables
    themselves and let Spark split it.
    """
    session = _lookup_session(spark)
    return session.table(left).join(session.table(right), key, how)


def with_cell(rows: DataFrame, size: float) -> DataFrame:
    """Adds the grid cell of the lower left corner of the bounding box."""
    return rows.withColumn("cell", geometry.grid_cell(F.col("xmin"), F.col("ymin"), size))


def write_spatial(rows: DataFrame, path: str, size: float = 0.1) -> None:
    """Sorted by grid cell, so that near boxes share row groups.

    The box and, if there, the row keys follow the cell in the range key: a crowded
    cell is split.
    """
    keys = ["cell", "xmin", "ymin", "xmax", "ymax", *[c for c in ROW_KEYS if c in rows.columns]]
    placed = with_cell(rows, size).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed.drop(*ROW_KEYS).write.mode("overwrite").parquet(path)


def in_window(rows: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose bounding box meets the window."""
    return rows.where(geometry.box_overlaps(xmin, ymin, xmax, ymax))


def build_spatial_paths(
    spark: SparkSession, root: str, database: str = "default", size: float = 0.1,
    tables: list[str] = SPATIAL_TABLES,
) -> list[str]:
    """Spatial copies of the tables that exist and have a geometry and its box."""
    done = []
    for table in tables:
        if not spark.catalog.tableExists(f"{database}.{table}"):
            continue
        rows = spark.table(f"{database}.{table}")
        if {"geometry", "xmin", "ymin", "xmax", "ymax"} <= set(rows.columns):
            write_spatial(with_row_keys(rows), f"{root}/{table}", size)
            done.append(f"{root}/{table}")
    return done


def write_manifest(files: DataFrame, path: str) -> None:
    """Manifest files in one folder per state; status is pruned by statistics.

    The code stays a column of the data, since a folder's name cannot tell an empty
    code from none.
    """
    keyed = files.withColumn("state_folder", F.col("state_fips"))
    near = keyed.hint("rebalance", F.col("state_folder")).sortWithinPartitions("state_folder", "status")
    near.write.mode("overwrite").partitionBy("state_folder").parquet(path)


def read_manifest(spark: SparkSession, path: str, state: str | None = None) -> DataFrame:
    """Manifest files as they were written; ``state`` reads one state's folder."""
    rows = read_partitions(spark, path, ["state_folder"])
    if state:
        rows = rows.where(F.col("state_folder") == state)
    return rows.drop("state_folder")


def write_relaid(described: DataFrame, path: str) -> None:
    """Dataset rewritten in folders by year, state and feature."""
    keys = ["year", "state", "feature"]
    near = described.hint("rebalance", *[F.col(k) for k in keys])
    near.write.mode("overwrite").partitionBy(*keys).parquet(path)
