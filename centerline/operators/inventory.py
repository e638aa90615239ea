"""File inventories: parsing, counting, layout plans and loadable tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centerline.functions import names


def with_name_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``_file``, ``_stem`` and ``_name``, the parsed stem.

    Each is a step of its own, so that no pattern is matched twice for a row.
    """
    named = files.withColumn("_file", names.base_name(F.col(path)))
    stems = named.withColumn("_stem", names.file_stem(F.col("_file")))
    return stems.withColumn("_name", names.parse_name(F.col("_stem")))


def describe_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds year, state, county, feature, type and the two validity flags.

    The name decides; folders are used only when it says nothing.  ``feature``
    comes from names only and ``type`` from folders only.
    """
    valid = F.col("_name").isNotNull()
    folders = F.when(~valid, names.directory_parts(F.col(path)))
    parsed = with_name_parts(files, path).withColumn("_dir", folders)
    return parsed.select(
        *files.columns,
        *[F.coalesce(f"_name.{c}", f"_dir.{c}").alias(c) for c in ("year", "state", "county")],
        F.col("_name.feature").alias("feature"),
        F.col("_dir.type").alias("type"),
        valid.alias("valid"),
        valid.alias("filename_valid"),
    )


def count_files(described: DataFrame) -> DataFrame:
    """Files per year, state and feature, with the grand total in the row of NULLs.

    ``level`` is 0 for a group and 1 for the total.
    """
    groups = described.groupingSets([["year", "state", "feature"], []], "year", "state", "feature")
    return groups.agg(
        F.grouping("year").cast("int").alias("level"), F.count(F.lit(1)).alias("n_files")
    )


def plan_layout(files: DataFrame, layout: str, path: str = "path") -> DataFrame:
    """Moves ``(src, dst, n_sources)`` to a new layout; files in place are left out.

    ``n_sources`` counts the files that end at ``dst``, including those already
    there; a plan with ``n_sources > 1`` must not be carried out.  Counting per
    target combines on the map side, so a target shared by many copies costs one
    row per task, and the join back is one that Spark splits when a target is hot.
    """
    placed = files.select(F.col(path).alias("src"), names.layout_path(layout, F.col(path)).alias("dst"))
    shared = placed.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    moves = placed.where("src <> dst")
    return moves.join(shared, "dst", "left").select(
        "src", "dst", F.coalesce("n", F.lit(1).cast("bigint")).alias("n_sources")
    )


def layout_collisions(plan: DataFrame) -> DataFrame:
    """Targets more than one file would end at, with their first source."""
    return plan.where("n_sources > 1").groupBy("dst").agg(
        F.max("n_sources").alias("n_sources"), F.min("src").alias("first_src")
    )


def standalone_dbf(files: DataFrame, state: str | None = None, path: str = "path") -> DataFrame:
    """DBF files without a shapefile of the same stem, wherever that may lie.

    Both lists are narrowed by state.  The stems of the shapefiles are made
    distinct before the join, so copies on that side collapse in each task.
    """
    name = names.base_name(F.col(path))
    listed = files.withColumn("_name", name)
    if state:
        listed = listed.where(names.in_state(F.col("_name"), state))
    listed = listed.withColumn("stem", names.file_stem(F.col("_name"))).drop("_name")
    has_shape = listed.where(F.col(path).endswith(".shp")).select("stem").distinct()
    return listed.where(F.col(path).endswith(".dbf")).join(has_shape, "stem", "left_anti")
