"""What the catalog holds: metadata lookups, not jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centerline.functions import names


def list_tables(spark: SparkSession, database: str = "default", table_type: str | None = None) -> DataFrame:
    """Table names in order, or only the per-county tables of one type."""
    tables = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")
    tables = tables.select(F.col("tableName").alias("table_name"))
    if table_type:
        tables = tables.where(names.table_of_type(F.col("table_name"), table_type))
    return tables.orderBy("table_name")


def has_table(spark: SparkSession, name: str, database: str = "default") -> bool:
    return spark.catalog.tableExists(f"{database}.{name}")


def has_column(spark: SparkSession, table: str, column: str, database: str = "default") -> bool:
    return any(c.name == column for c in spark.catalog.listColumns(f"{database}.{table}"))


def preview(spark: SparkSession, database: str = "default", rows: int = 10) -> dict[str, DataFrame]:
    """The first rows of every table, as a frame each; nothing runs yet."""
    listed = [r.table_name for r in list_tables(spark, database).collect()]
    return {t: spark.table(f"{database}.{t}").limit(rows) for t in listed}
