"""Numbers for rows without gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centerline.session import scratch_dir


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``number``, from 0 on and without gaps, in the order of some columns.

    Rows are dealt out by ranges and written; each range counts its own rows, and a
    row per range tells how many stand before it.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "numbered")
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("_range").agg(F.count("*").alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    joined = ranged.withColumn("_within", within).join(F.broadcast(offsets), "_range")
    return joined.withColumn("number", F.col("_before") + F.col("_within")).drop("_range", "_before", "_within")
