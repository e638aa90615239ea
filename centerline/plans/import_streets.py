"""Import from archives to laid-out tables, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centerline.functions import names
from centerline.operators import consolidate
from centerline.plans import schemas
from centerline.session import scratch_dir
from centerline.sources import archive_tables, files

FILE_KEYS = ["file_year", "file_state", "file_county"]


def load_dataset(
    spark: SparkSession, root: str, out: str, dataset: str, recursive: bool = True,
    state: str | None = None, schema: T.StructType | None = None, idempotent: bool = True,
    dates_as_text: bool = False,
) -> str:
    """Load the archives of a dataset below ``out``, in folders by year, state, county.

    The archives are read once, into the scratch folder.  Rows then replace the
    counties they belong to; what could not be read is listed beside the data
    (``load_errors``) and leaves the counties loaded before as they are.
    """
    archives = files.list_archives(spark, root, recursive, state, dataset)
    if schema is None:
        archives = archive_tables.list_tables(archives, dates_as_text)
        schema = archive_tables.archive_schema(archives)
    staged = scratch_dir(spark, "load")
    archive_tables.read_tables(archives, schema).write.parquet(staged)
    rows = spark.read.parquet(staged)
    # The name test on archives also accepts longer dataset names.
    good = rows.where(names.table_of_type(F.col("source_table"), dataset) & F.col("error").isNull()).drop("error")
    parsed = names.parse_name(F.col("source_table"))
    keyed = good.withColumns({
        key: parsed[part] for key, part in zip(FILE_KEYS, ("year", "state", "county"))
    })
    target = f"{out}/{dataset}"
    consolidate.write_partitions(keyed, target, FILE_KEYS, idempotent)
    failed = rows.where("error IS NOT NULL").select("source_table", "error").distinct()
    failed.write.mode("overwrite").parquet(_errors(target))
    return target


def _errors(loaded: str) -> str:
    return f"{loaded.rstrip('/')}_errors"


def load_errors(spark: SparkSession, loaded: str) -> DataFrame:
    """What the last load could not read."""
    return spark.read.schema("source_table string, error string").parquet(_errors(loaded))


def loaded_rows(spark: SparkSession, loaded: str, dataset: str, year: str | None = None) -> DataFrame:
    """Consolidated rows of a dataset with all columns of the files, the declared ones first.

    One scan of the partitioned folder; ``year`` prunes folders.
    """
    rows = consolidate.read_partitions(spark, loaded, FILE_KEYS)
    if year:
        rows = rows.where(F.col("file_year") == year)
    declared = [c for c in spark.createDataFrame([], schemas.CONSOLIDATED[dataset]).columns if c in rows.columns]
    others = [c for c in rows.columns if c not in (*declared, *FILE_KEYS, "source_table")]
    return rows.select(*declared, *others)


def import_streets(
    spark: SparkSession, root: str, out: str, database: str = "default",
    datasets: tuple[str, ...] = consolidate.TABLE_TYPES, state: str | None = None,
    recursive: bool = True, year: str | None = None,
) -> DataFrame:
    """Archives to consolidated tables; row counts per table."""
    counts = []
    for dataset in datasets:
        loaded = load_dataset(spark, root, out, dataset, recursive, state)
        consolidate.replace_table(loaded_rows(spark, loaded, dataset, year), f"{database}.{dataset}")
        counts.append((dataset, spark.table(f"{database}.{dataset}").count()))
    return spark.createDataFrame(counts, "table_name string, n_rows bigint")
