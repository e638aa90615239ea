"""Per-county tables appended into one table, by position.

Tables with the same columns are read together in one scan of many paths, so the
plan grows with the number of different schemas and not with the number of
tables.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centerline.session import scratch_dir
from centerline.sources import catalog

TABLE_TYPES = ("edges", "featnames", "addr")
REJECTS = "source_table string, reason string"
_MARK = "_lost_"


@dataclass
class Source:
    """A table to append: its name, Parquet folder or catalog name, and columns."""

    name: str
    path: str | None
    schema: T.StructType
    table: str | None = None  # for tables of another format


@dataclass
class Consolidation:
    rows: DataFrame
    rejects: DataFrame
    written: list[str]  # names of the sources in ``rows``


def _parquet_folder(spark: SparkSession, table: str) -> str | None:
    """Folder of a Parquet table; None for any other."""
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return detail.get("Location") if detail.get("Provider", "").lower() == "parquet" else None


def catalog_sources(spark: SparkSession, table_type: str, database: str = "default") -> list[Source]:
    """Per-county tables of a type, in name order; catalog metadata only."""
    out = []
    for row in catalog.list_tables(spark, database, table_type).collect():
        table = f"{database}.{row.table_name}"
        out.append(Source(row.table_name, _parquet_folder(spark, table), spark.table(table).schema, table))
    return out


def path_sources(spark: SparkSession, paths: dict[str, str]) -> list[Source]:
    """Sources in Parquet folders, in name order."""
    return [Source(n, p, spark.read.parquet(p).schema) for n, p in sorted(paths.items())]


def _folder(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _read_group(spark: SparkSession, group: list[Source]) -> DataFrame:
    """All rows of tables with the same columns, with ``source_table``."""
    others = [s for s in group if s.path is None]
    group = [s for s in group if s.path is not None]
    parts = [spark.table(s.table).withColumn("source_table", F.lit(s.name)) for s in others]
    if group:
        parts.append(_read_folders(spark, group))
    return reduce(DataFrame.unionAll, parts)


def _read_folders(spark: SparkSession, group: list[Source]) -> DataFrame:
    names_by_folder = {_folder(s.path): s.name for s in group}
    if len(names_by_folder) < len(group):
        parts = [
            spark.read.schema(s.schema).parquet(s.path).withColumn("source_table", F.lit(s.name))
            for s in group
        ]
        return reduce(DataFrame.unionAll, parts)
    rows = spark.read.schema(group[0].schema).parquet(*[s.path for s in group])
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    rows = rows.withColumn("source_table", folder)
    renamed = {f: n for f, n in names_by_folder.items() if f != n}
    return rows.replace(renamed, subset=["source_table"]) if renamed else rows


def _aligned(group: list[Source], target: T.StructType, by_name: bool) -> list[tuple[str, Column]] | str:
    """Expression per target column, or why the tables do not fit."""
    columns = group[0].schema.fields
    if by_name:
        own = {f.name: f for f in columns}
        extra = sorted(set(own) - set(target.names))
        if extra:
            return f"unknown columns {', '.join(extra)}"
        pairs = [(own.get(f.name), f) for f in target]
    elif len(columns) != len(target):
        return f"{len(columns)} columns, expected {len(target)}"
    else:
        pairs = list(zip(columns, target))
    out = []
    for have, want in pairs:
        if have is None:
            out.append((want.name, F.lit(None).cast(want.dataType)))
        elif have.dataType == want.dataType:
            out.append((want.name, F.col(have.name)))
        else:
            simple = not isinstance(have.dataType, (T.ArrayType, T.MapType, T.StructType))
            if not simple or isinstance(want.dataType, (T.ArrayType, T.MapType, T.StructType)):
                return f"column {have.name} is {have.dataType.simpleString()}"
            out.append((want.name, F.col(have.name).try_cast(want.dataType)))
    return out


def _lost(have: T.DataType, want: T.DataType, value: Column, cast: Column) -> Column:
    """Whether a value does not survive its cast.

    Text for whole numbers has to come back as it was, so that a code keeps its zeros; text for other numbers may not
    be a code or stand between spaces, and other text has to be readable.  Anything else has to come back.
    """
    gone = value.isNotNull() & cast.isNull()
    if not isinstance(have, T.StringType):
        return gone | ~cast.try_cast(have).eqNullSafe(value)
    if isinstance(want, T.IntegralType):
        return gone | ~cast.cast("string").eqNullSafe(value)
    if isinstance(want, T.NumericType):
        return gone | F.coalesce(value.rlike(r"^\s|\s$|^\+|^-?0\d"), F.lit(False))
    return gone


def _cast_rows(
    rows: DataFrame, group: list[Source], aligned: list[tuple[str, Column]], wanted: list[T.StructField]
) -> tuple[DataFrame, dict[str, str]]:
    """Rows of tables whose types differ from the target, without tables that lose a value, and why these go.

    The tables are read once: the rows are written below the shared folder with a mark on those that lose something,
    and the number of marks is counted on the way.  Only if it is not 0 are the marks looked at.
    """
    spark = rows.sparkSession
    lost = F.lit(False)
    for have, want in zip(group[0].schema.fields, wanted):
        if have.dataType != want.dataType:
            value = F.col(have.name)
            lost = lost | _lost(have.dataType, want.dataType, value, value.try_cast(want.dataType))
    marked = rows.select(*[c.alias(n) for n, c in aligned], "source_table", lost.alias(_MARK))
    seen, path = Observation(), scratch_dir(spark, "consolidated")
    marked.observe(seen, F.count_if(_MARK).alias("n")).write.parquet(path)
    staged = spark.read.schema(marked.schema).parquet(path)
    bad: dict[str, str] = {}
    if seen.get["n"]:
        counts = staged.where(_MARK).groupBy("source_table").agg(F.count(F.lit(1)).alias("n"))
        bad = {r.source_table: f"{r.n} rows do not fit" for r in counts.collect()}
        staged = staged.where(~F.col("source_table").isin(*bad))
    return staged.drop(_MARK), bad


def consolidate(
    spark: SparkSession, sources: list[Source], target: T.StructType | None = None, by_name: bool = False
) -> Consolidation:
    """Rows of all sources under the columns of the first, with ``source_table``.

    A source with another number of columns, or with a value its target column cannot hold, is left out as a whole and
    reported.  ``by_name`` matches columns by name and fills absent ones with NULL.  Tables whose types differ from
    the target are cast and written below the shared folder here, once, and their rows come from there; other tables
    are read when the result is.
    """
    if not sources:
        raise ValueError("nothing to consolidate")
    target = target or sources[0].schema
    groups: dict[tuple, list[Source]] = defaultdict(list)
    for source in sources:
        groups[tuple((f.name, f.dataType.simpleString()) for f in source.schema)].append(source)
    parts, rejects, written = [], [], []
    for group in groups.values():
        aligned = _aligned(group, target, by_name)
        if isinstance(aligned, str):
            rejects += [(s.name, aligned) for s in group]
            continue
        rows = _read_group(spark, group)
        wanted = [target[f.name] for f in group[0].schema] if by_name else target.fields
        if any(f.dataType != w.dataType for f, w in zip(group[0].schema, wanted)):
            rows, bad = _cast_rows(rows, group, aligned, wanted)
            rejects += sorted(bad.items())
            group = [s for s in group if s.name not in bad]
            if not group:
                continue
        else:
            rows = rows.select(*[c.alias(n) for n, c in aligned], "source_table")
        parts.append(rows)
        written += [s.name for s in group]
    rows = reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame(
        [], T.StructType([*target.fields, T.StructField("source_table", T.StringType())])
    )
    return Consolidation(rows, spark.createDataFrame(rejects, REJECTS), sorted(written))


def replace_table(rows: DataFrame, table: str) -> None:
    """Write beside the old table and take its name when the write is complete.

    The old table keeps its rows under another name until the new one has taken its
    place, and gets its name back if that fails.  Between the two renames there is no
    table of that name for a moment: a catalog has no exchange of names.
    """
    spark = rows.sparkSession
    staged, old = f"{table}__staged", f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    rows.write.format("parquet").saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def create_or_append(rows: DataFrame, table: str) -> None:
    """Create the table from the rows, or append them by position.

    A second run appends the rows again.
    """
    if rows.sparkSession.catalog.tableExists(table):
        rows.write.insertInto(table)
    else:
        rows.write.format("parquet").saveAsTable(table)


def write_partitions(rows: DataFrame, path: str, keys: list[str], idempotent: bool = True) -> None:
    """Append to a partitioned folder; ``idempotent`` replaces the partitions it writes.

    Rows are spread by partition before the write; a partition too large for one
    task is split by Spark at run time and gets several files.
    """
    writer = rows.hint("rebalance", *[F.col(k) for k in keys]).write.partitionBy(*keys)
    if idempotent:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        writer.mode("append").parquet(path)


def read_partitions(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """A partitioned folder with its keys as text, so that codes keep their zeros."""
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    typed = [T.StructField(f.name, T.StringType()) if f.name in keys else f for f in found]
    return spark.read.schema(T.StructType(typed)).parquet(path)


def consolidate_catalog(
    spark: SparkSession, database: str = "default", table_types: tuple[str, ...] = TABLE_TYPES,
    mode: str = "overwrite", drop_sources: bool = False, by_name: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Consolidate the per-county tables of each type into one table of that name.

    Returns row counts per table and the rejected sources.  ``append`` adds to an
    existing table, which then sets the columns.  Sources are dropped only after
    the write has succeeded, and only those that were written.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    counts, rejects = [], []
    for table_type in table_types:
        sources = catalog_sources(spark, table_type, database)
        if not sources:
            continue
        table = f"{database}.{table_type}"
        append = mode == "append" and spark.catalog.tableExists(table)
        result = consolidate(spark, sources, spark.table(table).schema if append else None, by_name)
        rows = result.rows.drop("source_table")
        if append:
            rows.write.insertInto(table)
        else:
            replace_table(rows, table)
        if drop_sources:
            for name in result.written:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        counts.append((table_type, spark.table(table).count()))
        rejects.append(result.rejects)
    report = spark.createDataFrame(counts, "table_name string, n_rows bigint")
    refused = reduce(DataFrame.unionAll, rejects) if rejects else spark.createDataFrame([], REJECTS)
    return report, refused
