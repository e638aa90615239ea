"""The manifest as JSON: documents, or one entry per line.

A document is one value, so it is one task's work to write or to read.  A large
manifest is written as many documents, each with a share of the entries and whole
by itself; the entry form splits anywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centerline.plans import schemas

TABLES = {
    "files": schemas.FILES,
    "url_lists": schemas.URL_LISTS,
    "states": schemas.STATES,
    "discovered_urls": schemas.DISCOVERED,
}


def _struct(fields: str) -> str:
    return "struct<" + ", ".join(f"`{n}`: {t}" for n, t in (f.strip().split(" ") for f in fields.split(","))) + ">"


DOCUMENT = (
    f"files map<string, {_struct(schemas.FILES)}>, completed array<string>, failed array<string>, "
    f"states map<string, {_struct(schemas.STATES)}>, discovered_urls map<string, array<string>>"
)
ENTRY = "section string, " + ", ".join(f"{name} {_struct(fields)}" for name, fields in TABLES.items())


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], fields) for name, fields in TABLES.items()}


def read_document(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Manifest tables of JSON documents; an absent file is an empty manifest.

    A ``.json`` file is one document, on any number of lines; a folder has a document
    on each line of its files, as ``write_document`` leaves it.  What is no such
    document is an error.  Documents carry no times for their lists, so those columns
    are NULL.
    """
    try:
        reader = spark.read.schema(DOCUMENT).option("mode", "FAILFAST")
        document = reader.option("multiLine", path.endswith(".json")).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_tables(spark)
    unknown = F.lit(None).cast("double")
    entry = document.select(F.explode("files").alias("path", "f"))
    files = entry.select("path", *[f"f.{c}" for c in spark.createDataFrame([], schemas.FILES).columns[1:]])
    lists = [
        document.select(
            F.explode(kind).alias("url"), F.lit(kind).alias("list_type"), unknown.alias("added_at")
        )
        for kind in ("completed", "failed")
    ]
    states = document.select(F.explode("states").alias("state_fips", "s"))
    states = states.select(
        "state_fips", *[f"s.{c}" for c in spark.createDataFrame([], schemas.STATES).columns[1:]]
    )
    discovered = document.select(F.explode("discovered_urls").alias("state_fips", "urls"))
    discovered = discovered.select(
        "state_fips", F.explode("urls").alias("url"), unknown.alias("discovered_at")
    )
    return {
        "files": files,
        "url_lists": lists[0].unionAll(lists[1]),
        "states": states,
        "discovered_urls": discovered,
    }


def documents(tables: dict[str, DataFrame], count: int) -> DataFrame:
    """The manifest as ``count`` documents at most, each whole by itself with a share of the entries.

    An entry goes to the document that its key's hash names, so all documents
    together are the manifest, and one of them is a task's work.
    """
    files, states = tables["files"], tables["states"]
    lists, discovered = tables["url_lists"], tables["discovered_urls"]

    def share(section: str, *key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(section), *key), F.lit(count)).alias("share")

    def entries(rows: DataFrame, section: str, key: str) -> DataFrame:
        entry = F.struct(F.col(key).alias("key"), F.struct(*rows.columns).alias("value"))
        return rows.groupBy(share(section, key)).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(section))

    def urls(kind: str) -> DataFrame:
        own = lists.where(F.col("list_type") == kind)
        return own.groupBy(share(kind, "url")).agg(F.array_sort(F.collect_list("url")).alias(kind))

    of_state = discovered.groupBy(share("discovered_urls", "state_fips", "url"), "state_fips").agg(
        F.array_sort(F.collect_list("url")).alias("urls")
    )
    found = of_state.groupBy("share").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("state_fips", "urls")))).alias("discovered_urls")
    )
    parts = [
        entries(files, "files", "path"), urls("completed"), urls("failed"), entries(states, "states", "state_fips"), found,
    ]
    whole = files.sparkSession.range(count).select(F.col("id").alias("share"))
    for part in parts:
        whole = whole.join(part, "share", "left")
    schema = files.sparkSession.createDataFrame([], DOCUMENT).schema
    empty = {f.name: F.from_json(F.lit("[]" if f.dataType.typeName() == "array" else "{}"), f.dataType) for f in schema}
    return whole.select(*[F.coalesce(name, value).alias(name) for name, value in empty.items()])


def write_document(tables: dict[str, DataFrame], path: str, count: int = 1) -> None:
    """Write the manifest as documents, one per line; one document unless told otherwise.

    A large manifest should have as many documents as tasks shall write it.
    """
    documents(tables, count).write.option("ignoreNullFields", "false").json(path)


def write_entries(tables: dict[str, DataFrame], path: str) -> None:
    """One manifest row per line, under the name of its table; one write for all."""
    parts = [
        table.select(F.lit(name).alias("section"), F.struct(*table.columns).alias(name))
        for name, table in tables.items()
    ]
    entries = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    entries.write.json(path)


def read_entries(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Manifest tables of an entry-per-line export; absent means empty."""
    try:
        entries = spark.read.schema(ENTRY).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_tables(spark)
    return {
        name: entries.where(F.col("section") == name).select(f"{name}.*") for name in TABLES
    }
