"""Tables read straight from zip archives."""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from centerline.functions.typemap import merged_schema
from centerline.session import scratch_dir
from centerline.sources import dbf, files, ranges, shapefile

SUFFIXES = (".shp", ".shx", ".dbf", ".cpg", ".prj")

# What a table that is no good raises; faults of the store are not among them.
BAD_TABLE = (*files.BAD_ARCHIVE, struct.error, LookupError)

_TABLES = "path string, stem string, shaped boolean, fields array<struct<position:int,name:string,kind:string>>"


def list_tables(archives: DataFrame, dates_as_text: bool = False) -> DataFrame:
    """The tables of archives with their columns: ``path, stem, shaped, fields``, written below the shared folder.

    Each archive is opened once; headers are read only as far as they reach.  What is no good has no fields and is left
    to the reading; an archive that cannot be opened is one row without stem.
    """

    def fields(archive: zipfile.ZipFile, member: zipfile.ZipInfo) -> list[dict]:
        try:
            with archive.open(member) as file:
                start = file.read(32)
                body = file.read(max(int.from_bytes(start[8:10], "little") - 32, 0))
            header = dbf.read_header(pa.BufferReader(start + body), whole=False)
        except BAD_TABLE:
            return []
        found = dbf.header_schema(header, dates_as_text=dates_as_text).fields
        return [{"position": i, "name": f.name, "kind": f.dataType.simpleString()} for i, f in enumerate(found)]

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found: dict[str | None, list] = {}
                try:
                    with files.open_archive(path) as archive:
                        for member in files.members_of(archive, None, None):
                            own = found.setdefault(ranges.stem_of(member.filename), [False, []])
                            own[0] |= member.filename.lower().endswith(".shp")
                            if member.filename.lower().endswith(".dbf"):
                                own[1] += fields(archive, member)
                except BAD_TABLE:
                    found = {None: [False, []]}
                rows = [{"path": path, "stem": stem, "shaped": s, "fields": f} for stem, (s, f) in sorted(found.items(), key=str)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = to_arrow_schema(T.StructType.fromDDL(_TABLES))
    spark = archives.sparkSession
    path = scratch_dir(spark, "archive-tables")
    archives.select("path").mapInArrow(tables, _TABLES).write.parquet(path)
    return spark.read.schema(_TABLES).parquet(path)


def archive_schema(archives: DataFrame, dates_as_text: bool = False) -> T.StructType:
    """Merged columns of all tables in the archives, or of a listing that ``list_tables`` has made.

    One row per different field comes back.
    """
    listed = archives if "fields" in archives.columns else list_tables(archives, dates_as_text)
    found = listed.select("shaped", F.inline("fields")).groupBy("name", "kind").agg(
        F.min("position").alias("position"), F.bool_or("shaped").alias("shaped")
    )
    rows = found.orderBy("position", "name", "kind").collect()
    if not rows:
        raise ValueError("no archive holds a table to take a schema from")
    merged = merged_schema((r.name, T.DataType.fromDDL(r.kind)) for r in rows)
    return T.StructType(merged.fields + (shapefile.GEOMETRY_FIELDS if any(r.shaped for r in rows) else []))


def read_tables(archives: DataFrame, schema: T.StructType, **options) -> DataFrame:
    """Rows of every table in the archives, with ``source_table`` and ``error``.

    ``archives`` is a listing with ``path``, or what ``list_tables`` has made of one.  A table with a ``.shp`` member is read
    with its geometry; a lone ``.dbf`` is read as it is.  A table that fails gives
    one error row and no other; other tables of its archive are read.
    """
    out = T.StructType(schema.fields + [
        T.StructField("source_table", T.StringType()), T.StructField("error", T.StringType()),
    ])
    options = ranges.lower_options(options) | {"sourcecolumn": "source_table", "errorcolumn": "error"}
    arrow = to_arrow_schema(out)

    def rows(stem: str, parts: dict[str, bytes]) -> list[pa.RecordBatch]:
        open_ = {suffix: pa.BufferReader(content) for suffix, content in parts.items()}
        lacking = [s for s in (".shx", ".dbf") if ".shp" in parts and s not in parts]
        if lacking:
            raise ValueError(f"no {' and no '.join(lacking)} member")
        if ".shp" in parts:
            return list(shapefile.shapefile_batches(
                open_[".shp"], open_[".shx"], open_[".dbf"], arrow, options, stem, page=parts.get(".cpg"),
                projection=parts.get(".prj", b"").decode("latin-1"),
            ))
        return list(dbf.dbf_batches(open_[".dbf"], arrow, options, stem, page=parts.get(".cpg"))) if ".dbf" in parts else []

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, stem in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with files.open_archive(path) as archive:
                        members = files.members_of(archive, SUFFIXES, stem)
                        parts = {m.filename[-4:].lower(): archive.read(m) for m in members}
                    # A table counts as a whole or not at all, so its rows wait until the last is decoded.
                    yield from rows(stem, parts)
                except BAD_TABLE as problem:
                    yield ranges.error_batch(arrow, options, stem or ranges.stem_of(path), f"{type(problem).__name__}: {problem}")

    return files.archive_units(archives).mapInArrow(decode, out)
