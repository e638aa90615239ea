"""File inventory and archive expansion."""

from __future__ import annotations

import contextlib
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centerline.functions import names
from centerline.sources import ranges

ARCHIVE_MEMBERS = "archive string, member string, content binary, error string"

_MEMBER_SCHEMA = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("content", pa.binary()), ("error", pa.string())]
)

# What a zip archive that is no good raises; faults of the store are not among them.
BAD_ARCHIVE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError)


def list_files(
    spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = True
) -> DataFrame:
    """Files below a folder: path, name, length and modification time.

    Only the listing is read, never the bytes.  ``pattern`` is a glob on the name.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(
        "path", F.col("_metadata.file_name").alias("name"), "length", "modificationTime"
    )


def list_archives(
    spark: SparkSession, root: str, recursive: bool = False,
    state: str | None = None, dataset: str | None = None,
) -> DataFrame:
    """Zip archives of a folder, narrowed by state and dataset."""
    return list_files(spark, root, "*.zip", recursive).where(_narrow(F.col("name"), state, dataset))


def newest_file(files: DataFrame) -> DataFrame:
    """The file modified last (ties broken by path)."""
    return files.orderBy(F.desc("modificationTime"), F.asc("path")).limit(1)


def relative_path(path: Column, root: str) -> Column:
    """Path below a root, whatever scheme the listing put in front of it."""
    bare = root.split(":", 1)[-1].rstrip("/").lstrip("/")
    return F.substring_index(path, f"/{bare}/", -1)


def _narrow(name: Column, state: str | None, dataset: str | None) -> Column:
    keep = F.lit(True)
    if state:
        keep = keep & names.in_state(name, state)
    if dataset:
        keep = keep & names.of_dataset(name, dataset)
    return keep


def open_archive(path: str) -> contextlib.AbstractContextManager[zipfile.ZipFile]:
    """An archive of any store, read at random places."""

    @contextlib.contextmanager
    def opened():
        filesystem, plain = ranges.open_fs(path)
        with filesystem.open_input_file(plain) as file, zipfile.ZipFile(file) as archive:
            yield archive

    return opened()


def members_of(archive: zipfile.ZipFile, wanted: tuple[str, ...] | None, stem: str | None) -> list[zipfile.ZipInfo]:
    """Regular members with a wanted suffix and table stem."""
    return [
        i for i in archive.infolist()
        if not i.is_dir() and (not wanted or i.filename.lower().endswith(wanted))
        and (stem is None or ranges.stem_of(i.filename) == stem)
    ]


def archive_units(archives: DataFrame) -> DataFrame:
    """Units of work ``(path, stem)``: a table of an archive, spread over the tasks.

    A deflate stream cannot be split, but an archive can be read by member.  An
    archive that cannot be opened is one unit without stem, which reports it.  A
    listing that has the stems already is taken as it is.
    """

    def stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with open_archive(path) as archive:
                        found = sorted({ranges.stem_of(i.filename) for i in members_of(archive, None, None)})
                except BAD_ARCHIVE:
                    found = [None]
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([path] * len(found), pa.string()), "stem": pa.array(found, pa.string())}
                )

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = "stem" in archives.columns
    units = archives.select("path", "stem") if known else archives.select("path").mapInArrow(stems, "path string, stem string")
    return units.repartition(parts, "path", "stem")


def expand_archives(archives: DataFrame, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """One row per archive member; what is no good gives a row with its error.

    A member that fails leaves the other members alone.  ``archives`` is a listing
    with ``path``.
    """
    wanted = tuple(s.lower() for s in suffixes) if suffixes else None

    def row(*values: object) -> pa.RecordBatch:
        arrays = [pa.array([v], f.type) for v, f in zip(values, _MEMBER_SCHEMA)]
        return pa.RecordBatch.from_arrays(arrays, schema=_MEMBER_SCHEMA)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, stem in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with open_archive(path) as archive:
                        for info in members_of(archive, wanted, stem):
                            try:
                                content = archive.read(info)
                            except BAD_ARCHIVE as problem:
                                yield row(path, info.filename, None, f"{type(problem).__name__}: {problem}")
                            else:
                                yield row(path, info.filename, content, None)
                except BAD_ARCHIVE as problem:
                    yield row(path, None, None, f"{type(problem).__name__}: {problem}")

    return archive_units(archives).mapInArrow(expand, ARCHIVE_MEMBERS)
