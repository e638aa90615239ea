"""Scans of many binary files: columns found by a job, and a verdict on each file before its rows count.

A file counts as a whole or not at all.  A file of at most one split is read by one
task, which looks at all of it before it gives its first row.  The shares of a larger
file lie in different tasks; so where a bad file is no error (``errorColumn``,
``mode=DROPMALFORMED``) a pass over the large files gives a verdict per share, the
verdicts of a file are put together, and the rows of a bad file never come out.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema

from centerline.functions.typemap import merged_schema
from centerline.sources import ranges

HEADERS_PER_TASK = 1000  # files whose headers one task reads
BROADCAST_FILES = 100_000  # paths of large files of which the bad ones may be broadcast: some 10 MB
LARGE_FILE = "_large_file"

# What the passes give: fields of headers, and verdicts on shares of files.
HEADERS = "file string, position int, name string, kind string"
VERDICTS = "file string, start bigint, problem string"


@dataclass
class Format:
    """What differs between formats: the columns of a file, and the rows of a share of it."""

    suffix: str
    fields: Callable[[str, dict], list[T.StructField]]
    batches: Callable[[ranges.Piece, pa.Schema, dict], Iterator[pa.RecordBatch]]
    faults: tuple[type[Exception], ...]  # a bad format; faults of the store end the task
    further: list[T.StructField] = field(default_factory=list)  # columns every file has


def tolerant(options: dict) -> bool:
    """Whether a bad file is left out or reported, and so no error."""
    mode = options.get("mode", "permissive").lower()
    return mode == "dropmalformed" or (mode != "failfast" and bool(options.get("errorcolumn")))


def split_bytes(options: dict) -> int:
    return int(options.get("splitbytes", ranges.SPLIT_BYTES))


def _said(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


class Reader(DataSourceReader):
    """Gives rows, verdicts or headers, as the option ``pass`` says.

    Without that option, as where the format is used by itself, files are split only if
    a bad one is an error; else each is one task's, so that the task can judge it.
    """

    def __init__(self, form: Format, schema: T.StructType, options: dict):
        self.form, self.options = form, options
        self.arrow = to_arrow_schema(schema)
        self.kind = options.get("pass", "rows")

    def partitions(self):
        files, target = ranges.list_sizes(self.options, self.form.suffix), split_bytes(self.options)
        if self.kind == "headers":
            pieces = [ranges.Piece(path, 0, size, True) for path, size in files]
            return [ranges.Pieces(pieces[i:i + HEADERS_PER_TASK]) for i in range(0, len(pieces), HEADERS_PER_TASK)]
        if self.kind == "verdicts":
            files = [f for f in files if f[1] > target]
        return ranges.split_pieces(files, target, whole=self.kind == "rows" and tolerant(self.options))

    def read(self, partition: ranges.Pieces):
        kinds = {"headers": self._headers, "verdicts": self._verdict}
        for piece in partition.pieces:
            yield from kinds.get(self.kind, self._rows)(piece)

    def _headers(self, piece: ranges.Piece) -> Iterator[pa.RecordBatch]:
        try:
            fields = self.form.fields(piece.path, self.options)
        except self.form.faults:  # left to the reading of rows
            return
        columns = [piece.path] * len(fields), range(len(fields)), [f.name for f in fields], [f.dataType.simpleString() for f in fields]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.arrow)], schema=self.arrow)

    def _problem(self, piece: ranges.Piece, schema: pa.Schema) -> Exception | None:
        """What is wrong with a share; no row of it is kept."""
        try:
            for _ in self.form.batches(piece, schema, self.options):
                pass
        except self.form.faults as problem:
            return problem
        return None

    def _verdict(self, piece: ranges.Piece) -> Iterator[pa.RecordBatch]:
        rows = to_arrow_schema(T.StructType.fromJson(json.loads(self.options["rowschema"])))
        problem = self._problem(piece, rows)
        columns = [piece.path], [piece.start], [problem and _said(problem)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.arrow)], schema=self.arrow)

    def _rows(self, piece: ranges.Piece) -> Iterator[pa.RecordBatch]:
        if not tolerant(self.options):
            yield from self.form.batches(piece, self.arrow, self.options)
        elif piece.whole:
            yield from self._whole(piece)
        else:  # the verdict takes away what a bad file gives before its fault
            at = self.arrow.get_field_index(LARGE_FILE)
            try:
                for batch in self.form.batches(piece, self.arrow, self.options):
                    yield batch.set_column(at, self.arrow.field(at), pa.array([piece.path] * batch.num_rows, pa.string()))
            except self.form.faults:
                return

    def _whole(self, piece: ranges.Piece) -> Iterator[pa.RecordBatch]:
        """All rows of a file, or its fault. A file of one batch is kept for that, a longer one read twice."""
        rows = self.form.batches(piece, self.arrow, self.options)
        try:
            first = list(islice(rows, 2))
        except self.form.faults as fault:
            problem = fault
        else:
            problem = self._problem(piece, self.arrow) if len(first) > 1 else None
            if problem is None:
                yield from first
                yield from rows
                return
        report = ranges.error_batch(self.arrow, self.options, ranges.stem_of(piece.path), _said(problem))
        if report is not None:
            yield report


def driver_schema(form: Format, options: dict) -> T.StructType:
    """Columns for a format that is used without a schema and without ``scan``: headers are read here, one by one."""

    def columns() -> Iterator[tuple[str, T.DataType]]:
        for path, _ in ranges.list_sizes(options, form.suffix):
            try:
                yield from ((f.name, f.dataType) for f in form.fields(path, options))
            except form.faults:
                continue

    return _schema(form, merged_schema(columns()), options)


def _schema(form: Format, found: T.StructType, options: dict) -> T.StructType:
    if not found.fields:
        raise ValueError("no readable file to take a schema from")
    return ranges.pick_columns(T.StructType(found.fields + form.further), options)


def scan(
    spark: SparkSession, source: type[DataSource], form: Format, path: str, schema: T.StructType | str | None, options: dict,
) -> DataFrame:
    """Rows of the files below a path, the same whatever the split size is.

    Without a schema, tasks read the headers, and a row per different field comes back.
    """
    spark.dataSource.register(source)
    lower = ranges.lower_options(options)

    def load(kind: str, columns: T.StructType | str, **more: str) -> DataFrame:
        reader = spark.read.format(source.name()).options(**options, **more).option("pass", kind)
        return reader.schema(columns).load(path)

    if schema is None:
        # Fields in the order in which the files, by path, first have them.
        fields = load("headers", HEADERS).groupBy("name", "kind").agg(F.min(F.struct("file", "position")).alias("at"))
        found = fields.orderBy("at", "kind").collect()
        schema = _schema(form, merged_schema((r.name, T.DataType.fromDDL(r.kind)) for r in found), lower)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    large = tolerant(lower) and sum(size > split_bytes(lower) for _, size in ranges.list_sizes(lower | {"path": path}, form.suffix))
    if not large:
        return load("rows", schema)
    verdicts = load("verdicts", VERDICTS, rowSchema=schema.json()).where("problem IS NOT NULL")
    bad = verdicts.groupBy("file").agg(F.min_by("problem", "start").alias("problem"))
    rows = load("judged", T.StructType([*schema.fields, T.StructField(LARGE_FILE, T.StringType())]))
    paths = bad.select(F.col("file").alias(LARGE_FILE))
    good = rows.join(F.broadcast(paths) if large <= BROADCAST_FILES else paths, LARGE_FILE, "left_anti").drop(LARGE_FILE)
    if not lower.get("errorcolumn"):
        return good
    stem = F.regexp_extract("file", r"([^/]*?)(?:\.[^./]*)?$", 1)
    known = {lower["errorcolumn"]: F.concat(stem, F.lit(": "), "problem"), lower.get("sourcecolumn"): stem}
    return good.unionAll(bad.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]))
