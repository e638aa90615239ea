"""DBF tables as a Spark source.

A DBF file is a header and fixed-width text records, so a task reads its own
range of records; fields are decoded a whole column at a time.  The text of a
table is in the encoding its header or its ``.cpg`` file names.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema

from centerline.functions.typemap import dbf_spark_type
from centerline.sources import ranges, scans


# Language bytes of a header and the encodings they stand for.
LANGUAGES = {
    0x01: "cp437", 0x02: "cp850", 0x03: "cp1252", 0x08: "cp865", 0x09: "cp437", 0x0A: "cp850", 0x0B: "cp437",
    0x0D: "cp437", 0x0E: "cp850", 0x0F: "cp437", 0x10: "cp850", 0x11: "cp437", 0x12: "cp850", 0x13: "cp932",
    0x14: "cp850", 0x15: "cp437", 0x16: "cp850", 0x17: "cp865", 0x18: "cp437", 0x19: "cp437", 0x1A: "cp850",
    0x1B: "cp437", 0x1C: "cp863", 0x1D: "cp850", 0x1F: "cp852", 0x22: "cp852", 0x23: "cp852", 0x24: "cp860",
    0x25: "cp850", 0x26: "cp866", 0x37: "cp850", 0x40: "cp852", 0x4D: "cp936", 0x4E: "cp949", 0x4F: "cp950",
    0x50: "cp874", 0x57: "cp1252", 0x58: "cp1252", 0x59: "cp1252", 0x64: "cp852", 0x65: "cp866", 0x66: "cp865",
    0x67: "cp861", 0x6A: "cp737", 0x6B: "cp857", 0x6C: "cp863", 0x78: "cp950", 0x79: "cp949", 0x7A: "cp936",
    0x7B: "cp932", 0x7C: "cp874", 0x86: "cp737", 0x87: "cp852", 0x88: "cp857", 0xC8: "cp1250", 0xC9: "cp1251",
    0xCA: "cp1254", 0xCB: "cp1253", 0xCC: "cp1257",
}


@dataclass
class Field:
    name: str
    code: str
    offset: int
    width: int
    decimals: int


@dataclass
class Header:
    records: int
    length: int
    record_length: int
    fields: list[Field]
    encoding: str | None = None  # None: UTF-8, and Latin-1 for a value that is not


def read_header(file: pa.NativeFile, whole: bool = True) -> Header:
    """Header of an open DBF file.

    With ``whole`` the records it counts must all be there.
    """
    start = file.read_at(32, 0)
    if len(start) < 32:
        raise ValueError("no DBF header")
    records, length, record_length = struct.unpack_from("<IHH", start, 4)
    if record_length == 0 or length < 33:
        raise ValueError("bad DBF header")
    body = file.read_at(length - 32, 32)
    fields, offset = [], 1  # the first byte of a record is its deletion flag
    for at in range(0, len(body) - 31, 32):
        if body[at] == 0x0D:
            break
        name = body[at:at + 11].split(b"\0")[0].decode("ascii").strip().lower()
        code, width, decimals = chr(body[at + 11]), body[at + 16], body[at + 17]
        fields.append(Field(name, code, offset, width, decimals))
        offset += width
    if offset > record_length:
        raise ValueError("DBF fields exceed the record")
    if whole and file.size() < length + records * record_length:
        raise ValueError(f"cut off: {records} records need {length + records * record_length} bytes, {file.size()} are there")
    return Header(records, length, record_length, fields, LANGUAGES.get(start[29]))


def code_page(text: bytes) -> str | None:
    """Encoding that the text of a ``.cpg`` file names."""
    name = text.decode("ascii", "replace").strip().lower()
    if name in ("", "utf-8", "utf8", "65001"):
        return "utf-8" if name else None
    name = re.sub(r"^(ansi|oem|windows-?|cp|ibm)\s*", "cp", name)
    name = re.sub(r"^(?:iso[ -]?)?8859[ -]?(\d+)$", r"iso8859-\1", name)
    name = f"cp{name}" if name.isdigit() else name
    codecs.lookup(name)
    return name


def header_schema(header: Header, strict: bool = False, dates_as_text: bool = False) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, dbf_spark_type(f.code, f.width, f.decimals, strict, dates_as_text))
        for f in header.fields
    ])


def _text(raw: np.ndarray, encoding: str | None) -> pa.Array:
    """Text of a field; a value that is not in the encoding is decoded by itself."""
    count, width = raw.shape
    fixed = pa.Array.from_buffers(pa.binary(width), count, [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())
    if encoding in (None, "utf-8") or raw.size == 0 or raw.max() < 0x80:
        try:
            return fixed.cast(pa.string())
        except pa.ArrowInvalid:
            pass

    def value(found: bytes) -> str:
        try:
            return found.decode(encoding or "utf-8")
        except UnicodeDecodeError:
            return found.decode(encoding, "replace") if encoding else found.decode("latin-1")

    return pa.array([value(v) for v in fixed.to_pylist()], pa.string())


def decode_field(
    raw: np.ndarray, code: str, want: pa.DataType, encoding: str | None = None, blank_null: bool = True
) -> pa.Array:
    """One field of many records, ``raw`` being records by bytes."""
    if code == "I":
        whole = np.ascontiguousarray(raw[:, :4]).view("<i4").ravel()
        return pa.array(whole).cast(want)
    if code in "NF" and pa.types.is_string(want):  # numbers in one file, text in another
        text = pc.utf8_trim(_text(raw, encoding), characters=" \0*")
        return pc.if_else(pc.equal(text, ""), None, text)
    text = _text(raw, encoding)
    if pa.types.is_string(want) and code != "D":
        text = pc.utf8_rtrim(text, characters=" \0")
        return pc.if_else(pc.equal(text, ""), None, text) if blank_null else text
    text = pc.utf8_trim(text, characters=" \0*")
    if pa.types.is_boolean(want):
        yes, no = (pc.is_in(text, pa.array(list(v))) for v in ("TtYy", "FfNn"))
        return pc.if_else(yes, True, pc.if_else(no, False, pa.scalar(None, pa.bool_())))
    if code == "D":
        text = pc.if_else(pc.equal(pc.utf8_trim(text, characters="0"), ""), None, text)
        return pc.strptime(text, format="%Y%m%d", unit="s").cast(pa.date32()).cast(want)
    text = pc.if_else(pc.equal(text, ""), None, text)
    if not pa.types.is_integer(want):
        return text.cast(want)
    # A decimal point in a field of whole numbers; each value is read by itself.
    pointed = pc.match_substring_regex(text, "[.eE]")
    if not pc.any(pointed).as_py():
        return text.cast(want)
    return pc.if_else(pointed, pc.if_else(pointed, text, None).cast(pa.float64()).cast(want), pc.if_else(pointed, None, text).cast(want))


def decode_records(
    file: pa.NativeFile, header: Header, first: int, last: int, schema: pa.Schema, options: dict
) -> Iterator[tuple[int, np.ndarray, dict[str, pa.Array]]]:
    """Batches of records ``[first, last)``: start, live flags, columns by name."""
    by_name = {f.name: f for f in header.fields}
    step = max(1, ranges.BATCH_BYTES // header.record_length)
    encoding = options.get("encoding") or header.encoding
    blank_null = options.get("blankasnull", "true") == "true"
    for start in range(first, last, step):
        count = min(step, last - start)
        block = file.read_at(count * header.record_length, header.length + start * header.record_length)
        raw = np.frombuffer(block, dtype="u1").reshape(count, header.record_length)

        def fields(a: int, z: int, raw=raw) -> dict[str, pa.Array]:
            return {
                out.name: decode_field(raw[a:z, f.offset:f.offset + f.width], f.code, out.type, encoding, blank_null)
                for out in schema
                if (f := by_name.get(out.name)) is not None
            }

        yield start, raw[:, 0] != ord("*"), ranges.or_first_fault(fields, 0, count, start, (ValueError, LookupError))


def to_batch(schema: pa.Schema, columns: dict[str, pa.Array], keep: np.ndarray) -> pa.RecordBatch:
    """Record batch in schema order; a column the file lacks is NULL."""
    arrays = [
        columns[f.name] if f.name in columns else pa.nulls(len(keep), f.type) for f in schema
    ]
    batch = pa.RecordBatch.from_arrays(arrays, schema=schema)
    return batch if keep.all() else batch.filter(pa.array(keep))


def dbf_batches(
    file: pa.NativeFile, schema: pa.Schema, options: dict, stem: str,
    start: int = 0, stop: int | None = None, page: bytes | None = None,
) -> Iterator[pa.RecordBatch]:
    """Rows of the records that begin in bytes ``[start, stop)`` of a file.

    ``page`` is the text of its ``.cpg`` file, if it has one.
    """
    header = read_header(file)
    if page is not None:
        header.encoding = code_page(page) or header.encoding
    edges = [
        min(max(-(-(at - header.length) // header.record_length), 0), header.records)
        for at in (start, file.size() if stop is None else stop)
    ]
    source = options.get("sourcecolumn")
    for _, keep, columns in decode_records(file, header, *edges, schema, options):
        if source:
            columns[source] = pa.array([stem] * len(keep), pa.string())
        yield to_batch(schema, columns, keep)


def sibling(filesystem: fs.FileSystem, plain: str, suffix: str) -> str | None:
    """Path of the file of the same name with another suffix, if it exists."""
    for s in (suffix, suffix.upper()):
        if filesystem.get_file_info(plain[:-4] + s).type == fs.FileType.File:
            return plain[:-4] + s
    return None


def _open_page(filesystem: fs.FileSystem, plain: str) -> bytes | None:
    page = sibling(filesystem, plain, ".cpg")
    if page is None:
        return None
    with filesystem.open_input_file(page) as file:
        return file.read()


def _piece_batches(piece: ranges.Piece, schema: pa.Schema, options: dict) -> Iterator[pa.RecordBatch]:
    filesystem, plain = ranges.open_fs(piece.path)
    page = _open_page(filesystem, plain)
    with filesystem.open_input_file(plain) as file:
        yield from dbf_batches(file, schema, options, ranges.stem_of(piece.path), piece.start, piece.stop, page)


def table_fields(path: str, options: dict) -> list[T.StructField]:
    """Columns that the header of a DBF file names."""
    filesystem, plain = ranges.open_fs(path)
    with filesystem.open_input_file(plain) as file:
        header = read_header(file, whole=False)
    strict, as_text = (options.get(o) == "true" for o in ("stricttypes", "datesastext"))
    return header_schema(header, strict, as_text).fields


FORMAT = scans.Format(".dbf", table_fields, _piece_batches, (ValueError, LookupError))


class DbfSource(DataSource):
    """``spark.read.format("dbf").load(path)``; ``read_dbf`` does more in parallel.

    Options: ``columns``, ``state``, ``dataset``, ``recursiveFileLookup``,
    ``encoding``, ``blankAsNull``, ``strictTypes``, ``datesAsText``,
    ``sourceColumn``, ``errorColumn``, ``mode`` and ``splitBytes``.  Without a
    schema the headers of all files are read first and merged, here on the driver.
    """

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> T.StructType:
        return scans.driver_schema(FORMAT, ranges.lower_options(self.options))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return scans.Reader(FORMAT, schema, ranges.lower_options(self.options))


def read_dbf(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Rows of the DBF files below a path; without a schema tasks read the headers of all files."""
    return scans.scan(spark, DbfSource, FORMAT, path, schema, options)
