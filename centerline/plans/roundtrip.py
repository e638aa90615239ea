"""Files for the round-trip queries: given tables written in the binary formats.

Spark builds the fixed-width text of the records; a task only puts headers around
what it holds and writes one file per Arrow batch into the shared folder.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.sources import ranges


@dataclass
class DbfField:
    name: str
    code: str
    width: int
    decimals: int = 0


def record_text(fields: list[DbfField], deleted: str | None = None) -> Column:
    """One record as text: a live flag, then each field padded to its width."""
    parts = [F.when(F.col(deleted), "*").otherwise(" ") if deleted else F.lit(" ")]
    for f in fields:
        value = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
        wide = F.raise_error(F.concat(F.lit(f"too wide for {f.name}: "), value)).cast("string")
        value = F.when(F.length(value) <= f.width, value).otherwise(wide)
        parts.append(F.rpad(value, f.width, " ") if f.code in "CDL" else F.lpad(value, f.width, " "))
    return F.concat(*parts)


def dbf_bytes(fields: list[DbfField], records: list[str]) -> bytes:
    length, width = 33 + 32 * len(fields), 1 + sum(f.width for f in fields)
    head = struct.pack("<4BIHH20x", 3, 125, 1, 1, len(records), length, width)
    for f in fields:
        head += struct.pack("<11sc4xBB14x", f.name.upper().encode(), f.code.encode(), f.width, f.decimals)
    return head + b"\r" + "".join(records).encode("ascii") + b"\x1a"


def line_bytes(points: np.ndarray, parts: list[int], kind: int = 3) -> tuple[bytes, bytes]:
    """Polyline or polygon (``kind`` 5) ``.shp`` and ``.shx`` bytes; all records have the same part starts.

    ``points`` is records by points by two.
    """
    count, n_points, _ = points.shape
    content = 44 + 4 * len(parts) + 16 * n_points
    body = np.zeros((count, 8 + content), dtype="u1")

    def put(at: int, values: np.ndarray, kind: str) -> None:
        raw = np.ascontiguousarray(values, dtype=kind).view("u1").reshape(count, -1)
        body[:, at:at + raw.shape[1]] = raw

    put(0, np.arange(1, count + 1), ">i4")
    put(4, np.full(count, content // 2), ">i4")
    put(8, np.full(count, kind), "<i4")
    low, high = points.min(axis=1), points.max(axis=1)
    put(12, np.hstack([low, high]), "<f8")
    put(44, np.tile([len(parts), n_points, *parts], (count, 1)), "<i4")
    put(52 + 4 * len(parts), points.reshape(count, -1), "<f8")
    offsets = 50 + np.arange(count) * ((8 + content) // 2)
    index = np.stack([offsets, np.full(count, content // 2)], axis=1).astype(">i4").tobytes()
    box = [*low.min(axis=0), *high.max(axis=0)] if count else [0.0] * 4

    def head(size: int) -> bytes:
        return struct.pack(">i20xi", 9994, (100 + size) // 2) + struct.pack("<2i4d32x", 1000, kind, *box)

    return head(body.nbytes) + body.tobytes(), head(len(index)) + index


def zip_bytes(members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return out.getvalue()


def write_files(
    rows: DataFrame, fields: list[DbfField], path: str, stem: str,
    points: str | None = None, parts: list[int] | None = None, zipped: bool = False,
    deleted: str | None = None, kind: int = 3, by: str | None = None,
) -> None:
    """Write the rows as DBF files, shapefiles (with a point list), or zip archives.

    A file is named by its task and batch, so a repeated task writes it again; with ``by``
    there is a file for each value of that column, with its records in order.
    """
    columns = [record_text(fields, deleted).alias("record")]
    if points:
        columns.append(F.col(points).cast("array<double>").alias("points"))

    def put(name: str, batch: pa.RecordBatch | pa.Table) -> pa.Table:
        filesystem, folder = ranges.open_fs(path)
        filesystem.create_dir(folder, recursive=True)
        members = {f"{name}.dbf": dbf_bytes(fields, batch.column(0).to_pylist())}
        if points:
            lists = batch.column(1)
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            members[f"{name}.prj"] = b'GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983"]]'
            members[f"{name}.shp"], members[f"{name}.shx"] = line_bytes(
                flat.reshape(batch.num_rows, -1, 2), parts or [0], kind
            )
        if zipped:
            members = {f"{name}.zip": zip_bytes(members)}
        for member, content in members.items():
            with filesystem.open_output_stream(f"{folder}/{member}") as out:
                out.write(content)
        return pa.table({"file": pa.array([name]), "n": pa.array([batch.num_rows], pa.int64())})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            yield from put(f"tl_2025_{task % 100:02d}{number % 1000:03d}_{stem}{task}x{number}", batch).to_batches()

    def write_group(group: pa.Table) -> pa.Table:
        return put(f"tl_2025_13001_{stem}{group.column('by')[0].as_py()}", group.sort_by("record"))

    if by:
        done = rows.select(*columns, F.col(by).alias("by")).groupBy("by").applyInArrow(write_group, "file string, n bigint")
    else:
        done = rows.select(*columns).mapInArrow(write, "file string, n bigint")
    done.write.format("noop").mode("overwrite").save()
