"""Shared parts of the binary sources: listing, splitting and source options."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import InputPartition

from centerline.functions.names import STATE_IN_NAME

SPLIT_BYTES = 64 << 20  # file bytes per split
TASKS = 256  # tasks beyond which small splits are put together, until a task has SPLIT_BYTES
BATCH_BYTES = 8 << 20  # file bytes per Arrow batch


@dataclass
class Piece:
    """A share of one file: bytes ``[start, stop)`` of the file that is split, or all of it."""

    path: str
    start: int
    stop: int
    whole: bool = False


class Pieces(InputPartition):
    """Work of one task: one share of a large file or several small files."""

    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a local path or URI."""
    if re.match(r"^file:/[^/]", path):
        path = "file://" + path[len("file:"):]
    if "://" in path:
        # Spark names the same store s3a.
        return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
    return fs.LocalFileSystem(), path


def list_sizes(options: dict, suffix: str) -> list[tuple[str, int]]:
    """Path and size of the files a scan covers, in path order."""
    root = options.get("path", "").rstrip("/")
    if not root:
        raise ValueError("the source needs a path")
    filesystem, plain = open_fs(root)
    scheme = root[: len(root) - len(plain)] if "://" in root and root.endswith(plain) else ""
    info = filesystem.get_file_info(plain)
    if info.type == fs.FileType.File:
        found = [info]
    elif info.type == fs.FileType.Directory:
        recursive = options.get("recursivefilelookup", "true") == "true"
        found = filesystem.get_file_info(fs.FileSelector(plain, recursive=recursive))
    else:
        raise FileNotFoundError(root)
    state, dataset = options.get("state"), options.get("dataset")
    in_state = re.compile(STATE_IN_NAME % re.escape(state)) if state else None
    return sorted(
        (scheme + f.path, f.size)
        for f in found
        if f.type == fs.FileType.File
        and f.base_name.lower().endswith(suffix)
        and (in_state is None or in_state.search(f.base_name))
        and (not dataset or dataset in f.base_name)
    )


def split_pieces(files: list[tuple[str, int]], target: int, whole: bool = False) -> list[Pieces]:
    """Cut files larger than ``target`` bytes, unless they are to stay ``whole``, and deal the pieces out to tasks.

    A task has about ``target`` bytes. Where that were more than ``TASKS`` tasks it has as many times more, up to
    ``SPLIT_BYTES``: starting a task costs as much as reading many small pieces.
    """
    tasks, open_task, filled = [], [], 0
    share = max(target, min(SPLIT_BYTES, sum(size for _, size in files) // TASKS))
    for path, size in files:
        cuts = [0] if whole else list(range(0, size, target)) or [0]
        for start in cuts:
            stop = size if whole else min(start + target, size)
            if open_task and filled + stop - start > share:
                tasks.append(Pieces(open_task))
                open_task, filled = [], 0
            open_task.append(Piece(path, start, stop, len(cuts) == 1))
            filled += stop - start
    return tasks + [Pieces(open_task)] if open_task else tasks


def pick_columns(schema: T.StructType, options: dict) -> T.StructType:
    """Columns named by the ``columns`` option, or all of them."""
    if options.get("columns"):
        wanted = [c.strip().lower() for c in options["columns"].split(",")]
        schema = T.StructType([schema[c] for c in wanted])
    for option in ("sourcecolumn", "errorcolumn"):
        if options.get(option):
            schema = schema.add(options[option], "string")
    return schema


def lower_options(options: dict) -> dict:
    return {k.lower(): v for k, v in options.items()}


def or_first_fault(decode: Callable, first: int, last: int, before: int, faults: tuple[type[Exception], ...]):
    """What ``decode`` makes of items ``[first, last)``; if it fails, an error for the first of them that does.

    Items are found by halving, so that the error is the same whatever is decoded
    together; ``before`` items of the file stand before them.
    """
    try:
        return decode(first, last)
    except faults as problem:
        found = problem
    while last - first > 1:
        middle = (first + last) // 2
        try:
            decode(first, middle)
        except faults as problem:
            last, found = middle, problem
        else:
            first = middle
    try:
        decode(first, last)
    except faults as problem:
        found = problem
    raise ValueError(f"record {before + first + 1}: {found}") from found


def error_batch(schema: pa.Schema, options: dict, stem: str, problem: str) -> pa.RecordBatch | None:
    """One row that reports a file which could not be read, if asked for."""
    column = options.get("errorcolumn")
    if not column:
        return None
    known = {column: f"{stem}: {problem}", options.get("sourcecolumn"): stem}
    return pa.RecordBatch.from_arrays(
        [pa.array([known.get(f.name)], f.type) for f in schema], schema=schema
    )


def stem_of(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name[1:] else name
