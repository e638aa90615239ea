"""The manifest as a stream.

The fold's aggregates run as they are, as streaming aggregations: Spark keeps the
state, one row per key, and each batch writes only the rows it changed, below a
folder of its own.  The latest batch of a key holds its row.  The aggregates order
events by ``seq``, so an event that comes late is placed where it belongs.

Every so many batches the changes are merged into a snapshot of the table: rows of
the snapshot before whose keys did not change, and the latest change of the others.
That waits until the changes are half as large as the snapshot, so a table that only
grows is not written over and over.  A reader takes the last complete snapshot and
the changes behind it: those of the last few batches, or half as much as the snapshot
has.  A batch or a snapshot that is written again replaces its folder with the same
rows.  Folders go when two snapshots cover them, so a reader that has chosen a
snapshot can finish.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from centerline.operators import manifest
from centerline.session import JOB_CONF
from centerline.sources.ranges import open_fs

SNAPSHOT_EVERY = 16  # batches

_STORE = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"

# Key columns and fold of each table kept by a stream.
VIEWS: dict[str, tuple[list[str], Callable[[DataFrame], DataFrame]]] = {
    "files": (["path"], manifest.fold_files),
    "url_lists": (["url"], manifest.fold_url_lists),
    "mark_counters": (["state_fips"], manifest.count_marks),
    "discovered_urls": (["state_fips", "url"], manifest.fold_discovered),
    "called_urls": (["state_fips", "seq", "url"], manifest.fold_calls),
}


def start_view(
    events: DataFrame, view: str, root: str, available_now: bool = True, snapshot_every: int = SNAPSHOT_EVERY,
    state_partitions: int | None = None, **trigger,
) -> StreamingQuery:
    """Keep one manifest table up to date from a stream of events.

    ``mark_events`` feed ``files``, ``url_lists`` and ``mark_counters``;
    ``discover_calls`` feed ``discovered_urls`` and ``called_urls``.  Unless the session
    names another store, state is kept on disk (RocksDB).

    Every batch opens and commits each partition of the state, however little it holds.
    So there are ``state_partitions`` of them, or as many as the cluster has cores but
    no more than the session's shuffle partitions; a stream that is started again keeps
    the number it had.
    """
    conf = events.sparkSession.conf
    if conf.get(_STORE, "").endswith("HDFSBackedStateStoreProvider"):
        conf.set(_STORE, JOB_CONF[_STORE])
    _, fold = VIEWS[view]

    def write(changed: DataFrame, batch: int) -> None:
        write_batch(changed, view, root, batch, snapshot_every)

    writer = fold(events).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", f"{root}/{view}/checkpoint").queryName(view)
    writer = writer.trigger(**({"availableNow": True} if available_now else trigger))
    usual = conf.get(_PARTITIONS)
    cores = events.sparkSession.sparkContext.defaultParallelism
    conf.set(_PARTITIONS, state_partitions or min(int(usual), cores))
    try:
        return writer.start()  # the stream takes a copy of the session's settings
    finally:
        conf.set(_PARTITIONS, usual)


def write_batch(changed: DataFrame, view: str, root: str, batch: int, snapshot_every: int = SNAPSHOT_EVERY) -> None:
    """Write the rows that a batch changed, and after every so many batches a snapshot, if the changes are large enough."""
    changed.write.mode("overwrite").parquet(f"{root}/{view}/changes/batch={batch}")
    if (batch + 1) % snapshot_every:
        return
    earlier = [n for n in _complete(f"{root}/{view}/snapshots") if n < batch]
    base = max(earlier, default=-1)
    behind = sum(_size(f"{root}/{view}/changes/batch={n}") for n in _complete(f"{root}/{view}/changes") if base < n <= batch)
    if base >= 0 and 2 * behind < _size(f"{root}/{view}/snapshots/upto={base}"):
        return
    _merged(changed.sparkSession, view, root, base, batch).write.mode("overwrite").parquet(f"{root}/{view}/snapshots/upto={batch}")
    _remove(f"{root}/{view}/snapshots", [n for n in earlier if n < base])
    _remove(f"{root}/{view}/changes", [n for n in _complete(f"{root}/{view}/changes") if n <= base])


def _folders(path: str) -> dict[int, str]:
    """Numbered folders ``name=number`` of a path."""
    filesystem, plain = open_fs(path)
    found = filesystem.get_file_info(fs.FileSelector(plain, allow_not_found=True))
    names = [f.base_name for f in found if f.type == fs.FileType.Directory and "=" in f.base_name]
    return {int(n.rpartition("=")[2]): f"{plain}/{n}" for n in names}


def _complete(path: str) -> list[int]:
    """Numbers of the folders whose writing has ended, ascending."""
    filesystem, _ = open_fs(path)
    folders = _folders(path)
    marks = filesystem.get_file_info([f"{folder}/_SUCCESS" for folder in folders.values()]) if folders else []
    return sorted(n for n, mark in zip(folders, marks) if mark.type == fs.FileType.File)


def _size(path: str) -> int:
    """Bytes of the files in a folder."""
    filesystem, plain = open_fs(path)
    return sum(f.size for f in filesystem.get_file_info(fs.FileSelector(plain)) if f.type == fs.FileType.File)


def _remove(path: str, numbers: list[int]) -> None:
    filesystem, _ = open_fs(path)
    folders = _folders(path)
    for n in numbers:
        filesystem.delete_dir(folders[n])


def _merged(spark: SparkSession, view: str, root: str, base: int, upto: int | None = None) -> DataFrame:
    """The table as of a batch, from the snapshot of batch ``base`` (-1: none) and the changes behind it."""
    keys, _ = VIEWS[view]
    snapshot = spark.read.parquet(f"{root}/{view}/snapshots/upto={base}") if base >= 0 else None
    changes = f"{root}/{view}/changes"
    numbers = [n for n in _complete(changes) if n > base and (upto is None or n <= upto)]
    if not numbers and snapshot is not None:
        return snapshot
    # The number is read as a column of the folder's name.
    rows = spark.read.option("basePath", changes).parquet(*[f"{changes}/batch={n}" for n in numbers] or [changes])
    rows = rows.withColumn("batch", F.col("batch").cast("bigint"))
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("row")).select(*keys, "row.*")
    if snapshot is None:
        return latest
    changed = latest.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same: Column = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return snapshot.join(changed, same, "left_anti").unionByName(latest)


def current(spark: SparkSession, view: str, root: str) -> DataFrame:
    """The table as of the last batch: the last snapshot with the latest change of each key since."""
    return _merged(spark, view, root, max(_complete(f"{root}/{view}/snapshots"), default=-1))


def states(spark: SparkSession, root: str) -> DataFrame:
    """State rows as of the last batches: names, counters and when they changed last."""
    calls = current(spark, "called_urls", root)
    return manifest.merge_counters(current(spark, "mark_counters", root), manifest.count_calls(calls))
