"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

# Runtime settings every job here expects; all of them are Spark defaults in
# 4.x except the partition floor, and none depends on the size of the data.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State of streams on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Paths that ``scratch_dir`` has handed out.
_MADE: list[str] = []

# Scratch folder of a local run whose session names no shared folder.
_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and for ``bench.py``."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("centerline")
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEM", "8g"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a ``local`` master that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if "path" not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH["path"] = tempfile.mkdtemp(prefix="centerline-")
    return _LOCAL_SCRATCH["path"]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove what this process has put below the shared folder, and tables that lie there; number of folders.

    For use when no frame that reads them is needed any more.
    """
    made = {path.split(":", 1)[-1].replace("//", "/") for path in _MADE}
    for row in spark.catalog.listTables():
        if row.isTemporary or row.tableType != "EXTERNAL":
            continue
        detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED `{row.name}`").collect()}
        if detail.get("Location", "").split(":", 1)[-1].replace("//", "/") in made:
            spark.sql(f"DROP TABLE `{row.name}`")
    removed = 0
    while _MADE:
        path = _MADE.pop()
        filesystem, plain = (fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path))
        if filesystem.get_file_info(plain).type == fs.FileType.Directory:
            filesystem.delete_dir(plain)
            removed += 1
    return removed
