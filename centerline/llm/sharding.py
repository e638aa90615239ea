"""Contiguous shards of nearly equal bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centerline.llm.common import batch_of, document_columns, mapped, written

_PLACED = "doc_id long, size long, text_crc32 long, part int, n long, bytes_before long, rows_before long"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums within a partition: the bytes and rows that stand before each row."""
    bytes_before = rows_before = 0
    for batch in batches:
        size = batch.column("size").to_numpy(zero_copy_only=False)
        upto = np.cumsum(size)
        rows = np.arange(batch.num_rows, dtype=np.int64)
        yield batch_of({
            "doc_id": batch.column("doc_id"), "size": batch.column("size"), "text_crc32": batch.column("text_crc32"),
            "part": batch.column("part"), "n": batch.column("n"),
            "bytes_before": bytes_before + upto - size, "rows_before": rows_before + rows,
        })
        bytes_before += int(upto[-1]) if len(upto) else 0
        rows_before += batch.num_rows


def balanced_shards(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot``.

    All rows are put in one order by id (nulls first), then checksum and size. A row that starts at byte ``b`` of
    ``total`` in that order goes to shard ``b * shards // total``: shards are contiguous, and their sizes differ from
    an equal share by at most one row at each end. ``slot`` counts the rows of a shard from 0.

    A range sort deals the rows out, each partition is summed by itself, and the partitions' totals (one small row
    per partition) are summed up in order. Rows that are equal in id and text are told apart by their place in the
    input, so that they spread over partitions. Null texts have size 1; an empty table gives no rows.
    """
    ordered = (
        document_columns(docs, doc_id, text)
        .select(
            "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.monotonically_increasing_id().alias("n"),
        )
        .repartitionByRange("doc_id", "text_crc32", "size", "n")
        .sortWithinPartitions("doc_id", "text_crc32", "size", "n")
        .withColumn("part", F.spark_partition_id())
    )
    placed = written(mapped(ordered, _placed, _PLACED), "shards")
    # One row per partition; the sums over all partitions before it.
    totals = placed.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bytes_off"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_off"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    # Decimals, since bytes times shards may pass 63 bits.
    shard = F.expr(f"cast(bytes_before + bytes_off AS decimal(20, 0)) * {int(shards)} div cast(total AS decimal(20, 0))")
    at = placed.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32", shard.cast("int").alias("shard"),
        (F.col("rows_before") + F.col("rows_off")).alias("row"),
    )
    firsts = at.groupBy("shard").agg(F.min("row").alias("first"))
    return at.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )
