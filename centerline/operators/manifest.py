"""The manifest: state derived from append-only events.

``mark_events`` (:data:`plans.schemas.MARK_EVENTS`) holds every completed, failed
and partial mark in call order ``seq``; ``discover_calls`` holds the URLs of every
discovery call.  Each table below is one aggregation over them.  The aggregates
combine on the map side and do not depend on arrival order, so a key with a third
of the events costs one row per task, and the same expressions run as a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from centerline.functions import names


def _when_kind(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def _last_of(kind: str, column: str) -> Column:
    """Latest event of a kind as ``struct<seq, value>``."""
    return F.max(_when_kind(kind, F.struct("seq", F.col(column).alias("value"))))


def file_aggregates() -> list[Column]:
    """Aggregates of the fold of ``files`` per path."""
    return [
        F.max_by(F.struct("kind", "url", "state_fips", "ts"), "seq").alias("last"),
        _last_of("completed", "size").alias("done"),
        _last_of("partial", "bytes_downloaded").alias("part"),
        _last_of("failed", "error").alias("fail"),
    ]


def finish_files(folded: DataFrame, mode: str = "merge") -> DataFrame:
    """Columns of ``files`` from the aggregates.

    merge: a completed mark clears error and partial size, a failed mark keeps
    both sizes, a partial mark keeps size and error.  replace: the last mark alone
    counts.
    """
    if mode == "merge":
        def value(event: str) -> Column:
            newer = F.col("done").isNull() | (F.col(f"{event}.seq") > F.col("done.seq"))
            return F.when(newer, F.col(f"{event}.value"))

        size, part, fail = F.col("done.value"), value("part"), value("fail")
    elif mode == "replace":
        def value(event: str, kind: str) -> Column:
            return F.when(F.col("last.kind") == kind, F.col(f"{event}.value"))

        size, part, fail = value("done", "completed"), value("part", "partial"), value("fail", "failed")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return folded.select(
        "path", "last.url", F.col("last.kind").alias("status"), "last.state_fips",
        size.alias("size"), part.alias("bytes_downloaded"), fail.alias("error"),
        F.col("last.ts").alias("timestamp"),
    )


def fold_files(marks: DataFrame, mode: str = "merge") -> DataFrame:
    """Current row of every path."""
    return finish_files(marks.groupBy("path").agg(*file_aggregates()), mode)


def list_aggregates() -> list[Column]:
    """Aggregates of ``url_lists`` per URL; all fixed-width, so they hash."""
    return [
        F.max(_when_kind("completed", F.col("seq"))).alias("done_seq"),
        F.max(_when_kind("failed", F.col("seq"))).alias("fail_seq"),
        F.max_by("ts", "seq").alias("added_at"),
    ]


def finish_lists(folded: DataFrame) -> DataFrame:
    done = F.coalesce(F.col("done_seq") > F.col("fail_seq"), F.col("fail_seq").isNull())
    kind = F.when(done, "completed").otherwise("failed")
    return folded.select("url", kind.alias("list_type"), "added_at")


def fold_url_lists(marks: DataFrame) -> DataFrame:
    """Latest of completed and failed per URL; partial marks do not count."""
    ended = marks.where(F.col("kind").isin("completed", "failed"))
    return finish_lists(ended.groupBy("url").agg(*list_aggregates()))


def fold_discovered(calls: DataFrame, mode: str = "keep") -> DataFrame:
    """Known URLs per state.

    keep: a URL stays with the time it was first seen.  replace: only the URLs of
    the last call of each state stand.  A call without URLs is a row whose ``url``
    is NULL.
    """
    if mode == "replace":
        last = calls.groupBy("state_fips").agg(F.max("seq").alias("seq"))
        calls = calls.join(last, ["state_fips", "seq"], "left_semi")
    elif mode != "keep":
        raise ValueError(f"unknown mode {mode!r}")
    named = calls.where(F.col("url").isNotNull())
    return named.groupBy("state_fips", "url").agg(F.min_by("ts", "seq").alias("discovered_at"))


def new_discoveries(known: DataFrame, call: DataFrame) -> DataFrame:
    """Rows of a call to append: pairs ``(state_fips, url)`` not known yet."""
    fresh = call.where(F.col("url").isNotNull()).groupBy("state_fips", "url").agg(
        F.min_by("ts", "seq").alias("discovered_at")
    )
    return fresh.join(known, ["state_fips", "url"], "left_anti")


def count_marks(marks: DataFrame) -> DataFrame:
    """Marks per state; calls without a state do not count."""
    ended = F.col("kind").isin("completed", "failed")
    return marks.where("state_fips <> ''").groupBy("state_fips").agg(
        F.count_if(F.col("kind") == "completed").alias("completed"),
        F.count_if(F.col("kind") == "failed").alias("failed"),
        F.max(F.when(ended, F.col("ts"))).alias("moved"),
        F.min("ts").alias("created"),
    )


def fold_calls(calls: DataFrame) -> DataFrame:
    """The URLs of each call, once each."""
    return calls.groupBy("state_fips", "seq", "url").agg(F.max("ts").alias("ts"))


def count_calls(calls: DataFrame) -> DataFrame:
    """Size of the last discovered set per state."""
    # The first step has the URL in its key through the distinct count, so one
    # very long call is spread over many tasks.
    per_call = calls.groupBy("state_fips", "seq").agg(
        F.count_distinct("url").alias("n"), F.max("ts").alias("ts")
    )
    return per_call.groupBy("state_fips").agg(
        F.max_by("n", "seq").alias("discovered"), F.max("ts").alias("moved"), F.min("ts").alias("created")
    )


def merge_counters(marked: DataFrame, called: DataFrame | None = None) -> DataFrame:
    """State rows from the counts of marks and of discovery calls."""
    zero = F.lit(0).cast("bigint")
    rows = marked.withColumn("discovered", zero)
    if called is not None:
        rows = rows.unionByName(called.withColumns({"completed": zero, "failed": zero}))
    return rows.groupBy("state_fips").agg(
        names.default_state_name(F.col("state_fips")).alias("name"),
        F.sum("completed").alias("completed"),
        F.sum("failed").alias("failed"),
        F.sum("discovered").alias("discovered"),
        F.coalesce(F.max("moved"), F.min("created")).alias("last_updated"),
    )


def fold_states(marks: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """Counters per state.

    ``completed`` and ``failed`` count marks, not files: a file marked twice counts
    twice.  ``discovered`` is the size of the last set given.  A partial mark only
    creates the row.
    """
    return merge_counters(count_marks(marks), None if calls is None else count_calls(calls))


def name_states(states: DataFrame, dim: DataFrame) -> DataFrame:
    """States under their real names; the dimension has 56 rows."""
    real = dim.select("state_fips", F.col("name").alias("_real"))
    named = states.join(F.broadcast(real), "state_fips", "left")
    return named.withColumn("name", F.coalesce("_real", "name")).drop("_real")


def summary(url_lists: DataFrame) -> DataFrame:
    """One row: listed, completed and failed URLs; zeros when nothing is listed."""
    return url_lists.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("list_type") == "completed").alias("completed"),
        F.count_if(F.col("list_type") == "failed").alias("failed"),
    )


def pending(discovered: DataFrame, url_lists: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Discovered URLs in neither list.

    The lists are global: a URL ended under one state is ended for all.
    """
    if states is not None:
        discovered = discovered.where(F.col("state_fips").isin(*states))
    ended = url_lists.where(F.col("list_type").isin("completed", "failed")).select(
        "url", F.lit(True).alias("ended")
    ).distinct()
    # Spark would move an anti-join below the fold of the calls, where a URL still
    # has all its rows; an outer join stays above it.
    rows = discovered.join(ended, "url", "left").where("ended IS NULL")
    return rows.select("state_fips", "url")


def look_up(files: DataFrame, paths: DataFrame) -> DataFrame:
    """For each asked path: is it completed, and how many bytes of it are there?

    The size is 0 unless the path is partial now.
    """
    known = files.select("path", "status", "bytes_downloaded")
    part = F.when(F.col("status") == "partial", F.col("bytes_downloaded"))
    return paths.select("path").join(known, "path", "left").select(
        "path",
        F.coalesce(F.col("status") == "completed", F.lit(False)).alias("is_completed"),
        F.coalesce(part, F.lit(0).cast("bigint")).alias("partial_size"),
    )


def ended_urls(files: DataFrame, states: list[str] | None = None) -> DataFrame:
    """URLs of the files that are completed or failed now, with their state."""
    rows = files.where(F.col("status").isin("completed", "failed"))
    if states is not None:
        rows = rows.where(F.col("state_fips").isin(*states))
    return rows.select("state_fips", "status", "url")


def state_rows(states: DataFrame, state_fips: str | None = None) -> DataFrame:
    """All state rows in order, or one of them."""
    if state_fips:
        return states.where(F.col("state_fips") == state_fips)
    return states.orderBy("state_fips")


def requested_states(states: DataFrame) -> DataFrame:
    return states.select("state_fips").orderBy("state_fips")


def first_urls(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` URLs of each group as an array, in order.

    Spark cuts every group to ``k`` rows in each task before the shuffle.
    """
    ranked = rows.select(
        *keys, "url", F.row_number().over(W.partitionBy(*keys).orderBy("url")).alias("rank")
    )
    top = ranked.where(F.col("rank") <= k)
    return top.groupBy(*keys).agg(F.array_sort(F.collect_list("url")).alias("urls"))


def progress(states: DataFrame, files: DataFrame, pending_urls: DataFrame, k: int = 10) -> DataFrame:
    """Per state: discovered, files now completed and failed, pending, first pending URLs."""
    now = files.groupBy("state_fips").agg(
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    waiting = pending_urls.groupBy("state_fips").agg(F.count(F.lit(1)).alias("pending"))
    sample = first_urls(pending_urls, ["state_fips"], k).withColumnRenamed("urls", "pending_urls")
    rows = states.select("state_fips", "discovered")
    for part in (now, waiting, sample):
        rows = rows.join(part, "state_fips", "left")
    return rows.select(
        "state_fips", "discovered",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("completed", "failed", "pending")],
        F.coalesce("pending_urls", F.array().cast("array<string>")).alias("pending_urls"),
    )


def status_report(states: DataFrame, files: DataFrame, pending_urls: DataFrame, k: int = 3) -> DataFrame:
    """Per state: name, counters and up to ``k`` URLs of each kind, in state order."""
    kinds = ("completed", "failed", "pending")
    waiting = pending_urls.select("state_fips", F.lit("pending").alias("status"), "url")
    rows = ended_urls(files).unionByName(waiting)
    sample = first_urls(rows, ["state_fips", "status"], k)
    # At most k URLs per state and kind are left here.
    wide = sample.groupBy("state_fips").pivot("status", list(kinds)).agg(F.first("urls"))
    wide = wide.select("state_fips", *[F.col(kind).alias(f"{kind}_urls") for kind in kinds])
    none = F.array().cast("array<string>")
    return states.join(wide, "state_fips", "left").select(
        "state_fips", "name", "completed", "failed",
        (F.col("completed") + F.col("failed")).alias("total"),
        *[F.coalesce(f"{kind}_urls", none).alias(f"{kind}_urls") for kind in kinds],
    ).orderBy("state_fips")
