"""What to fetch, how it ended, and what is on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.functions import names
from centerline.operators.numbering import numbered

# The words, or the status as a number of its own.
NOT_FOUND = r"(?i)not found|(?<!\d)404(?!\d)"


def plan_urls(
    counties: DataFrame, year: int, datasets: list[str], root: str = ".", repeat: bool = False
) -> DataFrame:
    """Planned files for distinct ``(state_fips, county)``.

    Every county is expanded by the list of datasets.  A dataset without county
    files has one URL per state, so its rows come from the distinct states;
    ``repeat`` gives that URL once per county instead.
    """
    by_county = [d for d in datasets if repeat or d in names.COUNTY_FILES]
    by_state = [d for d in datasets if d not in by_county]
    rows = None
    for base, wanted in (
        (counties.select("state_fips", "county"), by_county),
        (counties.select("state_fips").distinct().withColumn("county", F.lit(None).cast("string")), by_state),
    ):
        if wanted:
            part = base.withColumn("dataset", F.explode(F.array(*map(F.lit, wanted))))
            rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise ValueError("no dataset to plan for")
    url = names.file_url(F.lit(year), F.col("state_fips"), F.col("county"), F.col("dataset"))
    planned = rows.withColumn("url", url)
    return planned.withColumn("path", names.target_path(root, F.col("state_fips"), F.col("url")))


def worklist(planned: DataFrame, discovered: DataFrame, pending: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Planned files whose URL is waiting for its state.

    ``retry_failed`` keeps everything discovered, not only what is pending.  With
    nothing discovered nothing is planned.
    """
    wanted = (discovered if retry_failed else pending).select("state_fips", "url")
    return planned.join(wanted, ["state_fips", "url"], "left_semi")


def outcome_counts(marks: DataFrame, not_found_from_error: bool = True) -> DataFrame:
    """Fetches per state that succeeded, failed or found nothing, and their sum.

    The sum is the row of ``level`` 1.  "Not found" is told from the words or the
    status number in the stored error text; without that it counts as failed.
    """
    absent = F.coalesce(F.col("error").rlike(NOT_FOUND), F.lit(False)) & F.lit(not_found_from_error)
    failed = F.col("kind") == "failed"
    ended = marks.where(F.col("kind").isin("completed", "failed"))
    levels = ended.groupingSets([["state_fips"], []], "state_fips")
    return levels.agg(
        F.grouping("state_fips").cast("int").alias("level"),
        F.count_if(F.col("kind") == "completed").alias("successful"),
        F.count_if(failed & ~absent).alias("failed"),
        F.count_if(failed & absent).alias("not_found"),
    )


def reconcile(
    discovered: DataFrame, files: DataFrame, listing: DataFrame, root: str, recorded_paths: bool = False
) -> DataFrame:
    """Differences between the manifest and a listing ``(path, length)``.

    updated: a discovered URL whose file is there but not marked completed, with
    its size, once per file.  missing: a completed file that is not there.
    ``discovered`` is the pending or the full set, as wanted; ``recorded_paths``
    looks for completed files where they were recorded instead of below ``root``.
    All inputs meet once, by path, and every input is read once.
    """
    expected = names.target_path(root, F.col("state_fips"), F.col("url"))
    nothing = F.lit(None)
    place = {"text": nothing.cast("string"), "size": nothing.cast("bigint")}

    def rows(df: DataFrame, kind: str, path: Column, known: bool, size: Column = place["size"]) -> DataFrame:
        state, url = (F.col(c) if known else place["text"] for c in ("state_fips", "url"))
        return df.select(path.alias("path"), F.lit(kind).alias("kind"), state.alias("state_fips"), url.alias("url"), size.alias("size"))

    # A completed file stands where it was recorded, and is sought there or below the root.
    sought = F.col("path") if recorded_paths else expected
    done = files.where("status = 'completed'").select("state_fips", "url", F.explode(F.array(
        F.struct(F.lit("done").alias("kind"), F.col("path").alias("path")),
        F.struct(F.lit("sought").alias("kind"), sought.alias("path")),
    )).alias("at")).select("at.path", "at.kind", "state_fips", "url", place["size"].alias("size"))
    together = rows(discovered, "wanted", expected, True).unionAll(done).unionAll(
        rows(listing, "there", F.col("path"), False, F.col("length"))
    )

    def has(kind: str) -> Column:
        return F.bool_or(F.col("kind") == kind)

    def of(kind: str, column: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(column))

    by_path = together.groupBy("path").agg(
        has("there").alias("there"), has("done").alias("done"), has("wanted").alias("wanted"),
        F.max(of("there", "size")).alias("size"), F.min(of("wanted", "state_fips")).alias("state_fips"),
        F.min(of("wanted", "url")).alias("url"),
        F.collect_list(F.when(F.col("kind") == "sought", F.struct("state_fips", "url"))).alias("sought"),
    )
    kind = "struct<outcome:string,state_fips:string,url:string,size:bigint>"
    updated = F.when(
        F.col("wanted") & F.col("there") & ~F.col("done"),
        F.array(F.struct(F.lit("updated").alias("outcome"), "state_fips", "url", "size")),
    ).otherwise(F.array().cast(f"array<{kind}>"))
    missing = F.when(~F.col("there"), F.transform("sought", lambda s: F.struct(
        F.lit("missing").alias("outcome"), s["state_fips"].alias("state_fips"), s["url"].alias("url"),
        place["size"].alias("size"),
    ))).otherwise(F.array().cast(f"array<{kind}>"))
    return by_path.select("path", F.explode(F.concat(updated, missing)).alias("d")).select(
        "d.outcome", "path", "d.state_fips", "d.url", "d.size"
    )


def reconcile_counts(differences: DataFrame) -> DataFrame:
    return differences.agg(
        F.count_if(F.col("outcome") == "updated").alias("updated"),
        F.count_if(F.col("outcome") == "missing").alias("missing"),
    )


def reconcile_marks(differences: DataFrame, first_seq: int, ts: float) -> DataFrame:
    """Completed marks for the updated files, to append to the events.

    Numbers follow each other from ``first_seq`` on, in the order of the paths, so
    the next event may take the number after the last.
    """
    marks = numbered(differences.where("outcome = 'updated'"), ["path", "url"])
    return marks.select(
        (F.col("number") + F.lit(first_seq)).alias("seq"),
        F.lit(float(ts)).alias("ts"),
        F.lit("completed").alias("kind"),
        "url", "path", "state_fips", "size",
        F.lit(None).cast("bigint").alias("bytes_downloaded"),
        F.lit(None).cast("string").alias("error"),
    )
