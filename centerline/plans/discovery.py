"""Discovery and planning, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centerline.functions import names
from centerline.operators import links, worklist
from centerline.sources import pages


def listing_links(listings: DataFrame, year: int) -> DataFrame:
    """Links ``(dataset, directory, href)`` of stored listings ``(dataset, html)``."""
    found = pages.page_links(listings, ["dataset"], pages_unique=False)
    return found.withColumn("directory", names.directory_url(F.lit(year), F.col("dataset")))


def discover(listings: DataFrame, year: int, states: list[str]) -> DataFrame:
    """Distinct ``(dataset, state_fips, url)``, all states in one pass."""
    return links.state_links(listing_links(listings, year), year, states)


def discover_calls(found: DataFrame, states: list[str], first_seq: int, ts: float) -> DataFrame:
    """Events of one discovery round: a call per requested state.

    Calls are numbered in the order of the requested states; a state without links
    has one row with a NULL URL.
    """
    numbered = found.sparkSession.createDataFrame(
        [(first_seq + i, s) for i, s in enumerate(states)], "seq bigint, state_fips string"
    )
    urls = links.discovered_by_state(found)
    # The request names at most the 56 known codes.
    return urls.join(F.broadcast(numbered), "state_fips").select(
        "seq", F.lit(ts).alias("ts"), "state_fips", "url"
    ).unionByName(
        numbered.join(urls.select("state_fips").distinct(), "state_fips", "left_anti").select(
            "seq", F.lit(ts).alias("ts"), "state_fips", F.lit(None).cast("string").alias("url")
        )
    )


def plan_downloads(
    listings: DataFrame, year: int, states: list[str], datasets: list[str], root: str,
    discovered: DataFrame, pending: DataFrame, retry_failed: bool = False,
) -> DataFrame:
    """Files to fetch now: counties of the first dataset, expanded, then filtered."""
    first = listings.where(F.col("dataset") == (datasets[0] if datasets else "EDGES"))
    found = links.counties(listing_links(first, year), year, states)
    planned = worklist.plan_urls(found, year, datasets, root)
    return worklist.worklist(planned, discovered, pending, retry_failed)
