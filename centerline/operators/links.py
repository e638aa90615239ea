"""Links grouped by dataset and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.functions import names


def _matching_states(area: Column, states: list[str]) -> Column:
    """Requested codes the area starts with.

    Instead of a prefix join, the area is cut to each code length that occurs and
    the cuts are tested for membership, so every link is looked at once.
    """
    cuts = F.array(*[F.substring(area, 1, n) for n in sorted({len(s) for s in states})])
    return F.array_distinct(F.filter(cuts, lambda c: c.isin(*states)))


def state_links(links: DataFrame, year: int | str | Column, states: list[str]) -> DataFrame:
    """Distinct ``(dataset, state_fips, url)`` of links ``(dataset, directory, href)``.

    A link belongs to every requested code its area starts with.
    """
    matched = links.where(names.year_link(F.col("href"), year)).select(
        "dataset",
        F.explode(_matching_states(names.link_area(F.col("href")), states)).alias("state_fips"),
        names.absolute_link(F.col("directory"), F.col("href")).alias("url"),
    )
    return matched.distinct()


def link_counts(grouped: DataFrame) -> DataFrame:
    """Distinct links per dataset and state, per state, and the sum over states.

    ``level`` is 0 for a dataset of a state, 1 for a state over its datasets and
    2 for the sum.  Each URL of a state is one row with its datasets, which counts once
    for each of them and once for the state; so the links are built and moved once.
    """
    none = F.lit(None).cast("string")
    by_url = grouped.groupBy("state_fips", "url").agg(F.collect_set("dataset").alias("datasets"))
    of = F.transform("datasets", lambda d: F.struct(F.lit(0).alias("level"), d.alias("dataset")))
    state = F.array(F.struct(F.lit(1).alias("level"), none.alias("dataset")))
    counts = by_url.select("state_fips", F.inline(F.concat(of, state))).groupBy("level", "dataset", "state_fips").agg(
        F.count(F.lit(1)).alias("n")
    )
    # A row per state and dataset is left; that of a state goes into the sum too.
    itself = F.struct("level", "dataset", "state_fips", "n")
    summed = F.struct(F.lit(2).alias("level"), none.alias("dataset"), none.alias("state_fips"), "n")
    rows = counts.select(F.inline(F.when(F.col("level") == 1, F.array(itself, summed)).otherwise(F.array(itself))))
    return rows.groupBy("dataset", "state_fips", "level").agg(F.sum("n").alias("n_links"))


def discovered_by_state(grouped: DataFrame) -> DataFrame:
    """Union of the datasets: distinct ``(state_fips, url)``."""
    return grouped.select("state_fips", "url").distinct()


def counties(links: DataFrame, year: int | str | Column, states: list[str]) -> DataFrame:
    """Distinct county codes per requested state, in order."""
    area = names.link_area(F.col("href"))
    states_of = _matching_states(area, states)
    rows = links.where(names.year_link(F.col("href"), year)).select(
        F.explode(states_of).alias("state_fips"), area.alias("area")
    )
    found = rows.select("state_fips", names.county_of(F.col("area"), F.col("state_fips")).alias("county"))
    return found.where("county IS NOT NULL").distinct().orderBy("state_fips", "county")
