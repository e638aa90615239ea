"""Column expressions over file names, paths and links.

Digits and word characters are ASCII here, as they are in published file names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published address of the yearly folders and the name patterns.
BASE_URL = "https://www2.census.gov/geo/tiger/TIGER"
NAME_PREFIX = r"^tl_\d{4}_\d{5}"
STATE_IN_NAME = r"tl_\d{4}_(0?%s)[0-9]{3}_"

# Which datasets have one file per county or one national file.
# All others have one file per state.
COUNTY_FILES = ("EDGES", "ADDR", "FACES", "FEATNAMES")
NATIONAL_FILES = ("STATE",)

# The layouts, with the parts of a name that make up the folders.
LAYOUTS = {
    "year_statecounty": (r"tl_(\d{4})_(\d{5})", "$2/$3/$1"),
    "year_state_type": (r"tl_(\d{4})_(\d{2})\d{3}_(\w+)", "$2/$3/$4/$1"),
    "year_type": (r"tl_(\d{4})_\d{5}_(\w+)", "$2/$3/$1"),
}


def base_name(path: Column) -> Column:
    """Last part of a path or URL."""
    return F.substring_index(path, "/", -1)


def file_stem(name: Column) -> Column:
    """File name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")


def table_name(path: Column, lower: bool = False) -> Column:
    """Name of the table loaded from a file."""
    stem = file_stem(base_name(path))
    return F.lower(stem) if lower else stem


def parse_name(stem: Column) -> Column:
    """Year, state, county and feature held by a file stem; NULL without a match.

    Anchored at the start only.  The first three groups have fixed widths, so a
    single match decides them and they are cut by position.
    """
    # The first of all matches is NULL where there is none, in one pass.
    feature = F.get(F.regexp_extract_all(stem, F.lit(NAME_PREFIX + r"_(\w+)"), F.lit(1)), F.lit(0))
    return F.when(
        stem.rlike(NAME_PREFIX),
        F.struct(
            F.substring(stem, 4, 4).alias("year"),
            F.substring(stem, 9, 2).alias("state"),
            F.substring(stem, 11, 3).alias("county"),
            feature.alias("feature"),
        ),
    )


def in_state(name: Column, state: str) -> Column:
    """Does the name carry this state followed by a county?  Not anchored."""
    return name.rlike(STATE_IN_NAME % re.escape(state))


def of_dataset(name: Column, dataset: str) -> Column:
    """Case-sensitive substring test, so ``addr`` also accepts ``addrfeat``."""
    return name.contains(dataset)


def table_of_type(name: Column, table_type: str) -> Column:
    """Catalog name test; each underscore is a one-character wildcard."""
    return name.like(f"tl_%_{table_type}")


def year_link(link: Column, year: int | str | Column) -> Column:
    """Is this link a file of the given year?"""
    parts = F.split(link, "_")
    year = year if isinstance(year, Column) else F.lit(str(year))
    return (F.size(parts) >= 3) & (parts[0] == "tl") & (parts[1] == year)


def link_area(link: Column) -> Column:
    """Third part of a link: the state, or the state and the county."""
    return F.get(F.split(link, "_"), F.lit(2))


def county_of(area: Column, state: str | Column) -> Column:
    """County code when the area is exactly this state and a county, else NULL."""
    state = state if isinstance(state, Column) else F.lit(state)
    code = F.substring(area, 3, 3)
    ok = area.startswith(state) & (F.length(area) == 5) & code.rlike("^[0-9]{3}$")
    return F.when(ok, code)


def directory_url(year: Column, dataset: Column) -> Column:
    """Folder of one dataset of one year."""
    return F.concat(F.lit(BASE_URL), year.cast("string"), F.lit("/"), dataset, F.lit("/"))


def absolute_link(directory: Column, link: Column) -> Column:
    return F.concat(directory, link)


def file_url(year: Column, state: Column, county: Column, dataset: Column) -> Column:
    """URL of a file; the level of the dataset is looked up case-sensitively."""
    area = (
        F.when(dataset.isin(*COUNTY_FILES), F.concat(state, county))
        .when(dataset.isin(*NATIONAL_FILES), F.lit("us"))
        .otherwise(state)
    )
    year = year.cast("string")
    return F.concat(
        directory_url(year, F.upper(dataset)),
        F.concat_ws("_", F.lit("tl"), year, area, F.lower(dataset)),
        F.lit(".zip"),
    )


def target_path(root: str | Column, state: Column, url: Column) -> Column:
    """Where a fetched file is kept: root, state, file name."""
    root = root if isinstance(root, Column) else F.lit(root)
    return F.concat_ws("/", root, state, base_name(url))


def default_state_name(state: Column) -> Column:
    return F.concat(F.lit("State "), state)


def directory_parts(path: Column) -> Column:
    """Year, state, county and type given by the folders of a relative path.

    The file name counts as a part.  NULL unless the path starts with a
    four-digit and a two-digit part.
    """
    parts = F.split(path, "/")
    part = [F.get(parts, F.lit(i)) for i in range(4)]
    return F.when(
        part[0].rlike("^[0-9]{4}$") & part[1].rlike("^[0-9]{2}$"),
        F.struct(
            part[0].alias("year"),
            part[1].alias("state"),
            F.when(part[2].rlike("^[0-9]{3,5}$"), part[2]).alias("county"),
            part[3].alias("type"),
        ),
    )


def layout_path(layout: str, path: Column) -> Column:
    """New relative path under a layout; unchanged when a needed part is missing.

    One replacement on the whole path: the file name is its first group, and a
    name that does not match leaves the path as it is.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; one of {', '.join(LAYOUTS)}")
    pattern, target = LAYOUTS[layout]
    return F.regexp_replace(path, rf"^(?:.*/)?({pattern}[^/]*)$", target)
