"""Declared table schemas."""

from __future__ import annotations

# Consolidated tables.
EDGES = (
    "statefp string, countyfp string, tlid bigint, fullname string, lfromadd string, "
    "ltoadd string, rfromadd string, rtoadd string, zipl string, zipr string, geometry binary"
)
FEATNAMES = (
    "tlid bigint, fullname string, name string, predirabrv string, pretypabrv string, "
    "suftypabrv string, sufdirabrv string"
)
ADDR = "tlid bigint, fromhn string, tohn string, side string, zip string, plus4 string"

CONSOLIDATED = {"edges": EDGES, "featnames": FEATNAMES, "addr": ADDR}

# Star schema of an address database.
STAR = {
    "place": (
        "zip string, city string, state string, city_phone string, lat decimal(9,6), "
        "lon decimal(9,6), status string, fips_class string, fips_place string, "
        "fips_county string, priority string"
    ),
    "edge": "tlid bigint, geometry binary",
    "feature": "fid bigint, street string, street_phone string, paflag boolean, zip string",
    "feature_edge": "fid bigint, tlid bigint",
    "range": "tlid bigint, fromhn bigint, tohn bigint, prenum string, zip string, side string",
}

# Manifest tables.
FILES = (
    "path string, url string, status string, state_fips string, size bigint, "
    "bytes_downloaded bigint, error string, timestamp double"
)
STATES = (
    "state_fips string, name string, completed bigint, failed bigint, discovered bigint, "
    "last_updated double"
)
DISCOVERED = "state_fips string, url string, discovered_at double"
URL_LISTS = "url string, list_type string, added_at double"

# What the manifest is derived from: append-only events in call order.
MARK_EVENTS = (
    "seq bigint, ts double, kind string, url string, path string, state_fips string, "
    "size bigint, bytes_downloaded bigint, error string"
)
DISCOVER_CALLS = "seq bigint, ts double, state_fips string, url string"
