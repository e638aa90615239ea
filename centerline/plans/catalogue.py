"""The registered queries: every operator over whole tables.

``QUERIES`` maps a name to a function of the session and the data folder,
``ORACLES`` the same name to SQL for the checking engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from centerline.functions import geometry, names
from centerline.operators import consolidate as con
from centerline.operators import inventory, layout, links, manifest, requests, worklist
from centerline.plans import inputs, roundtrip
from centerline.plans.inputs import (
    FX_CALLS, FX_COUNTIES, FX_FILES, FX_LINKS, FX_LISTING, FX_MARKS, code, table,
)
from centerline.session import scratch_dir
from centerline.sources import archive_tables, catalog, dbf, dims, files, manifest_json, pages, shapefile
from centerline.streaming import manifest_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = oracle
        return function

    return register


def _joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def _scratch_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """Name and folder of a table that lies in the shared folder."""
    path = scratch_dir(spark, label)
    return path.rsplit("/", 1)[-1].replace("-", "_"), path


# File names ---------------------------------------------------------------

_NAME = r"regexp_extract(stem, '^tl_(\d{4})_(\d{2})(\d{3})(?:_(\w+))?', %d)"
_STEM = r"regexp_replace(name, '^(.+)\.[^.]+$', '\1')"


@query("name_parse", "WITH " + FX_FILES + f""",
p AS (
  SELECT *, regexp_matches(stem, '^tl_[0-9]{{4}}_[0-9]{{5}}') AS ok, string_split(path, '/') AS d
  FROM (SELECT *, {_STEM} AS stem FROM fx_files)
),
q AS (
  SELECT *, NOT ok AND regexp_matches(d[1], '^[0-9]{{4}}$') AND len(d) >= 2
    AND coalesce(regexp_matches(d[2], '^[0-9]{{2}}$'), false) AS by_dir FROM p
)
SELECT file_id, path,
  CASE WHEN ok THEN {_NAME % 1} WHEN by_dir THEN d[1] END AS year,
  CASE WHEN ok THEN {_NAME % 2} WHEN by_dir THEN d[2] END AS state,
  CASE WHEN ok THEN {_NAME % 3} WHEN by_dir AND regexp_matches(d[3], '^[0-9]{{3,5}}$') THEN d[3] END AS county,
  CASE WHEN ok THEN nullif({_NAME % 4}, '') END AS feature,
  CASE WHEN by_dir AND len(d) >= 4 THEN d[4] END AS type,
  ok AS valid, ok AS filename_valid
FROM q""")
def name_parse(spark, sf):
    return inventory.describe_files(inputs.fx_files(spark, sf).select("file_id", "path"))


@query("inventory_counts", "WITH " + FX_FILES + f""",
p AS (
  SELECT CASE WHEN ok THEN {_NAME % 1} WHEN by_dir THEN d[1] END AS year,
    CASE WHEN ok THEN {_NAME % 2} WHEN by_dir THEN d[2] END AS state,
    CASE WHEN ok THEN nullif({_NAME % 4}, '') END AS feature
  FROM (
    SELECT *, NOT ok AND regexp_matches(d[1], '^[0-9]{{4}}$') AND len(d) >= 2
      AND coalesce(regexp_matches(d[2], '^[0-9]{{2}}$'), false) AS by_dir
    FROM (SELECT *, regexp_matches(stem, '^tl_[0-9]{{4}}_[0-9]{{5}}') AS ok, string_split(path, '/') AS d
      FROM (SELECT *, {_STEM} AS stem FROM fx_files))
  )
)
SELECT year, state, feature, 0 AS level, count(*) AS n_files FROM p GROUP BY year, state, feature
UNION ALL SELECT NULL, NULL, NULL, 1, count(*) FROM p""")
def inventory_counts(spark, sf):
    return inventory.count_files(inventory.describe_files(inputs.fx_files(spark, sf).select("path")))


@query("state_filter", "WITH " + FX_FILES + r"""
SELECT file_id, name, regexp_matches(name, 'tl_\d{4}_(0?13)[0-9]{3}_') AS in_13,
  regexp_matches(name, 'tl_\d{4}_(0?6)[0-9]{3}_') AS in_6 FROM fx_files""")
def state_filter(spark, sf):
    name = F.col("name")
    return inputs.fx_files(spark, sf).select(
        "file_id", "name", names.in_state(name, "13").alias("in_13"), names.in_state(name, "6").alias("in_6")
    )


@query("type_filter", "WITH " + FX_FILES + f"""
SELECT file_id, table_name, lower(table_name) AS lower_name,
  contains(name, 'addr') AS has_addr, contains(name, 'ADDR') AS has_upper,
  table_name LIKE 'tl_%_addr' AS addr_table, table_name LIKE 'tl_%_edges' AS edges_table
FROM (SELECT *, {_STEM} AS table_name FROM fx_files)""")
def type_filter(spark, sf):
    name, stem = F.col("name"), F.col("table_name")
    found = inputs.fx_files(spark, sf).withColumn("table_name", names.table_name(F.col("path")))
    return found.select(
        "file_id", "table_name", F.lower("table_name").alias("lower_name"),
        names.of_dataset(name, "addr").alias("has_addr"),
        names.of_dataset(name, "ADDR").alias("has_upper"),
        names.table_of_type(stem, "addr").alias("addr_table"),
        names.table_of_type(stem, "edges").alias("edges_table"),
    )


def _layout_sql(new_path: str, needs: str) -> str:
    return "WITH " + FX_FILES + f""",
p AS (
  SELECT path AS src, CASE WHEN {needs} THEN {new_path} ELSE path END AS dst
  FROM (SELECT *, {_NAME % 1} AS y, {_NAME % 2} AS s, {_NAME % 3} AS c, {_NAME % 4} AS f,
      regexp_matches(stem, '^tl_[0-9]{{4}}_[0-9]{{5}}') AS ok
    FROM (SELECT *, {_STEM} AS stem FROM fx_files))
)
SELECT src, dst, n AS n_sources FROM p JOIN (SELECT dst, count(*) AS n FROM p GROUP BY dst) USING (dst)
WHERE src <> dst"""


_LAYOUT_SQL = {
    "year_statecounty": _layout_sql("y || '/' || s || c || '/' || name", "ok"),
    "year_state_type": _layout_sql("y || '/' || s || '/' || f || '/' || name", "ok AND f <> ''"),
    "year_type": _layout_sql("y || '/' || f || '/' || name", "ok AND f <> ''"),
}


def _layout_query(kind: str) -> Query:
    return lambda spark, sf: inventory.plan_layout(inputs.fx_files(spark, sf), kind)


for _kind, _sql in _LAYOUT_SQL.items():
    query(f"layout_plan_{_kind}", _sql)(_layout_query(_kind))


@query("layout_collisions", "WITH " + FX_FILES + f""",
copies AS (
  SELECT name, path AS src FROM fx_files
  UNION ALL SELECT name, 'old/' || path FROM fx_files WHERE name LIKE '%.zip'
),
p AS (
  SELECT src, CASE WHEN f <> '' THEN {_NAME % 1} || '/' || f || '/' || name ELSE src END AS dst
  FROM (SELECT *, {_NAME % 4} AS f FROM (SELECT *, {_STEM} AS stem FROM copies))
)
SELECT dst, count(*) AS n_sources, min(src) FILTER (WHERE src <> dst) AS first_src
FROM p GROUP BY dst HAVING count(*) > 1 AND count(*) FILTER (WHERE src <> dst) > 0""")
def layout_collisions(spark, sf):
    found = inputs.fx_files(spark, sf).select("path")
    copies = found.where(F.col("path").endswith(".zip")).select(F.concat(F.lit("old/"), "path").alias("path"))
    return inventory.layout_collisions(inventory.plan_layout(found.unionAll(copies), "year_type"))


@query("standalone_dbf", "WITH " + FX_FILES + f""",
s AS (SELECT *, {_STEM} AS stem FROM fx_files)
SELECT file_id, name, stem FROM s
WHERE name LIKE '%.dbf' AND stem NOT IN (SELECT stem FROM s WHERE name LIKE '%.shp')""")
def standalone_dbf(spark, sf):
    rows = inputs.fx_files(spark, sf).select("file_id", "name", "path")
    return inventory.standalone_dbf(rows).select("file_id", "name", "stem")


# URLs, links and requests ---------------------------------------------------

_DATASETS = ", ".join(f"('{d}')" for d in dims.DATASETS)
_BASE = f"{names.BASE_URL}2025/"
_URL = f"""'{_BASE}' || upper(dataset) || '/tl_2025_' ||
  CASE WHEN dataset IN ('EDGES', 'ADDR', 'FACES', 'FEATNAMES') THEN state_fips || county
    WHEN dataset = 'STATE' THEN 'us' ELSE state_fips END || '_' || lower(dataset) || '.zip'"""


@query("url_build", "WITH " + FX_COUNTIES + f"""
SELECT dataset, state_fips, county, url, 'out/' || state_fips || '/' || regexp_extract(url, '[^/]+$') AS path
FROM (SELECT *, {_URL} AS url
  FROM fx_counties, (VALUES {_DATASETS}, ('edges')) d(dataset))""")
def url_build(spark, sf):
    wanted = [*dims.DATASETS, "edges"]
    return worklist.plan_urls(inputs.fx_counties(spark, sf), 2025, wanted, "out", repeat=True)


@query("url_plan", "WITH " + FX_COUNTIES + f"""
SELECT dataset, state_fips, county, url FROM (
  SELECT *, {_URL} AS url FROM (
    SELECT * FROM fx_counties, (VALUES ('EDGES'), ('ADDR'), ('FACES'), ('FEATNAMES')) d(dataset)
    UNION ALL
    SELECT state_fips, NULL, dataset FROM (SELECT DISTINCT state_fips FROM fx_counties),
      (VALUES {_DATASETS}) d(dataset)
    WHERE dataset NOT IN ('EDGES', 'ADDR', 'FACES', 'FEATNAMES')))""")
def url_plan(spark, sf):
    planned = worklist.plan_urls(inputs.fx_counties(spark, sf), 2025, list(dims.DATASETS))
    return planned.select("dataset", "state_fips", "county", "url")


# Anchors of these pages have one attribute, in double quotes.
_LINKS_SQL = """
SELECT DISTINCT page_id, href, url || href AS absolute FROM (
  SELECT page_id, url, replace(split_part(piece, '"', 1), '&amp;', '&') AS href
  FROM (SELECT page_id, url, unnest(string_split(html, '<a href="')[2:]) AS piece FROM pages))
WHERE href <> '' AND href NOT LIKE '../%'"""


@query("link_extract", _LINKS_SQL)
def link_extract(spark, sf):
    found = pages.page_links(table(spark, sf, "pages"), ["page_id", "url"])
    absolute = names.absolute_link(F.col("url"), F.col("href"))
    return found.select("page_id", "href", absolute.alias("absolute"))


_STATE_LIST = ", ".join(f"'{c}'" for c in dims.default_states(True))
_STATE_LINKS = FX_LINKS + f""",
state_links AS (
  SELECT DISTINCT dataset, substr(split_part(href, '_', 3), 1, 2) AS state_fips, directory || href AS url
  FROM fx_links
  WHERE split_part(href, '_', 1) = 'tl' AND split_part(href, '_', 2) = year
    AND substr(split_part(href, '_', 3), 1, 2) IN ({_STATE_LIST})
)"""


def _state_links(spark, sf):
    found = inputs.fx_links(spark, sf)
    return links.state_links(found, F.col("year"), dims.default_states(True))


@query("links_by_state", "WITH " + _STATE_LINKS + " SELECT * FROM state_links")
def links_by_state(spark, sf):
    return _state_links(spark, sf)


@query("link_counts", "WITH " + _STATE_LINKS + """
SELECT dataset, state_fips, 0 AS level, count(DISTINCT url) AS n_links FROM state_links GROUP BY 1, 2
UNION ALL
SELECT NULL, state_fips, 1, count(DISTINCT url) FROM state_links GROUP BY 2
UNION ALL
SELECT NULL, NULL, 2, CAST(sum(n) AS BIGINT)
FROM (SELECT count(DISTINCT url) AS n FROM state_links GROUP BY state_fips)""")
def link_counts(spark, sf):
    return links.link_counts(_state_links(spark, sf))


@query("discovered_by_state", "WITH " + _STATE_LINKS + " SELECT DISTINCT state_fips, url FROM state_links")
def discovered_by_state(spark, sf):
    return links.discovered_by_state(_state_links(spark, sf))


@query("county_list", "WITH " + FX_LINKS + f"""
SELECT DISTINCT substr(area, 1, 2) AS state_fips, substr(area, 3) AS county
FROM (SELECT split_part(href, '_', 3) AS area FROM fx_links
  WHERE split_part(href, '_', 1) = 'tl' AND split_part(href, '_', 2) = year)
WHERE length(area) = 5 AND substr(area, 1, 2) IN ({_STATE_LIST})
  AND regexp_matches(substr(area, 3), '^[0-9]{{3}}$')""")
def county_list(spark, sf):
    return links.counties(inputs.fx_links(spark, sf), F.col("year"), dims.default_states(True))


_REQUESTS = """
requests AS (
  SELECT c_custkey AS request_id,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN ''
      ELSE CAST(c_nationkey AS VARCHAR) || ', ' || CAST(c_custkey % 57 AS VARCHAR) END AS states,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
      ELSE 'Edges , ' || CASE WHEN c_nationkey % 2 = 0 THEN 'addr' ELSE 'roads' END END AS datasets
  FROM customer
)"""


def _requests(spark, sf):
    unnamed = F.col("c_mktsegment") == "MACHINERY"
    second = F.when(F.col("c_nationkey") % 2 == 0, "addr").otherwise("roads")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"),
        F.when(unnamed, "").otherwise(F.concat_ws(", ", "c_nationkey", F.col("c_custkey") % 57)).alias("states"),
        F.when(~unnamed, F.concat(F.lit("Edges , "), second)).alias("datasets"),
    )


def _request_sql(text: str, key: str, clean: str, known: list[str], defaults: list[str]) -> str:
    known_list, default_list = (", ".join(f"'{v}'" for v in vs) for vs in (known, defaults))
    return "WITH " + _REQUESTS + f""",
items AS (
  SELECT request_id, coalesce({text}, '') = '' AS unnamed,
    CASE WHEN coalesce({text}, '') = '' THEN [{default_list}] ELSE string_split({text}, ',') END AS list
  FROM requests
),
checked AS (
  SELECT request_id, position, {key}, {key} IN ({known_list}) AS known FROM (
    SELECT request_id, i - 1 AS position, CASE WHEN unnamed THEN list[i] ELSE {clean} END AS {key}
    FROM (SELECT *, unnest(range(1, len(list) + 1)) AS i FROM items))
)
"""


_PAD = "CASE WHEN length(trim(list[i])) < 2 THEN lpad(trim(list[i]), 2, '0') ELSE trim(list[i]) END"
_CHECK_STATES = _request_sql(
    "states", "state_fips", _PAD, dims.default_states(True), dims.default_states()
)
_CHECK_DATASETS = _request_sql(
    "datasets", "dataset", "upper(trim(list[i]))", list(dims.DATASETS), dims.DEFAULT_DATASETS
)


@query("validate_states", _CHECK_STATES + "SELECT * FROM checked")
def validate_states(spark, sf):
    return requests.check_states(_requests(spark, sf))


@query("validate_datasets", _CHECK_DATASETS + "SELECT * FROM checked")
def validate_datasets(spark, sf):
    return requests.check_datasets(_requests(spark, sf))


@query("accepted_states", _CHECK_STATES + """
SELECT request_id, position, state_fips FROM checked
WHERE request_id NOT IN (SELECT request_id FROM checked WHERE NOT known)""")
def accepted_states(spark, sf):
    return requests.accepted(requests.check_states(_requests(spark, sf)))


@query("refused_datasets", _CHECK_DATASETS + "SELECT request_id, position, dataset FROM checked WHERE NOT known")
def refused_datasets(spark, sf):
    return requests.request_errors(requests.check_datasets(_requests(spark, sf)))


# Manifest -------------------------------------------------------------------

_FILES = FX_MARKS + """,
files AS (
  SELECT path, arg_max(url, seq) AS url, arg_max(kind, seq) AS status, arg_max(state_fips, seq) AS state_fips,
    arg_max(size, seq) FILTER (WHERE kind = 'completed') AS size,
    arg_max(bytes_downloaded, seq) FILTER (WHERE kind = 'partial' AND seq > lc) AS bytes_downloaded,
    arg_max(error, seq) FILTER (WHERE kind = 'failed' AND seq > lc) AS error,
    arg_max(ts, seq) AS timestamp
  FROM (SELECT *, coalesce(max(CASE WHEN kind = 'completed' THEN seq END) OVER (PARTITION BY path), -1) AS lc
    FROM fx_marks)
  GROUP BY path
)"""
_LISTS = """
url_lists AS (
  SELECT url, arg_max(kind, seq) AS list_type, arg_max(ts, seq) AS added_at
  FROM fx_marks WHERE kind IN ('completed', 'failed') GROUP BY url
)"""
_DISCOVERED = FX_CALLS + """,
discovered AS (SELECT state_fips, url, arg_min(ts, seq) AS discovered_at FROM fx_calls GROUP BY 1, 2)"""
_LAST_CALLS = """
last_calls AS (
  SELECT state_fips, url, arg_min(ts, seq) AS discovered_at
  FROM fx_calls JOIN (SELECT state_fips, max(seq) AS seq FROM fx_calls GROUP BY 1) USING (state_fips, seq)
  GROUP BY 1, 2
)"""
_STATES = """
states AS (
  SELECT state_fips, 'State ' || state_fips AS name, CAST(sum(c) AS BIGINT) AS completed,
    CAST(sum(f) AS BIGINT) AS failed, CAST(sum(d) AS BIGINT) AS discovered,
    coalesce(max(moved), min(created)) AS last_updated
  FROM (
    SELECT state_fips, count(*) FILTER (WHERE kind = 'completed') AS c,
      count(*) FILTER (WHERE kind = 'failed') AS f, 0 AS d,
      max(ts) FILTER (WHERE kind <> 'partial') AS moved, min(ts) AS created
    FROM fx_marks WHERE state_fips <> '' GROUP BY 1
    UNION ALL
    SELECT state_fips, 0, 0, arg_max(n, seq), max(ts), min(ts)
    FROM (SELECT state_fips, seq, count(DISTINCT url) AS n, max(ts) AS ts FROM fx_calls GROUP BY 1, 2)
    GROUP BY 1
  ) GROUP BY state_fips
)"""
_PENDING = """
pending AS (SELECT state_fips, url FROM discovered WHERE url NOT IN (SELECT url FROM url_lists))"""
_ALL = ",".join([_FILES, _LISTS, _DISCOVERED, _STATES, _PENDING])


def _files(spark, sf):
    return manifest.fold_files(inputs.fx_marks(spark, sf))


def _lists(spark, sf):
    return manifest.fold_url_lists(inputs.fx_marks(spark, sf))


def _discovered(spark, sf):
    return manifest.fold_discovered(inputs.fx_calls(spark, sf))


def _states(spark, sf):
    return manifest.fold_states(inputs.fx_marks(spark, sf), inputs.fx_calls(spark, sf))


def _pending(spark, sf):
    return manifest.pending(_discovered(spark, sf), _lists(spark, sf))


@query("manifest_files", "WITH " + _FILES + " SELECT * FROM files")
def manifest_files(spark, sf):
    return _files(spark, sf)


@query("manifest_files_replace", "WITH " + FX_MARKS + """
SELECT path, arg_max(url, seq) AS url, arg_max(kind, seq) AS status, arg_max(state_fips, seq) AS state_fips,
  CASE WHEN arg_max(kind, seq) = 'completed' THEN arg_max(size, seq) END AS size,
  CASE WHEN arg_max(kind, seq) = 'partial' THEN arg_max(bytes_downloaded, seq) END AS bytes_downloaded,
  CASE WHEN arg_max(kind, seq) = 'failed' THEN arg_max(error, seq) END AS error,
  arg_max(ts, seq) AS timestamp
FROM fx_marks GROUP BY path""")
def manifest_files_replace(spark, sf):
    return manifest.fold_files(inputs.fx_marks(spark, sf), mode="replace")


@query("manifest_lists", f"WITH {FX_MARKS}, {_LISTS} SELECT * FROM url_lists")
def manifest_lists(spark, sf):
    return _lists(spark, sf)


@query("manifest_summary", f"WITH {FX_MARKS}, {_LISTS}" + """
SELECT count(*) AS total, count(*) FILTER (WHERE list_type = 'completed') AS completed,
  count(*) FILTER (WHERE list_type = 'failed') AS failed FROM url_lists""")
def manifest_summary(spark, sf):
    return manifest.summary(_lists(spark, sf))


@query("discovered_urls", f"WITH {_DISCOVERED} SELECT * FROM discovered")
def discovered_urls(spark, sf):
    return _discovered(spark, sf)


@query("discovered_urls_replace", f"WITH {FX_CALLS}, {_LAST_CALLS} SELECT * FROM last_calls")
def discovered_urls_replace(spark, sf):
    return manifest.fold_discovered(inputs.fx_calls(spark, sf), mode="replace")


@query("new_discoveries", f"WITH {FX_CALLS}, {_LAST_CALLS}" + """,
known AS (SELECT DISTINCT lpad(CAST(user_id % 56 AS VARCHAR), 2, '0') AS state_fips,
  'u/' || user_id || '_' || (event_id % 5) AS url FROM events)
SELECT state_fips, url, discovered_at FROM last_calls
WHERE (state_fips, url) NOT IN (SELECT (state_fips, url) FROM known)""")
def new_discoveries(spark, sf):
    known = inputs.fx_marks(spark, sf).select("state_fips", "url").distinct()
    calls = inputs.fx_calls(spark, sf)
    last = calls.groupBy("state_fips").agg(F.max("seq").alias("seq"))
    return manifest.new_discoveries(known, calls.join(last, ["state_fips", "seq"], "left_semi"))


@query("state_counters", f"WITH {FX_MARKS}, {FX_CALLS}, {_STATES} SELECT * FROM states")
def state_counters(spark, sf):
    return manifest.state_rows(_states(spark, sf))


_NAMES = ", ".join(f"('{c}', '{n}')" for c, n in dims.STATES)


@query("state_names", f"WITH {FX_MARKS}, {FX_CALLS}, {_STATES}" + f"""
SELECT state_fips, coalesce(d.real, name) AS name, completed, failed, discovered, last_updated
FROM states LEFT JOIN (VALUES {_NAMES}) d(fips, real) ON fips = state_fips""")
def state_names(spark, sf):
    return manifest.name_states(_states(spark, sf), dims.states(spark))


@query("requested_states", f"WITH {FX_MARKS}, {FX_CALLS}, {_STATES} SELECT state_fips FROM states")
def requested_states(spark, sf):
    return manifest.requested_states(_states(spark, sf))


def _first_sql(rows: str, k: int) -> str:
    return f"""(SELECT state_fips, string_agg(url, '|' ORDER BY url) AS urls FROM (
      SELECT state_fips, url, row_number() OVER (PARTITION BY state_fips ORDER BY url) AS rn FROM ({rows}))
    WHERE rn <= {k} GROUP BY state_fips)"""


@query("state_progress", f"WITH {_ALL}" + f"""
SELECT s.state_fips, discovered, coalesce(f.completed, 0) AS completed, coalesce(f.failed, 0) AS failed,
  coalesce(p.n, 0) AS pending, coalesce(u.urls, '') AS pending_urls
FROM states s
LEFT JOIN (SELECT state_fips, count(*) FILTER (WHERE status = 'completed') AS completed,
    count(*) FILTER (WHERE status = 'failed') AS failed FROM files GROUP BY 1) f USING (state_fips)
LEFT JOIN (SELECT state_fips, count(*) AS n FROM pending GROUP BY 1) p USING (state_fips)
LEFT JOIN {_first_sql('SELECT * FROM pending', 10)} u USING (state_fips)""")
def state_progress(spark, sf):
    rows = manifest.progress(_states(spark, sf), _files(spark, sf), _pending(spark, sf))
    return rows.withColumn("pending_urls", _joined("pending_urls"))


def _ended_sql(status: str) -> str:
    return f"SELECT state_fips, url FROM files WHERE status = '{status}'"


@query("status_report", f"WITH {_ALL}" + f"""
SELECT state_fips, name, completed, failed, completed + failed AS total,
  coalesce(c.urls, '') AS completed_urls, coalesce(f.urls, '') AS failed_urls,
  coalesce(p.urls, '') AS pending_urls
FROM states
LEFT JOIN {_first_sql(_ended_sql('completed'), 3)} c USING (state_fips)
LEFT JOIN {_first_sql(_ended_sql('failed'), 3)} f USING (state_fips)
LEFT JOIN {_first_sql('SELECT * FROM pending', 3)} p USING (state_fips)""")
def status_report(spark, sf):
    rows = manifest.status_report(_states(spark, sf), _files(spark, sf), _pending(spark, sf))
    return rows.withColumns({c: _joined(c) for c in ("completed_urls", "failed_urls", "pending_urls")})


@query("pending_urls", f"WITH {FX_MARKS}, {_LISTS}, {_DISCOVERED}, {_PENDING} SELECT * FROM pending")
def pending_urls(spark, sf):
    return _pending(spark, sf)


@query("path_lookup", f"WITH {_FILES}, {FX_LISTING}" + """
SELECT l.path, coalesce(status = 'completed', false) AS is_completed,
  CASE WHEN status = 'partial' THEN coalesce(bytes_downloaded, 0) ELSE 0 END AS partial_size
FROM fx_listing l LEFT JOIN files f USING (path)""")
def path_lookup(spark, sf):
    return manifest.look_up(_files(spark, sf), inputs.fx_listing(spark, sf))


@query("ended_urls", f"WITH {_FILES}" + """
SELECT state_fips, status, url FROM files WHERE status IN ('completed', 'failed')""")
def ended_urls(spark, sf):
    return manifest.ended_urls(_files(spark, sf))


# The worklist plans a file per customer county and dataset; links found and
# lists come from the same counties, so that all three meet.
_PLANNED = FX_COUNTIES + f""",
planned AS (SELECT *, {_URL} AS url
  FROM fx_counties, (VALUES ('EDGES'), ('ADDR'), ('FEATNAMES')) d(dataset)),
found AS (SELECT DISTINCT state_fips, '{_BASE}EDGES/tl_2025_' || state_fips || county || '_edges.zip' AS url
  FROM fx_counties),
ended AS (SELECT DISTINCT '{_BASE}EDGES/tl_2025_' || lpad(CAST(c_custkey % 56 AS VARCHAR), 2, '0') ||
    lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '_edges.zip' AS url
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"""


def _planned(spark, sf):
    return worklist.plan_urls(inputs.fx_counties(spark, sf), 2025, dims.DEFAULT_DATASETS, "out")


def _found(spark, sf):
    counties = inputs.fx_counties(spark, sf)
    return worklist.plan_urls(counties, 2025, ["EDGES"]).select("state_fips", "url")


def _waiting(spark, sf):
    customer = F.col("c_custkey")
    ended = table(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        names.file_url(
            F.lit(2025), code(customer % 56, 2), code(customer % 1000, 3), F.lit("EDGES")
        ).alias("url"),
        F.lit("completed").alias("list_type"),
    )
    return manifest.pending(_found(spark, sf), ended)


@query("worklist", f"WITH {_PLANNED}" + """
SELECT dataset, state_fips, county, url FROM planned
WHERE url IN (SELECT url FROM found) AND url NOT IN (SELECT url FROM ended)""")
def worklist_pending(spark, sf):
    rows = worklist.worklist(_planned(spark, sf), _found(spark, sf), _waiting(spark, sf))
    return rows.select("dataset", "state_fips", "county", "url")


@query("worklist_retry", f"WITH {_PLANNED}" + """
SELECT dataset, state_fips, county, url FROM planned WHERE url IN (SELECT url FROM found)""")
def worklist_retry(spark, sf):
    rows = worklist.worklist(_planned(spark, sf), _found(spark, sf), _waiting(spark, sf), retry_failed=True)
    return rows.select("dataset", "state_fips", "county", "url")


@query("outcome_counts", f"WITH {FX_MARKS}" + """,
o AS (SELECT state_fips, kind, kind = 'failed' AND (lower(error) LIKE '%not found%' OR list_contains(string_split_regex(error, '[^0-9]+'), '404')) AS absent
  FROM fx_marks WHERE kind IN ('completed', 'failed'))
SELECT state_fips, 0 AS level, count(*) FILTER (WHERE kind = 'completed') AS successful,
  count(*) FILTER (WHERE kind = 'failed' AND NOT absent) AS failed, count(*) FILTER (WHERE absent) AS not_found
FROM o GROUP BY state_fips
UNION ALL
SELECT NULL, 1, count(*) FILTER (WHERE kind = 'completed'),
  count(*) FILTER (WHERE kind = 'failed' AND NOT absent), count(*) FILTER (WHERE absent) FROM o""")
def outcome_counts(spark, sf):
    return worklist.outcome_counts(inputs.fx_marks(spark, sf))


_RECONCILE = f"""WITH {_FILES}, {_LISTS}, {_DISCOVERED}, {_PENDING}, {FX_LISTING},
differences AS (
  SELECT 'updated' AS outcome, path, state_fips, url, length AS size FROM (
    SELECT 'd/' || state_fips || '/' || regexp_extract(url, '[^/]+$') AS path, min(state_fips) AS state_fips,
      min(url) AS url FROM {{wanted}} GROUP BY 1)
  JOIN fx_listing USING (path)
  WHERE path NOT IN (SELECT path FROM files WHERE status = 'completed')
  UNION ALL
  SELECT 'missing', path, state_fips, url, NULL FROM files
  WHERE status = 'completed' AND path NOT IN (SELECT path FROM fx_listing)
)
"""


def _reconcile(spark, sf, wanted):
    return worklist.reconcile(wanted(spark, sf), _files(spark, sf), inputs.fx_listing(spark, sf), "d")


@query("reconcile", _RECONCILE.format(wanted="pending") + "SELECT * FROM differences")
def reconcile(spark, sf):
    return _reconcile(spark, sf, _pending)


@query("reconcile_all", _RECONCILE.format(wanted="discovered") + "SELECT * FROM differences")
def reconcile_all(spark, sf):
    rows = worklist.reconcile(
        _discovered(spark, sf), _files(spark, sf), inputs.fx_listing(spark, sf), "d", recorded_paths=True
    )
    return rows


@query("reconcile_counts", _RECONCILE.format(wanted="pending") + """
SELECT count(*) FILTER (WHERE outcome = 'updated') AS updated,
  count(*) FILTER (WHERE outcome = 'missing') AS missing FROM differences""")
def reconcile_counts(spark, sf):
    return worklist.reconcile_counts(_reconcile(spark, sf, _pending))


@query("manifest_json", "WITH " + _FILES + " SELECT * FROM files")
def manifest_entries(spark, sf):
    path = scratch_dir(spark, "entries")
    manifest_json.write_entries({
        "files": _files(spark, sf), "url_lists": _lists(spark, sf),
        "states": _states(spark, sf), "discovered_urls": _discovered(spark, sf),
    }, path)
    return manifest_json.read_entries(spark, path)["files"]


@query("manifest_document", f"WITH {_ALL}" + """
SELECT 'files' AS section, state_fips AS part, path AS entry, status || ' ' || url || ' ' || coalesce(error, '') AS note,
  size AS first, bytes_downloaded AS second, timestamp AS at FROM files
UNION ALL SELECT list_type, NULL, url, NULL, NULL, NULL, NULL FROM url_lists
UNION ALL SELECT 'states', state_fips, name, CAST(discovered AS VARCHAR), completed, failed, last_updated FROM states
UNION ALL SELECT 'discovered_urls', state_fips, url, NULL, NULL, NULL, NULL FROM discovered""")
def manifest_document(spark, sf):
    """The manifest written as several documents, read back and put together."""
    path = scratch_dir(spark, "documents")
    manifest_json.write_document({
        "files": _files(spark, sf), "url_lists": _lists(spark, sf),
        "states": _states(spark, sf), "discovered_urls": _discovered(spark, sf),
    }, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    back = manifest_json.read_document(spark, path)

    def section(name, part="NULL", entry="url", note="NULL", first="NULL", second="NULL", at="NULL", source=None):
        return back[source or name].selectExpr(
            f"'{name}' AS section" if name != "url_lists" else "list_type AS section", f"CAST({part} AS STRING) AS part",
            f"{entry} AS entry", f"CAST({note} AS STRING) AS note", f"CAST({first} AS BIGINT) AS first",
            f"CAST({second} AS BIGINT) AS second", f"CAST({at} AS DOUBLE) AS at",
        )

    note = "concat_ws(' ', status, url, coalesce(error, ''))"
    return section("files", "state_fips", "path", note, "size", "bytes_downloaded", "timestamp").unionAll(
        section("url_lists")
    ).unionAll(section("states", "state_fips", "name", "discovered", "completed", "failed", "last_updated")).unionAll(
        section("discovered_urls", "state_fips")
    )


def _stream(spark, sf, view: str, events: Callable) -> DataFrame:
    """Write the events in call order, several files to a batch, and run the stream dry."""
    root = scratch_dir(spark, "stream")
    rows = events(spark, sf)
    rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "seq").write.parquet(f"{root}/events")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/events")
    manifest_stream.start_view(stream, view, root).awaitTermination()
    return manifest_stream.current(spark, view, root)


@query("manifest_stream", "WITH " + _FILES + " SELECT * FROM files")
def manifest_files_stream(spark, sf):
    return _stream(spark, sf, "files", inputs.fx_marks)


@query("lists_stream", f"WITH {FX_MARKS}, {_LISTS} SELECT * FROM url_lists")
def lists_stream(spark, sf):
    return _stream(spark, sf, "url_lists", inputs.fx_marks)


@query("counters_stream", f"WITH {FX_MARKS}" + """
SELECT state_fips, count(*) FILTER (WHERE kind = 'completed') AS completed,
  count(*) FILTER (WHERE kind = 'failed') AS failed,
  max(ts) FILTER (WHERE kind <> 'partial') AS moved, min(ts) AS created
FROM fx_marks GROUP BY 1""")
def counters_stream(spark, sf):
    return _stream(spark, sf, "mark_counters", inputs.fx_marks)


@query("states_stream", f"WITH {FX_MARKS}, {FX_CALLS}, {_STATES} SELECT * FROM states")
def states_stream(spark, sf):
    root = scratch_dir(spark, "stream")
    started = []
    try:
        for view, events in (("mark_counters", inputs.fx_marks), ("called_urls", inputs.fx_calls)):
            rows = events(spark, sf)
            rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "seq").write.parquet(f"{root}/{view}_in")
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/{view}_in")
            started.append(manifest_stream.start_view(stream, view, root))
        for running in started:  # side by side
            running.awaitTermination()
    finally:
        for running in started:
            running.stop()
    return manifest_stream.states(spark, root)


@query("discovered_stream", f"WITH {_DISCOVERED} SELECT * FROM discovered")
def discovered_stream(spark, sf):
    return _stream(spark, sf, "discovered_urls", inputs.fx_calls)


# Tables ---------------------------------------------------------------------

def _county_tables(spark, sf) -> list[con.Source]:
    """Line items as per-county address tables: one fits, one differs in names,
    one in a type; orders stand for a table that does not fit."""
    root = scratch_dir(spark, "counties")
    item = table(spark, sf, "lineitem")
    shapes = {
        "A": ("l_orderkey AS tlid", "CAST(l_partkey AS STRING) AS fromhn", "l_linestatus AS side"),
        "N": ("l_orderkey AS line", "CAST(l_partkey AS STRING) AS house", "l_linestatus AS s"),
        "R": ("CAST(l_orderkey AS STRING) AS tlid", "CAST(l_partkey AS STRING) AS fromhn", "l_linestatus AS side"),
    }
    paths = {}
    for number, (flag, columns) in enumerate(shapes.items()):
        name = f"tl_2025_1300{number}_addr"
        item.where(F.col("l_returnflag") == flag).selectExpr(*columns).write.parquet(f"{root}/{name}")
        paths[name] = f"{root}/{name}"
    table(spark, sf, "orders").write.parquet(f"{root}/tl_2025_13009_addr")
    paths["tl_2025_13009_addr"] = f"{root}/tl_2025_13009_addr"
    return con.path_sources(spark, paths)


_COUNTY_ROWS = """
county_rows AS (
  SELECT l_orderkey AS tlid, CAST(l_partkey AS VARCHAR) AS fromhn, l_linestatus AS side,
    CASE l_returnflag WHEN 'A' THEN 'tl_2025_13000_addr' WHEN 'N' THEN 'tl_2025_13001_addr'
      ELSE 'tl_2025_13002_addr' END AS source_table
  FROM lineitem
)"""


@query("consolidate", f"WITH {_COUNTY_ROWS} SELECT * FROM county_rows")
def consolidate(spark, sf):
    return con.consolidate(spark, _county_tables(spark, sf)).rows


@query("consolidate_report", f"WITH {_COUNTY_ROWS}" + """
SELECT source_table, count(*) AS n_rows, NULL AS reason FROM county_rows GROUP BY 1
UNION ALL SELECT 'tl_2025_13009_addr', NULL, '6 columns, expected 3'""")
def consolidate_report(spark, sf):
    result = con.consolidate(spark, _county_tables(spark, sf))
    counts = result.rows.groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("reason", F.lit(None).cast("string")).unionByName(
        result.rejects.withColumn("n_rows", F.lit(None).cast("bigint"))
    )


@query("consolidate_by_name", """
SELECT l_orderkey AS tlid, CAST(l_partkey AS VARCHAR) AS fromhn, l_linestatus AS side, 'tl_2025_13000_addr' AS source_table,
  NULL AS reason FROM lineitem WHERE l_returnflag = 'A'
UNION ALL
SELECT l_orderkey, NULL, l_linestatus, 'tl_2025_13001_addr', NULL FROM lineitem WHERE l_returnflag = 'N'
UNION ALL
SELECT NULL, NULL, NULL, name, (SELECT CAST(count(*) AS VARCHAR) || ' rows do not fit' FROM lineitem WHERE l_returnflag = 'R')
FROM (VALUES ('tl_2025_13002_addr'), ('tl_2025_13003_addr'), ('tl_2025_13004_addr')) r(name)""")
def consolidate_by_name(spark, sf):
    """By name: columns in another order and one too few fit; fractions, words and codes for whole numbers do not."""
    root = scratch_dir(spark, "counties")
    item = table(spark, sf, "lineitem")
    shapes = (
        ("A", ("l_orderkey AS tlid", "CAST(l_partkey AS STRING) AS fromhn", "l_linestatus AS side")),
        ("N", ("l_linestatus AS side", "CAST(l_orderkey AS STRING) AS tlid")),
        ("R", ("l_linestatus AS side", "l_orderkey + 0.5D AS tlid")),
        ("R", ("l_linestatus AS side", "concat('x', l_orderkey) AS tlid")),
        ("R", ("concat('0', l_orderkey) AS tlid", "l_linestatus AS side")),
    )
    paths = {}
    for number, (flag, columns) in enumerate(shapes):
        name = f"tl_2025_1300{number}_addr"
        item.where(F.col("l_returnflag") == flag).selectExpr(*columns).write.parquet(f"{root}/{name}")
        paths[name] = f"{root}/{name}"
    result = con.consolidate(spark, con.path_sources(spark, paths), by_name=True)
    return result.rows.withColumn("reason", F.lit(None).cast("string")).unionByName(
        result.rejects, allowMissingColumns=True
    )


@query("catalog_steps", """
WITH a AS (SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS ids FROM lineitem WHERE l_returnflag IN ('A', 'N')),
t AS (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT count(*) AS n FROM orders)
SELECT 'listed' AS step, 'tl_2025_13000_addr' AS table_name, NULL AS n_rows, NULL AS ids
UNION ALL SELECT 'listed', 'tl_2025_13001_addr', NULL, NULL UNION ALL SELECT 'listed', 'tl_2025_13009_addr', NULL, NULL
UNION ALL SELECT 'written', 'addr', n, ids FROM a
UNION ALL SELECT 'refused: 6 columns, expected 3', 'tl_2025_13009_addr', NULL, NULL
UNION ALL SELECT 'left', 'addr', least(n, 10), NULL FROM a
UNION ALL SELECT 'left', 'tl_2025_13009_addr', least(n, 10), NULL FROM o
UNION ALL SELECT 'left', name, 0, NULL FROM (VALUES ('edge'), ('feature'), ('feature_edge'), ('place'), ('range')) s(name)""")
def catalog_steps(spark, sf):
    """Per-county tables listed, consolidated into one and dropped; the star schema; the first rows of what is left."""
    path = scratch_dir(spark, "database")
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    item = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_linestatus")
    for number, flag in enumerate("AN"):
        own = item.where(F.col("l_returnflag") == flag).drop("l_returnflag")
        own.write.saveAsTable(f"{database}.tl_2025_1300{number}_addr")
    table(spark, sf, "orders").write.saveAsTable(f"{database}.tl_2025_13009_addr")
    # A row per table: what the catalog holds is small.
    rows = [("listed", r.table_name, None, None) for r in catalog.list_tables(spark, database, "addr").collect()]
    counts, rejects = con.consolidate_catalog(spark, database, ("addr",), drop_sources=True)
    ids = spark.table(f"{database}.addr").agg(F.sum("l_orderkey")).first()[0]
    rows += [("written", r.table_name, r.n_rows, ids) for r in counts.collect()]
    rows += [(f"refused: {r.reason}", r.source_table, None, None) for r in rejects.collect()]
    layout.create_star_schema(spark, database)
    rows += [("left", name, first.count(), None) for name, first in catalog.preview(spark, database, 10).items()]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(rows, "step string, table_name string, n_rows bigint, ids bigint")


@query("append_by_position", """
SELECT c_custkey AS c_custkey, c_name AS c_name FROM customer
UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def append_by_position(spark, sf):
    name, path = _scratch_table(spark, "appended")
    spark.sql(f"CREATE TABLE {name} (c_custkey BIGINT, c_name STRING) USING parquet LOCATION '{path}'")
    con.create_or_append(table(spark, sf, "customer").select("c_custkey", "c_name"), name)
    con.create_or_append(table(spark, sf, "supplier").select("s_suppkey", "s_name"), name)
    return spark.table(name)


@query("load_twice", "SELECT l_orderkey, l_quantity, l_returnflag, l_linestatus FROM lineitem")
def load_twice(spark, sf):
    path = scratch_dir(spark, "loaded")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    keys = ["l_returnflag", "l_linestatus"]
    for _ in range(2):  # the second load replaces the first
        con.write_partitions(rows, path, keys)
    return con.read_partitions(spark, path, keys)


def _edges(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tlid"), F.col("o_orderpriority").alias("fullname"),
        F.floor(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


def _addr(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("tlid"), F.col("l_partkey").cast("string").alias("fromhn"),
        code(F.col("l_suppkey"), 5).alias("zip"), F.col("l_quantity").cast("bigint").alias("quantity"),
    )


@query("lookup_tlid", """
SELECT o_orderkey AS tlid, o_orderpriority AS fullname, count(*) AS n_ranges,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def lookup_tlid(spark, sf):
    (edges, edges_path), (addr, addr_path) = (_scratch_table(spark, n) for n in ("edges", "addr"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layout.write_bucketed(_edges(spark, sf), edges, "tlid", buckets, edges_path)
    layout.write_bucketed(_addr(spark, sf), addr, "tlid", buckets, addr_path)
    joined = layout.join_on_id(spark, edges, addr)
    return joined.groupBy("tlid", "fullname").agg(
        F.count(F.lit(1)).alias("n_ranges"), F.sum("quantity").alias("quantity")
    )


@query("lookup_zip", """
SELECT s_name, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS zip, count(l_orderkey) AS n_ranges,
  count(DISTINCT l_orderkey) AS n_lines
FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def lookup_zip(spark, sf):
    name, path = _scratch_table(spark, "addr_by_zip")
    layout.write_sorted(_addr(spark, sf), name, ["zip"], ["tlid"], path)
    asked = table(spark, sf, "supplier").select("s_name", code(F.col("s_suppkey"), 5).alias("zip"))
    # Summed up by zip first: a crowded zip is then one row on either side of the join.
    by_line = spark.table(name).groupBy("zip", "tlid").agg(F.count(F.lit(1)).alias("n"))
    by_zip = by_line.groupBy("zip").agg(F.sum("n").alias("n_ranges"), F.count("tlid").alias("n_lines"))
    return asked.join(by_zip, "zip", "left").na.fill(0, ["n_ranges", "n_lines"])


@query("lookup_name", """
SELECT o_orderkey AS tlid, o_orderpriority AS fullname, CAST(floor(o_totalprice * 100) AS BIGINT) AS cents
FROM orders WHERE o_orderpriority = (SELECT max(o_orderpriority) FROM orders)""")
def lookup_name(spark, sf):
    name, path = _scratch_table(spark, "edges_by_fullname")
    layout.write_sorted(_edges(spark, sf), name, ["fullname"], ["tlid"], path)
    last = _edges(spark, sf).agg(F.max("fullname")).first()[0]
    return layout.look_up(spark, name, fullname=last)


@query("lookup_place", """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip, substr(c_mktsegment, 1, 1) AS priority,
  count(*) AS n_places, min(c_name) AS first_city
FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier) GROUP BY 1, 2""")
def lookup_place(spark, sf):
    name, path = _scratch_table(spark, "place_by_zip_priority")
    places = table(spark, sf, "customer").select(
        code(F.col("c_nationkey"), 5).alias("zip"), F.col("c_name").alias("city"),
        F.substring("c_mktsegment", 1, 1).alias("priority"), F.col("c_custkey").alias("id"),
    )
    layout.write_sorted(places, name, ["zip", "priority"], ["id"], path)
    asked = table(spark, sf, "supplier").select(code(F.col("s_nationkey"), 5).alias("zip")).distinct()
    return spark.table(name).join(asked, "zip", "left_semi").groupBy("zip", "priority").agg(
        F.count(F.lit(1)).alias("n_places"), F.min("city").alias("first_city")
    )


_STAR_ROWS = {
    "place": ("customer", {
        "zip": "lpad(CAST(c_custkey % 1000 AS STRING), 5, '0')", "city": "c_mktsegment", "state": "lpad(CAST(c_nationkey AS STRING), 2, '0')",
        "city_phone": "upper(substr(c_mktsegment, 1, 5))", "priority": "substr(c_name, -1)",
    }),
    "feature": ("orders", {
        "fid": "o_orderkey", "street": "o_orderpriority", "street_phone": "substr(o_orderpriority, 1, 5)",
        "paflag": "o_orderstatus = 'F'", "zip": "lpad(CAST(o_custkey % 1000 AS STRING), 5, '0')",
    }),
    "feature_edge": ("lineitem", {"fid": "l_orderkey", "tlid": "l_orderkey * 10 + l_linenumber"}),
    "range": ("lineitem", {
        "tlid": "l_orderkey * 10 + l_linenumber", "fromhn": "l_partkey", "tohn": "l_partkey + l_suppkey", "side": "l_linestatus",
    }),
}


@query("lookup_star", """
WITH p AS (
  SELECT DISTINCT lpad(CAST(c_custkey % 1000 AS VARCHAR), 5, '0') AS zip, upper(substr(c_mktsegment, 1, 5)) AS city_phone
  FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)),
f AS (
  SELECT DISTINCT o_orderkey AS fid, o_orderpriority AS street, o_orderstatus = 'F' AS paflag, zip FROM orders
  JOIN p ON lpad(CAST(o_custkey % 1000 AS VARCHAR), 5, '0') = p.zip
  WHERE city_phone = (SELECT min(upper(substr(c_mktsegment, 1, 5))) FROM customer)
    AND substr(o_orderpriority, 1, 5) = (SELECT min(substr(o_orderpriority, 1, 5)) FROM orders))
SELECT fid, e.l_orderkey * 10 + e.l_linenumber AS tlid, street, paflag, zip, r.l_partkey AS fromhn,
  r.l_partkey + r.l_suppkey AS tohn, r.l_linestatus AS side
FROM f JOIN lineitem e ON e.l_orderkey = fid
JOIN lineitem r ON r.l_orderkey * 10 + r.l_linenumber = e.l_orderkey * 10 + e.l_linenumber""")
def lookup_star(spark, sf):
    """From the sounds of a city and a street to house numbers: every access path of the star tables, by sets of keys."""
    path = scratch_dir(spark, "star")
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    layout.create_star_schema(spark, database)
    for name, (given, columns) in _STAR_ROWS.items():
        target = spark.table(f"{database}.{name}").schema
        rows = table(spark, sf, given).select(*[F.expr(e).alias(c) for c, e in columns.items()])
        rows.select(*[(F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]).write.insertInto(
            f"{database}.{name}"
        )
    star = {t: layout.ACCESS_PATHS[t] for t in ("place", "feature", "feature_edge", "range")}
    layout.build_access_paths(spark, database, tables=star)

    def found(name: str, asked: DataFrame) -> DataFrame:
        return layout.look_up_set(spark, f"{database}.{name}", asked)

    city = F.min(F.expr(_STAR_ROWS["place"][1]["city_phone"]))
    street = F.min(F.expr(_STAR_ROWS["feature"][1]["street_phone"]))
    first = [table(spark, sf, t).agg(c).first()[0] for t, c in (("customer", city), ("orders", street))]
    asked = table(spark, sf, "nation").where("n_regionkey = 1").select(F.lit(first[0]).alias("city_phone"), code(F.col("n_nationkey"), 2).alias("state"))
    zips = found("place_by_city_phone_state", asked).select("zip").distinct()
    features = found("feature_by_street_phone_zip", zips.select(F.lit(first[1]).alias("street_phone"), "zip"))
    lines = found("feature_edge_by_fid", features.select("fid"))
    ranges = found("range_by_tlid", lines.select("tlid")).select("tlid", "fromhn", "tohn", "side")
    return lines.join(features.select("fid", "street", "paflag", "zip"), "fid").join(ranges, "tlid").select(
        "fid", "tlid", "street", "paflag", "zip", "fromhn", "tohn", "side"
    )


@query("lookup_county", """
SELECT c_custkey AS tlid, CAST(floor(c_acctbal * 100) AS BIGINT) AS cents,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS statefp, lower(c_mktsegment) AS countyfp
FROM customer WHERE c_nationkey = (SELECT max(c_nationkey) FROM customer)
  AND lower(c_mktsegment) = (SELECT min(lower(c_mktsegment)) FROM customer)""")
def lookup_county(spark, sf):
    name, path = _scratch_table(spark, "edges_by_county")
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("tlid"), F.floor(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
        code(F.col("c_nationkey"), 2).alias("statefp"), F.lower("c_mktsegment").alias("countyfp"),
    )
    layout.write_partitioned(rows, name, ["statefp", "countyfp"], path)
    asked = rows.agg(F.max("statefp").alias("statefp"), F.min("countyfp").alias("countyfp")).first()
    return layout.look_up(spark, name, statefp=asked.statefp, countyfp=asked.countyfp)


@query("manifest_by_state", "WITH " + _FILES + " SELECT * FROM files")
def manifest_by_state(spark, sf):
    path = scratch_dir(spark, "manifest")
    layout.write_manifest(_files(spark, sf), path)
    return layout.read_manifest(spark, path)


@query("relaid_files", ORACLES["name_parse"])
def relaid_files(spark, sf):
    path = scratch_dir(spark, "relaid")
    layout.write_relaid(name_parse(spark, sf), path)
    return con.read_partitions(spark, path, ["year", "state", "feature"])


# Geometry and files ---------------------------------------------------------

def _points(spark, sf):
    """All 64 values of an embedding as 32 points."""
    pair = [F.get("embedding", F.col("n") * 2 + i).cast("double") for i in range(2)]
    return table(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("n")
    ).select("vec_id", "n", pair[0].alias("x"), pair[1].alias("y"))


_POINTS = """
points AS (
  SELECT vec_id, n, CAST(embedding[2 * n + 1] AS DOUBLE) AS x, CAST(embedding[2 * n + 2] AS DOUBLE) AS y
  FROM embeddings, (SELECT CAST(unnest(range(32)) AS INTEGER) AS n))"""


@query("bbox_window", f"WITH {_POINTS}" + """
SELECT vec_id, n, x AS xmin, y AS ymin FROM points WHERE x BETWEEN -0.1 AND 0.15 AND y BETWEEN -0.05 AND 0.2""")
def bbox_window(spark, sf):
    path = scratch_dir(spark, "spatial")
    boxes = _points(spark, sf).select(
        "vec_id", "n", F.col("x").alias("xmin"), F.col("y").alias("ymin"),
        F.col("x").alias("xmax"), F.col("y").alias("ymax"),
    )
    layout.write_spatial(boxes, path, size=0.02)
    found = layout.in_window(spark.read.parquet(path), -0.1, -0.05, 0.15, 0.2)
    return found.select("vec_id", "n", "xmin", "ymin")


@query("wkb_roundtrip", f"WITH {_POINTS} SELECT vec_id, n, x, y, 4326 AS srid, 21 AS n_bytes FROM points")
def wkb_roundtrip(spark, sf):
    coded = _points(spark, sf).select("vec_id", "n", geometry.point_wkb(F.col("x"), F.col("y")).alias("wkb"))
    found = coded.select("vec_id", "n", geometry.wkb_point(F.col("wkb")).alias("p"), F.length("wkb").alias("n_bytes"))
    return found.select("vec_id", "n", "p.x", "p.y", geometry.srid().alias("srid"), "n_bytes")


_PART_FIELDS = [
    roundtrip.DbfField("p_partkey", "N", 12),
    roundtrip.DbfField("p_name", "C", 60),
    roundtrip.DbfField("p_brand", "C", 20),
    roundtrip.DbfField("p_size", "N", 6),
    roundtrip.DbfField("price", "N", 14, 2),
    roundtrip.DbfField("ratio", "F", 20, 6),
    roundtrip.DbfField("wide", "N", 20),
    roundtrip.DbfField("day", "D", 8),
    roundtrip.DbfField("flag", "L", 1),
]


def _parts(spark, sf):
    """Parts with every type that a text field can hold, blanks among them; every seventh is deleted."""
    key = F.col("p_partkey")
    return table(spark, sf, "part").withColumns({
        "price": F.col("p_retailprice").cast("decimal(12,2)"),
        "p_size": F.when(key % 5 != 0, F.col("p_size")),
        "ratio": F.col("p_retailprice") / 8,
        "wide": key.cast("decimal(20,0)") + F.lit("10000000000000000000").cast("decimal(20,0)"),
        "day": F.when(key % 3 != 0, F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (key % 999).cast("int")), "yyyyMMdd")),
        "flag": F.when(key % 4 == 0, "T").when(key % 4 == 1, "F"),
        "deleted": key % 7 == 0,
    })


_PART_SQL = """
SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS BIGINT) END AS p_size,
  p_retailprice AS price, p_retailprice / 8 AS ratio, CAST(10000000000000000000 + p_partkey AS VARCHAR) AS wide,
  CASE WHEN p_partkey % 3 <> 0 THEN CAST(DATE '2020-01-01' + CAST(p_partkey % 999 AS INTEGER) AS VARCHAR) END AS day,
  CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag
FROM part WHERE p_partkey % 7 <> 0"""


def _plain(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"wide": F.col("wide").cast("string"), "day": F.col("day").cast("string")})


@query("dbf_roundtrip", _PART_SQL)
def dbf_roundtrip(spark, sf):
    path = scratch_dir(spark, "dbf")
    roundtrip.write_files(_parts(spark, sf), _PART_FIELDS, path, "parts", deleted="deleted")
    return _plain(dbf.read_dbf(spark, path))


_FAULT_FIELDS = [roundtrip.DbfField("p_partkey", "N", 12), roundtrip.DbfField("p_name", "C", 60), roundtrip.DbfField("p_size", "N", 6)]


@query("dbf_faults", """
WITH p AS (
  SELECT p_partkey // 100 AS grp, p_partkey, p_size, p_partkey % 701 = 5 AS spoiled,
    row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) AS n FROM part),
b AS (SELECT grp, min(n) FILTER (WHERE spoiled) AS bad_record FROM p GROUP BY 1)
SELECT grp, p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS BIGINT) AS bad_record
FROM p JOIN b USING (grp) WHERE bad_record IS NULL
UNION ALL SELECT grp, NULL, NULL, bad_record FROM b WHERE bad_record IS NOT NULL""")
def dbf_faults(spark, sf):
    """Files of 100 records in splits of some 40, of which those with an unreadable number come out as one row."""
    path = scratch_dir(spark, "dbf")
    size = F.when(F.col("p_partkey") % 701 == 5, "x9").otherwise(F.col("p_size").cast("string"))
    rows = table(spark, sf, "part").withColumns({"grp": F.expr("p_partkey div 100"), "p_size": size})
    roundtrip.write_files(rows, _FAULT_FIELDS, path, "parts", by="grp")
    found = dbf.read_dbf(spark, path, splitBytes=3200, sourceColumn="file", errorColumn="problem")
    number = lambda c, pattern: F.regexp_extract(c, pattern, 1).try_cast("bigint")
    return found.select(
        number("file", r"parts(\d+)$").alias("grp"), "p_partkey", "p_size", number("problem", r"record (\d+):").alias("bad_record")
    )


# Closed rings of unit steps: shells clockwise, holes the other way round.
_SHELL = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]
_HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
_EAST = [[(x + 5, y) for x, y in ring] for ring in (_SHELL, _HOLE)]
# By the remainder of the key: shape type, rings as they stand in the file, and the place of each in the result.
_SHAPES = [
    (5, [_SHELL, _HOLE], [(0, 0), (0, 1)]),
    (5, [_EAST[1], _SHELL, _HOLE, _EAST[0]], [(1, 1), (0, 0), (0, 1), (1, 0)]),
    (3, [_SHELL, _EAST[1], _HOLE], [(0, 0), (1, 0), (2, 0)]),
]
_CORNERS = ", ".join(
    f"({case}, {part}, {ring}, {n}, {x}, {y})"
    for case, (_, rings, places) in enumerate(_SHAPES)
    for points, (part, ring) in zip(rings, places) for n, (x, y) in enumerate(points)
)


@query("polygon_roundtrip", f"""
WITH c(case_id, part, ring, n, dx, dy) AS (VALUES {_CORNERS}),
p AS (
  SELECT c_custkey, part, ring, n, CAST(c_custkey % 100 * 10 + dx AS DOUBLE) AS x, CAST(c_custkey // 100 * 10 + dy AS DOUBLE) AS y
  FROM customer JOIN c ON c_custkey % 3 = case_id)
SELECT *, min(x) OVER w AS xmin, min(y) OVER w AS ymin, max(x) OVER w AS xmax, max(y) OVER w AS ymax, 4269 AS srid
FROM p WINDOW w AS (PARTITION BY c_custkey)""")
def polygon_roundtrip(spark, sf):
    """Polygons with holes, several polygons and lines of several parts: every point of each."""
    path = scratch_dir(spark, "polygons")
    key = F.col("c_custkey")
    for case, (kind, rings, _) in enumerate(_SHAPES):
        flat = [c for ring in rings for x, y in ring for c in (key % 100 * 10 + x, F.expr("c_custkey div 100") * 10 + y)]
        rows = table(spark, sf, "customer").where(key % 3 == case).withColumn("points", F.array(*flat))
        starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
        roundtrip.write_files(rows, [roundtrip.DbfField("c_custkey", "N", 12)], path, f"case{case}x", "points", starts, kind=kind)
    found = shapefile.read_shapefile(spark, path).select(
        "c_custkey", F.explode(geometry.wkb_runs(F.col("geometry"))).alias("run"), "xmin", "ymin", "xmax", "ymax", "srid"
    ).select("*", F.explode(F.expr("sequence(0, cast(size(run.xy) div 2 AS int) - 1)")).alias("n"))
    return found.select(
        "c_custkey", "run.part", "run.ring", "n", F.get("run.xy", F.col("n") * 2).alias("x"),
        F.get("run.xy", F.col("n") * 2 + 1).alias("y"), "xmin", "ymin", "xmax", "ymax", "srid",
    )


_LINE_FIELDS = [roundtrip.DbfField("vec_id", "N", 12), roundtrip.DbfField("label", "N", 8)]
_LINE_SQL = f"WITH {_POINTS}" + """
SELECT vec_id, CAST(label AS BIGINT) AS label, n, x, y, xmin, ymin, xmax, ymax, 4269 AS srid FROM points
JOIN (SELECT vec_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM points GROUP BY 1) USING (vec_id)
JOIN embeddings USING (vec_id)"""


def _lines(spark, sf):
    return table(spark, sf, "embeddings").withColumn("points", F.col("embedding"))


def _line_points(rows: DataFrame) -> DataFrame:
    """One row per point of the geometry."""
    flat = geometry.wkb_coordinates(F.col("geometry"))
    apart = rows.select(
        "vec_id", "label", "xmin", "ymin", "xmax", "ymax", "srid", flat.alias("flat")
    ).select("*", F.explode(F.expr("sequence(0, cast(size(flat) div 2 AS int) - 1)")).alias("n"))
    return apart.select(
        "vec_id", "label", "n", F.get("flat", F.col("n") * 2).alias("x"), F.get("flat", F.col("n") * 2 + 1).alias("y"),
        "xmin", "ymin", "xmax", "ymax", "srid",
    )


@query("shp_roundtrip", _LINE_SQL)
def shp_roundtrip(spark, sf):
    path = scratch_dir(spark, "shp")
    roundtrip.write_files(_lines(spark, sf), _LINE_FIELDS, path, "lines", "points", [0])
    return _line_points(shapefile.read_shapefile(spark, path))


@query("zip_expand", "SELECT count(*) AS n_records, '.dbf' AS suffix, 0 AS n_errors FROM part")
def zip_expand(spark, sf):
    path = scratch_dir(spark, "zip")
    roundtrip.write_files(_parts(spark, sf), _PART_FIELDS, path, "parts", zipped=True)
    members = files.expand_archives(files.list_archives(spark, path), (".dbf",))
    width, head = 1 + sum(f.width for f in _PART_FIELDS), 34 + 32 * len(_PART_FIELDS)
    records = ((F.length("content") - head) / width).cast("bigint")
    suffix = F.regexp_extract("member", r"(\.[^.]+)$", 1)
    return members.groupBy(suffix.alias("suffix")).agg(
        F.sum(records).alias("n_records"), F.count("error").alias("n_errors")
    )


@query("zip_tables", _PART_SQL)
def zip_tables(spark, sf):
    path = scratch_dir(spark, "zip")
    roundtrip.write_files(_parts(spark, sf), _PART_FIELDS, path, "parts", zipped=True, deleted="deleted")
    tables = archive_tables.list_tables(files.list_archives(spark, path))
    rows = archive_tables.read_tables(tables, archive_tables.archive_schema(tables))
    return _plain(rows.where("error IS NULL").drop("error", "source_table"))


@query("zip_shapes", _LINE_SQL)
def zip_shapes(spark, sf):
    path = scratch_dir(spark, "zip")
    roundtrip.write_files(_lines(spark, sf), _LINE_FIELDS, path, "lines", "points", [0, 16], zipped=True)
    tables = archive_tables.list_tables(files.list_archives(spark, path))
    rows = archive_tables.read_tables(tables, archive_tables.archive_schema(tables))
    return _line_points(rows.where("error IS NULL"))


# Orders and limits ----------------------------------------------------------

@query("newest", "SELECT CAST(o_orderkey AS VARCHAR) AS path, o_orderdate AS modificationTime FROM orders "
       "ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 1")
def newest(spark, sf):
    return files.newest_file(table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("path"), F.col("o_orderdate").alias("modificationTime")
    ))


@query("table_names", "WITH " + FX_FILES + f"""
SELECT DISTINCT {_STEM} AS table_name FROM fx_files WHERE {_STEM} LIKE 'tl_%_edges'""")
def table_names(spark, sf):
    stems = inputs.fx_files(spark, sf).select(names.table_name(F.col("path")).alias("table_name"))
    return stems.where(names.table_of_type(F.col("table_name"), "edges")).distinct().orderBy("table_name")


@query("preview_sorted", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_sorted(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate").orderBy("o_orderkey").limit(10)
