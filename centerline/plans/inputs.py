"""Inputs of the registered queries, derived from the given tables.

Each has a Spark form and the same SELECT for the checking engine.  Every row of
the table it starts from takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session zone."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    whole = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    micros = whole * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return micros / F.lit(1_000_000.0)


def fx_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a download tree: shared stems, some without a county, some lone DBFs."""
    key = F.col("o_orderkey")
    base, depth = key - key % 3, key % 4

    def pick(index: Column, *values: str) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), index.cast("int") + 1)

    year, state, county = (2020 + base % 6).cast("string"), code(base % 80, 2), code(base % 1000, 3)
    feature = pick(base % 4, "edges", "addr", "featnames", "faces")
    # A third member is a shapefile or, where the base is even, something else.
    suffix = pick(key % 3 + F.when((key % 3 == 2) & (base % 2 == 0), 1).otherwise(0), ".zip", ".dbf", ".shp", ".prj")
    in_name = F.when(base % 10 == 0, "").otherwise(county)
    name = F.concat(F.lit("tl_"), year, F.lit("_"), state, in_name, F.lit("_"), feature, suffix)
    folders = [F.when(depth >= at, part) for at, part in ((1, year), (1, state), (2, county), (3, feature))]
    return table(spark, sf_dir, "orders").select(
        key.alias("file_id"), name.alias("name"), F.concat_ws("/", *folders, name).alias("path"),
        year.alias("year"), F.upper(feature).alias("dataset"),
        F.floor(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
    )


FX_FILES = """
fx_files AS (
  SELECT o_orderkey AS file_id, name, folder || name AS path, year, upper(feature) AS dataset,
    CAST(floor(o_totalprice * 100) AS BIGINT) AS size
  FROM (
    SELECT *, 'tl_' || year || '_' || state || county || '_' || feature || suffix AS name,
      CASE o_orderkey % 4 WHEN 1 THEN year || '/' || state || '/'
        WHEN 2 THEN year || '/' || state || '/' || lpad(CAST(b % 1000 AS VARCHAR), 3, '0') || '/'
        WHEN 3 THEN year || '/' || state || '/' || lpad(CAST(b % 1000 AS VARCHAR), 3, '0') || '/' || feature || '/'
        ELSE '' END AS folder
    FROM (
      SELECT *, CAST(2020 + b % 6 AS VARCHAR) AS year, lpad(CAST(b % 80 AS VARCHAR), 2, '0') AS state,
        CASE WHEN b % 10 = 0 THEN '' ELSE lpad(CAST(b % 1000 AS VARCHAR), 3, '0') END AS county,
        CASE b % 4 WHEN 0 THEN 'edges' WHEN 1 THEN 'addr' WHEN 2 THEN 'featnames' ELSE 'faces' END AS feature,
        CASE o_orderkey % 3 WHEN 0 THEN '.zip' WHEN 1 THEN '.dbf'
          ELSE CASE WHEN b % 2 = 0 THEN '.prj' ELSE '.shp' END END AS suffix
      FROM (SELECT *, o_orderkey - o_orderkey % 3 AS b FROM orders)
    )
  )
)"""


def fx_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mark events: every event is a completed, failed or partial mark."""
    event = F.col("event_type")
    kind = (
        F.when(event.isin("purchase", "signup"), "completed")
        .when(event == "error", "failed").otherwise("partial")
    )
    state = code(F.col("user_id") % 56, 2)
    file = F.concat_ws("_", F.col("user_id"), F.col("event_id") % 5)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), epoch_seconds(F.col("ts")).alias("ts"), kind.alias("kind"),
        F.concat(F.lit("u/"), file).alias("url"), F.concat_ws("/", F.lit("d"), state, file).alias("path"),
        state.alias("state_fips"),
        F.floor(F.col("value") * 100).cast("bigint").alias("size"),
        F.floor("value").cast("bigint").alias("bytes_downloaded"),
        F.concat(F.lit("error "), F.col("event_id")).alias("error"),
    )


FX_MARKS = """
fx_marks AS (
  SELECT event_id AS seq, epoch(ts) AS ts,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'completed' WHEN event_type = 'error' THEN 'failed'
      ELSE 'partial' END AS kind,
    'u/' || user_id || '_' || (event_id % 5) AS url,
    'd/' || lpad(CAST(user_id % 56 AS VARCHAR), 2, '0') || '/' || user_id || '_' || (event_id % 5) AS path,
    lpad(CAST(user_id % 56 AS VARCHAR), 2, '0') AS state_fips,
    CAST(floor(value * 100) AS BIGINT) AS size, CAST(floor(value) AS BIGINT) AS bytes_downloaded,
    'error ' || event_id AS error
  FROM events
)"""


def fx_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery calls: rounds of 500 events, a call per state, then one for customers."""
    user, event = F.col("user_id"), F.col("event_id")
    seq = F.floor(event / 500).cast("bigint") * 56 + user % 56
    seen = table(spark, sf_dir, "events").select(
        seq.alias("seq"), code(user % 56, 2).alias("state_fips"),
        F.concat(F.lit("u/"), F.concat_ws("_", user, event % 5)).alias("url"),
    )
    customer = F.col("c_custkey")
    listed = table(spark, sf_dir, "customer").select(
        (customer % 56 + 56_000_000_000).alias("seq"), code(customer % 56, 2).alias("state_fips"),
        F.concat(F.lit("u/c"), customer).alias("url"),
    )
    calls = seen.unionAll(listed)
    return calls.withColumn("ts", (F.col("seq") * 10).cast("double"))


FX_CALLS = """
fx_calls AS (
  SELECT *, CAST(seq * 10 AS DOUBLE) AS ts FROM (
    SELECT CAST(floor(event_id / 500) AS BIGINT) * 56 + user_id % 56 AS seq,
      lpad(CAST(user_id % 56 AS VARCHAR), 2, '0') AS state_fips,
      'u/' || user_id || '_' || (event_id % 5) AS url FROM events
    UNION ALL
    SELECT c_custkey % 56 + 56000000000, lpad(CAST(c_custkey % 56 AS VARCHAR), 2, '0'),
      'u/c' || c_custkey FROM customer
  )
)"""


def fx_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on disk: those of some customers and those that were ever viewed."""
    customer = F.col("c_custkey")
    kept = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(
        F.concat_ws("/", F.lit("d"), code(customer % 56, 2), F.concat(F.lit("c"), customer)).alias("path"),
        F.floor(F.abs("c_acctbal") * 100).cast("bigint").alias("length"),
    )
    user, event = F.col("user_id"), F.col("event_id")
    viewed = table(spark, sf_dir, "events").where("event_type = 'view'").select(
        F.concat_ws("/", F.lit("d"), code(user % 56, 2), F.concat_ws("_", user, event % 5)).alias("path"),
        F.floor(F.col("value") * 100).cast("bigint").alias("length"),
    )
    return kept.unionAll(viewed.groupBy("path").agg(F.max("length").alias("length")))


FX_LISTING = """
fx_listing AS (
  SELECT 'd/' || lpad(CAST(c_custkey % 56 AS VARCHAR), 2, '0') || '/c' || c_custkey AS path,
    CAST(floor(abs(c_acctbal) * 100) AS BIGINT) AS length
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
  UNION ALL
  SELECT 'd/' || lpad(CAST(user_id % 56 AS VARCHAR), 2, '0') || '/' || user_id || '_' || (event_id % 5),
    max(CAST(floor(value * 100) AS BIGINT))
  FROM events WHERE event_type = 'view' GROUP BY 1
)"""


def fx_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counties of the customers."""
    customer = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        code(customer % 56, 2).alias("state_fips"), code(customer % 1000, 3).alias("county")
    ).distinct()


FX_COUNTIES = """
fx_counties AS (
  SELECT DISTINCT lpad(CAST(c_custkey % 56 AS VARCHAR), 2, '0') AS state_fips,
    lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS county FROM customer
)"""


def fx_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the yearly dataset folders, one per file."""
    files = fx_files(spark, sf_dir)
    directory = F.concat(F.lit("list/"), F.col("year"), F.lit("/"), F.col("dataset"), F.lit("/"))
    return files.select("dataset", "year", directory.alias("directory"), F.col("name").alias("href"))


FX_LINKS = FX_FILES + """,
fx_links AS (
  SELECT dataset, year, 'list/' || year || '/' || dataset || '/' AS directory, name AS href FROM fx_files
)"""
