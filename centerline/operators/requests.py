"""Requested states and datasets, checked against the dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.sources import dims


def _items(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))


def _checked(requests: DataFrame, text: str, clean, defaults: Column, dim: DataFrame, key: str) -> DataFrame:
    """Exploded items with ``known``: does the dimension hold them?

    The dimension has a fixed number of rows (56 or 18), so it is broadcast.
    """
    named = F.coalesce(F.col(text), F.lit("")) != ""
    items = F.when(named, F.transform(_items(F.col(text)), clean)).otherwise(defaults)
    rows = requests.select("request_id", F.posexplode(items).alias("position", key))
    known = dim.select(key, F.lit(True).alias("known"))
    return rows.join(F.broadcast(known), key, "left").select(
        "request_id", "position", key, F.coalesce("known", F.lit(False)).alias("known")
    )


def _pad(code: Column) -> Column:
    # lpad would cut longer values, zero filling must not.
    return F.when(F.length(code) < 2, F.lpad(code, 2, "0")).otherwise(code)


def check_states(requests: DataFrame, include_territories: bool = False) -> DataFrame:
    """State codes of each request ``(request_id, states)``.

    ``states`` is text such as ``"1, 06"``; without any, the default codes stand.
    A list that names states is kept as it is, territories included.
    """
    defaults = F.array(*map(F.lit, dims.default_states(include_territories)))
    dim = dims.states(requests.sparkSession)
    return _checked(requests, "states", _pad, defaults, dim, "state_fips")


def check_datasets(requests: DataFrame) -> DataFrame:
    """Dataset types of each request ``(request_id, datasets)``."""
    defaults = F.array(*map(F.lit, dims.DEFAULT_DATASETS))
    dim = dims.datasets(requests.sparkSession)
    return _checked(requests, "datasets", F.upper, defaults, dim, "dataset")


def request_errors(checked: DataFrame) -> DataFrame:
    """Unknown codes; a request that has any is refused as a whole."""
    return checked.where("NOT known").drop("known")


def accepted(checked: DataFrame) -> DataFrame:
    """Codes of the requests without an unknown one."""
    refused = request_errors(checked).select("request_id").distinct()
    return checked.drop("known").join(refused, "request_id", "left_anti")
