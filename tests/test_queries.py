import re

import oracle
import pytest

import __spark_entry__ as entry
from centerline.plans.catalogue import ORACLES, QUERIES

WITH_FILES = {"dbf_roundtrip", "dbf_faults", "polygon_roundtrip", "shp_roundtrip", "zip_expand", "zip_tables", "zip_shapes", "wkb_roundtrip"}


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, db, name):
    frame = QUERIES[name](spark, sf_dir)
    _, problem = oracle.compare(frame, db, ORACLES[name])
    assert problem is None
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    if name not in WITH_FILES:
        assert not re.search("Python|InPandas|InArrow|ArrowEval", text)


def test_entry(spark):
    assert entry.entry(spark).count() == 56


@pytest.mark.parametrize("name", ["state_progress", "status_report"])
def test_samples_are_cut_before_the_shuffle(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"row_number\(\), \d+, Partial", text)


@pytest.mark.parametrize("name", ["manifest_files", "manifest_lists", "discovered_urls", "state_counters", "link_counts"])
def test_groups_combine_before_the_shuffle(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in text


def test_links_are_counted_in_one_pass(spark, sf_dir):
    text = QUERIES["link_counts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) <= 1 and "Union" not in text


def test_links_need_no_shuffle(spark, sf_dir):
    text = QUERIES["link_extract"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
