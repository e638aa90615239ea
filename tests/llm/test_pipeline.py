"""The pipeline and the registered queries against brute force over a small table."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest

from centerline.llm import quality
from centerline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def sf(tmp_path_factory, docs, benchmark, labels):
    path = str(tmp_path_factory.mktemp("sf"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline_against_brute_force(spark, sf, rows, items):
    # Too few labels for any cutoff, so the base rules alone decide.
    left = [(i, t) for i, t in rows if not brute.base_failed(brute.measures(t))]
    roots = brute.linked([brute.fingerprint(t) for _, t in left])
    order = lambda r: (r[0] is None, r[0] or 0)
    groups = {}
    for root, row in zip(roots, left):
        if root not in groups or order(row) < order(groups[root]):
            groups[root] = row
    left = list(groups.values())
    left = [(i, brute.cut_text(t, gone)) for (i, t), (_, gone) in zip(left, brute.repeats(left, 50))]
    left = [(i, t) for i, t in left if not brute.contaminated(t, items)]
    found = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(order, ((r.doc_id, 0) for r in found))) == sorted(map(order, left))
    assert all(r.lossless for r in found)


def test_stages_keep_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_each_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_base_rules_only_without_labels(spark, sf, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality.without_rejected(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert kept.count() == sum(not brute.base_failed(brute.measures(t)) for _, t in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    import oracle

    _, problem = oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name])
    assert problem is None
