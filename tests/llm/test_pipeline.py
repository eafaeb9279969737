"""The pipeline and the registered queries over the smallest tables."""

import pytest

import corpus_pipeline
from check_oracle import compare, connect
from rollbook.llm import minhash, quality, tiling
from rollbook.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    good, text = compare(spark, connect(sf_dir), sf_dir, name)
    assert good, text


@pytest.mark.parametrize("name", ["op3_source_mix", "op7_secret_scan"])
def test_no_python_in_native_plans(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["quality rules"](spark, docs, sf_dir)
    left = {r.doc_id: r.text for r in clean.collect()}
    judged = {k: quality.judge(t) for k, t in given.items()}
    assert left == {k: j[-1] for k, j in judged.items() if j[6]} and clean.columns == docs.columns

    clean = spark.createDataFrame(clean.collect(), docs.schema)
    kept = {r.doc_id for r in stages["near-duplicates"](spark, clean, sf_dir).collect()}
    sets, gone = {k: minhash._shingled(t) for k, t in left.items()}, set()
    for k in sorted(left):
        # on these tables each class is linked to its first document
        if any(left[j] == left[k] or minhash.similarity(sets[j], sets[k]) >= 0.8 for j in left if j < k and j not in gone):
            gone.add(k)
    assert kept == set(left) - gone

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    block = tiling.Benchmark([r.item_id for r in items], [r.text for r in items])
    from pyarrow import array

    found = {sorted(left)[row] for row, *_ in block.search(array([left[k] for k in sorted(left)]))}
    assert {r.doc_id for r in stages["benchmark decontamination"](spark, clean, sf_dir).collect()} == set(left) - found

    scanned = stages["secret scan"](spark, clean, sf_dir)
    assert {r.doc_id for r in scanned.collect()} == set(left) and scanned.columns == docs.columns


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    rows = found.collect()
    assert rows and all(r.taken == r.repeats * r["size"] and 1 <= r.repeats <= 3 for r in rows)
