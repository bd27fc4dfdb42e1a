"""The pipeline: every stage beside brute force over what its predecessor kept."""

from collections import Counter

import pytest

import corpus_pipeline
from tillcast.llm import mixing, packing

from conftest_llm import SF, CLASHES
from test_dedup import bare, brute_components, brute_fingerprint
from test_text_operators import brute_counts, check_packing


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into each stage, and what the last returns."""
    folder = tmp_path_factory.mktemp("stages")
    sf = SF.replace("0.001", "0.01")
    docs, frames = spark.read.parquet(f"{sf}/documents.parquet"), []
    frames.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        frames.append(docs)
    return frames


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "simhash_near_dedup", "soft_mixing", "vector_best_fit",
    ]


def test_columns_stay_until_the_last_stage(steps):
    assert all(f.columns == steps[0].columns for f in steps[:-1])
    # Rows that stay are unchanged.
    before = {tuple(r) for r in steps[0].collect()}
    assert all({tuple(r) for r in f.collect()} <= before for f in steps[1:-1])


def test_quality_stage(steps):
    rows = steps[0].collect()
    failed = {r.doc_id for r in rows for c in [brute_counts(r.text)] if c[0] < 50 or 100 * c[4] > 50 * c[0]}
    assert {r.doc_id for r in steps[1].collect()} == {r.doc_id for r in rows} - failed  # no line is above its limit here


def test_exact_dedup_stage(steps):
    best = {}
    for r in steps[1].collect():
        key = bare(r.text)
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(d for _, d in best.values())


def test_near_dedup_stage(steps):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in steps[2].collect()}
    keys = sorted(set(prints.values()))
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if (a ^ b).bit_count() <= 2]
    root = brute_components(keys, links)
    first = {}
    for doc_id, p in prints.items():
        first[root[p]] = min(doc_id, first.get(root[p], doc_id))
    assert {r.doc_id for r in steps[3].collect()} == set(first.values())


def test_mixing_stage_takes_no_document_twice(spark, steps):
    before, after = steps[3], Counter(r.doc_id for r in steps[4].collect())
    assert max(after.values()) == 1
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    copies = mixing.mixture(before, labels, most=1.0).filter("copies > 0").select("doc_id")
    assert set(after) == {r.doc_id for r in copies.collect()}
    # Clean documents stay, toxic ones are thinned out.
    domain = {r.doc_id: r.domain for r in labels.withColumn("domain", mixing.domain()).collect()}
    share = {}
    for name in ("clean", "toxic"):
        own = [r.doc_id for r in before.select("doc_id").collect() if domain.get(r.doc_id) == name]
        share[name] = sum(d in after for d in own) / len(own)
    assert share["clean"] > 0.9 > 0.5 > share["toxic"]


def test_packing_stage(steps):
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    packed = steps[5].collect()
    tokens = sum(r.length for r in packed)
    assert check_packing(packed, texts, packing.LENGTH) <= 1.01 * tokens / packing.LENGTH + 2


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in rows} == {
        (r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.packing_stage(spark, docs, SF).collect()
    }


def test_stages_on_edges(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (edge_docs, no_docs):
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert name == "vector_best_fit" or set(CLASHES) <= set(out.columns)
            assert docs is edge_docs or not rows
