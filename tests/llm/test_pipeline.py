"""The pipeline end to end, each stage on what its predecessor kept."""

import re

import numpy as np

import corpus_pipeline
from civicflow.llm import decontaminate, near_dedup, pii, quality, queries

SF = "/root/testdata/sf0.001"


def test_queries_are_registered_and_return_their_columns(spark):
    import __spark_entry__

    found = __spark_entry__.queries()
    assert "pipeline" in found and set(queries.QUERIES) <= set(found)
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    # The operators have no SQL form; the README lists them, and all others have SQL.
    assert set(found) - set(__spark_entry__.oracle_sql()) == set(queries.QUERIES) - set(queries.ORACLES) | {"pipeline"}
    want = {"op1": "doc_id start n_tokens ids_crc32", "op4": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
            "op6": "doc_id size text_crc32 law shard slot grown_shard", "op7": "page_id url text n_chars",
            "op9": "doc_id held_out score predicted", "op10": "doc_id held_out score predicted",
            "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
            "op12": "vec_id component n deviation whitened explained identity_error",
            "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"}
    for name, f in queries.QUERIES.items():
        if (short := name.split("_")[0]) in want:
            assert set(want[short].split()) <= set(f(spark, SF).columns)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = spark.createDataFrame(stage(spark, kept, SF).collect() or [], stage(spark, kept, SF).schema)
        if name == "packing":
            break
        after = {r.doc_id: r for r in kept.collect()}
        assert kept.columns == docs.columns
        source = spark.createDataFrame(before, docs.schema)
        if name == "quality":
            score = {r.doc_id: r.score for r in quality.quality(source, labels).collect()}
            assert set(after) == {d for d, s in score.items() if s >= quality.THRESHOLD}
        if name == "near_duplicates":
            classes = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(source).collect()}
            assert set(after) == set(classes.values())
        if name == "decontamination":
            leaked = {r.doc_id for r in decontaminate.leaks(source, items).collect()}
            assert set(after) == {r.doc_id for r in before} - leaked
        if name == "pii":
            assert set(after) == {r.doc_id for r in before}
            assert pii.pii_report(kept).where("spans <> ''").count() == 0
            assert all(r.n_chars == len(r.text) for r in after.values())
            assert not any(re.search(r"[\w.]+@\w+\.\w+", r.text) for r in after.values())
    pieces = kept.collect()
    assert {p.doc_id for p in pieces} == set(after)
    assert all(len(np.frombuffer(p.ids, "<u4")) == p.length for p in pieces)
