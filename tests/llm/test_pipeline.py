"""The pipeline's stages by their contracts, and its registration."""

import hashlib

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.helpers import words
from tests.llm.test_ops import cut_repeats, near_groups
from tokenloom.llm import quality

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    benchmark = [words(r.text.lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == columns and after.schema == docs.schema
        found = {r.doc_id: r.text for r in after.collect()}
        if name == "quality rules":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            kept = quality.score(docs, quality.trusted_ids(labels)).where("kept").collect()
            want = {r.doc_id: held[r.doc_id] for r in kept}
        elif name == "MinHash near-dedup":
            want = {i: held[i] for i, _, _, kept in near_groups(sorted(held.items()), 5, 80) if kept}
        elif name == "suffix-array dedup":
            cut = cut_repeats([t.encode() for t in held.values()], 200)
            want = {i: c[3].decode("utf-8", "ignore") for i, c in zip(held, cut)}
        else:
            text = {i: " " + " ".join(words(t.lower())) + " " for i, t in held.items()}
            exact = {i for i in held if any(" " + " ".join(b) + " " in text[i] for b in benchmark if len(b) >= 8)}
            assert exact.isdisjoint(found) and set(found) <= set(held)
            want = {i: held[i] for i in found}
        assert found == want, name
        docs, held = spark.createDataFrame(after.collect(), docs.schema), found
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id: hashlib.md5(r.decoded).hexdigest() for r in last} == {i: hashlib.md5(t.encode()).hexdigest() for i, t in held.items()}


def test_all_queries_are_registered():
    found = entry_points.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert "pipeline" in found
    assert set(entry_points.oracle_sql()) <= set(found)
