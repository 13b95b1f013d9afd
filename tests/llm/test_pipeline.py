import re
from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from passagework.session import written

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "test-stage")
        out.append((name, docs))
    return out


def test_stages_keep_columns_and_only_drop(stages):
    for (_, before), (name, after) in zip(stages, stages[1:-1], strict=False):
        assert after.columns == before.columns, name
        old = {r["doc_id"]: r for r in before.collect()}
        new = after.collect()
        assert new and {r["doc_id"] for r in new} <= old.keys(), name
        if name != "pii":
            assert all(r == old[r["doc_id"]] for r in new), name
        else:
            assert len(new) == len(old)


def test_results_are_clean(stages):
    from test_decontaminate import words
    from test_rules import statistics
    from test_simhash import _shingles

    held = {name: [r["text"] for r in frame.collect()] for name, frame in stages[:-1]}
    assert not any(statistics(t)[-1] for t in held["quality_rules"])
    sets = [_shingles(t) for t in held["simhash_near_dedup"]]
    assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    spark = stages[0][1].sparkSession
    items = [words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    for text in held["benchmark_decontamination"]:
        w = words(text)
        assert not any(tuple(w[i : i + 10]) in windows for i in range(len(w)))
    assert not any(re.search(r"@[A-Za-z0-9-]+\.[A-Za-z]", t) for t in held["pii"])


def test_packing_is_gapless_and_run_gives_the_same(spark, stages):
    places = defaultdict(list)
    for r in stages[-1][1].collect():
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, FOLDER).select(columns).collect()
    assert sorted(run) == sorted(stages[-1][1].select(columns).collect())


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_stages_keep_columns_that_clash_and_empty_tables(spark, stage):
    clashing = ["_key", "_digest", "_found", "_d", "_k", "_g", "__key", "found", "text_key"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    full = written(docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in clashing}), "test-clash")
    plain = written(stage[1](spark, written(full.select(docs.columns), "test-plain"), FOLDER), "test-stage")
    got = written(stage[1](spark, full, FOLDER), "test-stage")
    assert got.columns == full.columns
    assert sorted(map(repr, got.select(docs.columns).collect())) == sorted(map(repr, plain.collect()))
    assert all(r[c] == f"{c}{r['doc_id']}" for r in got.collect() for c in clashing)
    none = stage[1](spark, written(full.limit(0), "test-none"), FOLDER)
    assert none.columns == full.columns and none.collect() == []
