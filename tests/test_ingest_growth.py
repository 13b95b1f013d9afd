"""What a batch of the stream costs: spread before documents are opened, moved only where keys repeat."""

import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from passagework.functions import html, text
from passagework.operators.embed import _TERM, find_terms
from passagework.operators.merge import fold_batch
from passagework.plans.ingestion import IngestSettings
from passagework.sources.chunk_table import ChunkTable
from passagework.sources.raw import fetch_files
from passagework.streaming.ingest import message_files, start_ingest
from test_table_stream import E1, E2, RECORD, Ends


@pytest.fixture
def table(spark, folder):
    found = ChunkTable(spark, f"t_{uuid.uuid4().hex}")
    found.ensure(dim=3, location=folder + "/table")
    return found


def _ingest(spark, folder, table, names, asked):
    for name in names:
        os.makedirs(f"{folder}/store/raw", exist_ok=True)
        with open(f"{folder}/store/raw/{name}", "w") as out:
            out.write(f"Text of {name}.\n" * 30)
    os.makedirs(folder + "/inbox")
    message = {"s3_bucket": "raw", "tenant": "acme"}
    with open(folder + "/inbox/0.json", "w") as out:
        out.writelines(json.dumps(message | {"document_id": n, "s3_key": n}) + "\n" for n in asked)
    spread = []

    def attach(valid):
        spread.append(valid.rdd.getNumPartitions())
        return fetch_files(valid, folder + "/store")

    query = start_ingest(
        message_files(spark, folder + "/inbox", max_files_per_trigger=2),
        attach,
        table,
        IngestSettings(size_tokens=16, overlap_percentage=0.2, target_tokens=50),
        Ends,
        checkpoint=folder + "/checkpoint",
        rejects=folder + "/rejects",
    )
    query.awaitTermination()
    return spread


def test_documents_of_one_message_file_are_opened_by_all_tasks(spark, folder, table):
    names = [f"d{i}" for i in range(40)]
    spread = _ingest(spark, folder, table, names, names)
    assert spread == [spark.sparkContext.defaultParallelism]
    assert {r[0] for r in table.read().select("document_id").distinct().collect()} == set(names)


def test_chunks_of_distinct_documents_are_not_shuffled(spark, folder, table, monkeypatch):
    said = []
    upsert = ChunkTable.upsert
    monkeypatch.setattr(ChunkTable, "upsert", lambda self, chunks, **k: said.append(k) or upsert(self, chunks, **k))
    _ingest(spark, folder, table, ["a", "b"], ["a", "b"])
    assert said == [{"distinct": True}]
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()


def test_a_document_that_comes_twice_is_folded(spark, folder, table):
    _ingest(spark, folder, table, ["a", "b"], ["a", "b", "a"])
    keys = [r[0] for r in spark.table(table.name).select("chunk_id").collect()]
    assert len(keys) == len(set(keys)) and {k.split(":")[0] for k in keys} == {"a", "b"}


def _plain(row):
    return None if row is None else {c: (list(v) if c == "embedding" else v) for c, v in row.asDict().items()}


def test_few_repeated_keys_are_folded_apart_with_the_same_result(spark, table):
    rows = [(i, f"k{i}", "D", "acme", "10-K", 1, i, 6, 0, f"text {i}", E1, {"x": str(i)} if i % 3 else None) for i in range(60)]
    rows += [(99, "k7", "D", "globex", None, 1, 7, 6, 0, None, E2, {"y": "2"})]
    rows += [(s, None, "N", "acme", None, 1, 0, 6, 0, f"null {s}", E1, {"z": "1"}) for s in (1, 2)]
    rows += [(None, "late", "L", "acme", None, 1, 0, 6, 0, "no order", E1, {"z": "1"})]
    batch = spark.createDataFrame(rows, RECORD)
    want = {r["chunk_id"]: _plain(r) for r in fold_batch(batch).collect()}
    assert table.upsert(batch) == 64
    appended = spark.table(table.name).select(list(next(iter(want.values())))).collect()
    assert len(appended) == len(want) == 62
    assert {r["chunk_id"]: _plain(r) for r in appended} == want
    # read again: the few keys of two versions are resolved, the others pass
    table.upsert(spark.createDataFrame([(0, "k3", "D", "new", None, 1, 3, 6, 0, "again", E2, {"q": "9"})], RECORD))
    got = {r["chunk_id"]: _plain(r) for r in table.read().collect()}
    assert got.pop("k3")["metadata"] == {"q": "9"}
    want.pop("k3")
    assert got == want


def test_a_bad_chunk_of_distinct_ones_writes_nothing(spark, table):
    rows = [(0, f"k{i}", "D", "acme", "10-K", 1, i, 6, 0, "t", E1 if i else None, {}) for i in range(9)]
    with pytest.raises(Exception, match="chunk k0 has no embedding"):
        table.upsert(spark.createDataFrame(rows, RECORD).repartition(4), distinct=True)
    assert table.read().count() == 0
    assert table.upsert(spark.createDataFrame([], RECORD), distinct=True) == 0
    assert table.upsert(spark.createDataFrame(rows[1:], RECORD), distinct=True) == 8 == table.read().count()


def test_terms_are_those_of_the_pattern():
    rng = random.Random(3)
    odd = [*map(chr, range(0x250)), *"Σ 　一٠Ⅰͅ​", chr(0x1F600), chr(0x10400)]
    pool = odd + list("aB9 _.-\n ") * 60
    for n in range(120):
        texts = ["".join(rng.choices(pool, k=rng.randint(0, 50))) for _ in range(rng.randint(1, 9))]
        if n % 3 == 0:
            texts = ["".join(c for c in t if c.isascii()) for t in texts]
        terms, of = find_terms(texts)
        want = [(i, term) for i, t in enumerate(texts) for term in _TERM.findall(t)]
        assert list(zip(of.tolist(), terms.to_pylist(), strict=True)) == want


def test_lines_and_sniff_as_before(spark):
    rng = random.Random(4)
    parts = [" ", "  ", "\t", " \t ", "\t\t", "\r\n", "\n", "\r", "\x0b", "\x85", " ", " ", "a", "bc", "--", "=====", "~~~~", "<", "<DIV", "<html"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "i int, t string")
    collapsed = F.regexp_replace(F.regexp_replace("t", r"(?U)([^\p{L}\p{N}_\s\x1c-\x1f])\1{3,}+", "$1$1$1"), r"[ \t]+", " ")
    cut = F.split(collapsed, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]", -1)
    lined = F.filter(F.transform(cut, text.strip), lambda line: line != "")
    sniffed = F.contains(F.lower("t"), F.lit("<html")) | F.contains(F.lower("t"), F.lit("<div"))
    got = df.select(
        text.lines(text.lint(F.col("t"))).eqNullSafe(lined).alias("lines"), html.is_html(F.col("t")).eqNullSafe(sniffed).alias("html")
    )
    assert {tuple(r) for r in got.collect()} == {(True, True)}
