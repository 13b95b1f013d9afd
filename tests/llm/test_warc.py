import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from passagework.llm import warc
from passagework.session import written

PAGES = [
    (1, "http://a.example/x y\r\nz", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "http://ü.example", ""),
    (4, "u", None),
    (5, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 3),
    (6, "u", "é😀" * 700_000),
    (7, "u", "é😀" * 700_000),
    (None, "u", "<p>one</p>"),
    (None, "u", "only without id"),
    (1, "other", "<p>one</p>"),
    (9, "u", "\r\n\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "x", "x") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, path string").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(pages, least):
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in PAGES:
        raw, of = (h or "").encode(), first.get(h or "")
        of = None if of == i or len(raw) < least else of
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), digest, "response" if of is None else "revisit", of))
    got = [tuple(r) for r in warc.round_trip(pages, least, archive_bytes=100_000).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_members_and_index(pages, folder):
    archives = warc.write_archives(warc.with_originals(pages).coalesce(1), folder).persist()
    whole = gzip.open(archives.first()["path"]).read()
    rows = sorted(warc.normalise(archives).collect(), key=lambda r: r["offset"])
    data = open(rows[0]["path"], "rb").read()
    parts = [gzip.decompress(data[r["offset"] : r["offset"] + r["length"]]) for r in rows]
    assert b"".join(parts) == whole and len(parts) == len(PAGES)
    lines = open(rows[0]["path"] + ".idx").read().splitlines()
    assert [x.split("\t")[:2] for x in lines] == [[str(r["offset"]), str(r["length"])] for r in rows]


def test_archives_are_rewritten_by_several_tasks(spark, folder):
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "repeat(string(id), 50) AS html")
    archives = written(warc.write_archives(warc.with_originals(pages).repartition(4), folder, archive_bytes=1000), "archives")
    rows = warc.normalise(archives).withColumn("task", F.spark_partition_id()).select("path", "task").distinct().collect()
    assert len(rows) == archives.count() > 8
    assert len({r["task"] for r in rows}) > len(rows) / 2


def test_cut_off_streams_are_told():
    import io

    raw = gzip.compress(warc.record(1, "u", b"x" * 100, None)[:-20])
    with pytest.raises(ValueError, match="cut off"):
        list(warc._records(io.BytesIO(raw)))


def test_empty(pages):
    assert warc.round_trip(pages.limit(0)).collect() == []
