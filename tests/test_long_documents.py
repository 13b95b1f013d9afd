"""Documents cut by pieces have the sections they have when cut whole."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagework.operators import long_documents
from passagework.operators.chunk import chunk_pages
from passagework.operators.long_documents import _piece_map, body_lines, file_lines, long_sections
from passagework.operators.parse import split_sections

MADE = ["", "   ", "one", "two words", "......", "a, b; c! (d)", "x\ty  z", "left\rright", "end\x0c", "é 😀   next"]


def made(seed, n):
    draw = random.Random(seed)
    return "\n".join(draw.choice(MADE) * draw.choice([1, 1, 2]) for _ in range(n))


def rows(df):
    return sorted(map(repr, map(tuple, df.select("document_id", "page_number", "text").collect())))


def folded(counts, target, tokens):
    closed = 0
    for c in counts:
        tokens += c
        if tokens >= target:
            tokens, closed = 0, closed + 1
    return tokens, closed


@pytest.mark.parametrize("target", [0, 1, 2, 7, 30])
def test_map_of_a_piece(target):
    draw = random.Random(target)
    for n in (0, 1, 2, 5, 40):
        counts = [draw.choice([0, 0, 1, 2, 3, 9, 50]) for _ in range(n)]
        tokens, closed = _piece_map(np.array(counts, dtype=np.int64), target)
        for before in range(max(1, target)):
            assert (tokens[before], closed[before]) == folded(counts, target, before)


@pytest.mark.parametrize("target, piece, fan", [(1, 3, 2), (5, 1, 2), (13, 4, 3), (40, 2, 64), (500, 7, 2)])
def test_equal_to_whole_documents(spark, monkeypatch, target, piece, fan):
    monkeypatch.setattr(long_documents, "FAN", fan)
    texts = [(str(i), made(i, n)) for i, n in enumerate([0, 1, 2, 3, 17, 60, 150])]
    texts += [("none", None), ("blank", "\n\n \n"), (None, made(9, 30)), ("one", "word " * 700), ("ends", "a b c\n" * 40)]
    docs = spark.createDataFrame(texts, "document_id string, body string")
    got = long_sections(body_lines(docs), target, piece_lines=piece)
    assert rows(got) == rows(split_sections(docs, target_tokens=target))


def test_of_nothing(spark):
    docs = spark.createDataFrame([], "document_id string, body string")
    assert long_sections(body_lines(docs)).collect() == []
    lines = spark.createDataFrame([("d", 0, 0, None), ("d", 0, 1, "a"), ("d", 0, 2, None)], "document_id string, block long, at long, line string")
    assert rows(long_sections(lines)) == [repr(("d", 1, "a"))]


def test_one_long_file(spark, folder):
    """Read as blocks by several tasks; sections and windows are those of the whole text."""
    path = os.path.join(folder, "long.txt")
    draw = random.Random(4)
    with open(path, "wb") as out:
        for i in range(20_000):
            out.write(f"{i} {draw.choice(MADE)} ".encode() + draw.choice([b"\n", b"\r\n", b"\xff\n", b"\n\n"]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        lines = file_lines(spark, path)
        assert lines.select("block").distinct().count() > 4
        assert lines.select(F.spark_partition_id()).distinct().count() > 1
        got = long_sections(lines, 50, piece_lines=100).cache()
        whole = (
            spark.read.format("binaryFile").load(path)
            .select(F.col("path").alias("i"), F.make_valid_utf8(F.col("content").cast("string")).alias("body"))
            .join(lines.select("document_id").distinct())  # one file
            .select("document_id", "body")
        )
        want = split_sections(whole, target_tokens=50)
        assert rows(got) == rows(want)
        assert got.count() > 500
        cut, cut_whole = (chunk_pages(x, 16, 0.25).select("chunk_id", "token_count", "text").collect() for x in (got, want))
        assert sorted(map(tuple, cut)) == sorted(map(tuple, cut_whole))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
