import random
import re
from collections import Counter

import numpy as np
import pytest
from made_up import prose, vocabulary
from pyspark.sql import functions as F

from passagework.llm import collocations


def brute(rows, least, top, nested=80):
    """rows: (lang, text). The contract, read plainly."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    counts = {}
    for lang, text in rows:
        mine = counts.setdefault(lang or "und", Counter()) if (text or "") else None
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(upper, lower))):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    mine[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        total = sum(v for p, v in f.items() if len(p) == 1)
        outer = Counter()
        for q, v in ((q, v) for q, v in f.items() if v >= least):
            for i, j in ((i, j) for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q)):
                outer[q[i:j]] = max(outer[q[i:j]], v)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if p in outer and 100 * outer[p] >= nested * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def langs(df):
    return [(r["lang"], r["text"]) for r in df.select("lang", "text").collect()]


def made(spark, n=120):
    draw, words = random.Random(11), vocabulary(25)
    fixed = ["New york City", "as well as", "in the end of it", "end of it"]
    rows = []
    for i in range(n):
        parts = [prose(words, draw.randint(1, 6), draw) if draw.random() < 0.6 else draw.choice(fixed) for _ in range(12)]
        text = "".join(p + draw.choice([" ", " ", "\t", ", ", ".\n", "\x0b", " ? "]) for p in parts)
        rows.append((i, text, draw.choice(["en", "de", None])))
    rows += [(900, None, "en"), (901, "", None), (902, " \t", "xx"), rows[0], rows[0], (903, "one", "fr"), (None, "a b. a b", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("word", F.lit("x")).withColumn("id", F.lit(1))


@pytest.mark.parametrize(("hot", "group", "block"), [(200_000, 1_000_000, 1 << 20), (20, 100, 300), (5, 50, 90)])
def test_equal_to_brute_force(spark, monkeypatch, hot, group, block):
    docs = made(spark).repartition(3)
    plain = collocations.word_blocks
    monkeypatch.setattr(collocations, "word_blocks", lambda d: plain(d, block))
    got = collocations.collocations(docs, top=40, least=4, hot=hot, group=group)
    assert sorted(map(tuple, got.collect())) == brute(langs(docs), 4, 40)


def test_odd_rows(odd):
    got = collocations.collocations(odd, least=2, top=50).collect()
    assert sorted(map(tuple, got)) == brute(langs(odd), 2, 50)


def test_empty(empty):
    assert collocations.collocations(empty).collect() == []


def test_three_way_counts_prefixes():
    draw = np.random.default_rng(3)
    columns = draw.integers(0, 4, (4, 500))
    for d in range(1, 4):
        columns[d] = np.where(columns[d - 1] > 0, columns[d], 0)
    columns = columns[:, columns[1] > 0]
    weight = draw.integers(1, 5, columns.shape[1])
    expected = Counter()
    for row, w in zip(columns.T.tolist(), weight.tolist(), strict=True):
        size = row.index(0) if 0 in row else 4
        for n in range(2, size + 1):
            expected[tuple(row[:n])] += w

    def counts(lead):
        return {tuple(columns[:n, at].tolist()): f for at, n, f in collocations.prefix_counts(columns, weight, lead, 9)}

    none = np.zeros(len(weight), np.int8)
    assert counts(none) == {p: n for p, n in expected.items() if n >= 9}
    assert counts((columns > 0).sum(axis=0)) == expected


def test_large_counts_are_exact(spark):
    often = spark.createDataFrame([(1, 6 * 10**18), (2, 3 * 10**18 + 7)], "number long, f long")
    phrases = spark.createDataFrame([([1, 2], 2, 3 * 10**18)], "words array<long>, size int, f long")
    (row,) = collocations.weakest_cuts(phrases, often).collect()
    assert row["score"] == 2_000_000 * 3 * 10**18 // (9 * 10**18 + 7)
