import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from made_up import prose, vocabulary

from passagework.llm import bitslices


def words(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]


def brute(docs, items, top):
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    members, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 25 + (25 * c.total() * members) // total
            score = 0
            for w in words(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * members + 2) / (2 * df[w] + 1)))
                    score += weight * ((10**9 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(map(repr, out))


def made():
    draw, some = random.Random(8), vocabulary(120)
    weights = [1 / (i + 1) for i in range(len(some))]
    docs = []
    for i in range(300):
        text = " ".join(draw.choices(some, weights, k=draw.choice([1, 3, 20, 60, 200])))
        docs.append((i, text.title() if i % 7 == 0 else text.replace(" ", draw.choice([" ", "-", "_", "\n\t"]))))
    items = [(i, " ".join(draw.choices(some, k=draw.randint(1, 15)))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, "nowhere 0"), (92, some[0]), (None, some[5] + " " + some[5])]
    return docs, items


@pytest.mark.parametrize(("room", "query_bytes", "top"), [(4096, 1 << 20, 20), (64, 300, 5), (3, 1 << 20, 20)])
def test_equal_to_brute_force(spark, table, monkeypatch, room, query_bytes, top):
    monkeypatch.setattr(bitslices, "MOST_DOCS", room)
    docs, items = made()
    docs += [(None, docs[5][1]), docs[6], docs[6], (400, None), (401, ""), (402, "...")]
    got = bitslices.ranked_search(
        table(docs).repartition(3), spark.createDataFrame(items, "item_id long, text string"), top, query_bytes
    )
    assert sorted(repr((r[0], r[1], r[2], r[3])) for r in got.collect()) == brute(docs, items, top)


def test_odd_rows(spark, odd, odd_rows):
    items = [(1, odd_rows[0][1][:200]), (2, "Ünï 😀"), (3, "a" * 3000), (4, "")]
    got = bitslices.ranked_search(odd, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == brute(odd_rows, items, 20)


def test_empty(spark, empty, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert bitslices.ranked_search(empty, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []
    assert bitslices.ranked_search(odd, none).collect() == []


def test_bounds_hold_and_exclude():
    docs, items = made()
    block = bitslices._Block(*bitslices.shape(600))
    for i, text in docs:
        block.add(i, text.encode().translate(bitslices.TERMS), Counter(bitslices.terms(text)))
    frequency = Counter(w for _, t in docs for w in set(bitslices.terms(t)))
    queries = bitslices.Queries([(i, t or "") for i, (_, t) in enumerate(items)], frequency, len(docs))
    _, members, tokens, _, packed, _ = block.row(0)
    import zstandard

    slices = np.frombuffer(zstandard.decompress(packed), np.uint64).reshape(-1, -(-len(docs) // 64))
    m = bitslices.mass(np.array([len(bitslices.terms(t)) for _, t in docs]), members, tokens)
    bound = bitslices.upper_bounds(queries, slices, m)
    best = bitslices._Best(queries, len(docs))
    best.score([i for i, _ in docs], [b" ".join(bitslices.terms(t)) for _, t in docs], m, np.arange(len(docs)))
    for q, held in enumerate(best.held):
        assert all(bound[q, d] >= -score for score, _, d in held)
    floors = np.array([-sorted(h)[min(len(h), 5) - 1][0] for h in best.held])
    assert (bound < floors[:, None]).mean() > 0.5  # most are excluded without their texts
