import random
from collections import defaultdict

import pytest
from xxhash import xxh64_intdigest

from passagework.llm import near_duplicates, simhash
from passagework.llm.graph import components


def fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    """Least member of each component, by brute force."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_whole_table(odd, odd_rows):
    marks = {(i, t): fingerprint(t) for i, t in odd_rows}
    roots = classes(set(marks.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for (i, _), m in marks.items():
        if i is not None:
            least[roots[m]].append(i)
    rows = simhash.simhash_components(odd).collect()
    expected = [(i, marks[i, t], min(least[roots[marks[i, t]]], default=None)) for i, t in odd_rows]
    got = [(r[0], r[1] % (1 << 64), r[2]) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("group", [3, 4096])
def test_links_connect_what_is_near(spark, group):
    draw = random.Random(group)
    marks = set()
    for _ in range(12):
        at = draw.getrandbits(64)
        for _ in range(25):
            marks.add(at)
            for _ in range(draw.randint(1, 4)):
                at ^= 1 << draw.randrange(64)
    frame = spark.createDataFrame([(simhash._signed(m),) for m in marks], "fingerprint long")
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(frame, group=group).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    linked = {frozenset(x) for x in found}
    wanted = classes(marks, lambda a, b: (a ^ b).bit_count() <= 3)
    assert classes(marks, lambda a, b: frozenset((a, b)) in linked) == wanted


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 540)}


def test_empty(empty):
    assert simhash.simhash_components(empty).collect() == []
    assert near_duplicates.without_duplicates(empty).collect() == []


def _shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


@pytest.mark.parametrize("chunk", [16, 2048])
def test_near_duplicates(table, odd_rows, monkeypatch, chunk):
    from made_up import prose, vocabulary

    monkeypatch.setattr(near_duplicates, "CHUNK", chunk)
    draw, words = random.Random(chunk), vocabulary()
    rows = list(odd_rows)
    for i in range(12):
        text = prose(words, draw.randint(80, 300), draw).split()
        for j in range(draw.randint(2, 12)):
            copy = list(text)
            for _ in range(draw.randint(0, 1 + len(text) // 90)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((1000 + 100 * i + j, " ".join(copy)))
    sets = {t or "": _shingles(t) for _, t in rows}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x) and len(x & y) >= 0.8 * len(x | y)

    roots = classes({t or "" for _, t in rows}, linked)
    kept = defaultdict(list)
    for i, t in rows:
        kept[roots[t or ""]].append(float("inf") if i is None else i)
    got = near_duplicates.without_duplicates(table(rows)).collect()
    ids = [float("inf") if r["doc_id"] is None else r["doc_id"] for r in got]
    assert sorted(ids) == sorted(min(x) for x in kept.values())
    assert got[0].asDict().keys() == table(rows[:1]).first().asDict().keys()
