import random

from made_up import prose, vocabulary
from passagework.llm import near_duplicates
from test_simhash import _shingles, classes


def _kept(table, rows):
    return sorted(r["doc_id"] for r in near_duplicates.without_duplicates(table(rows)).collect())


def test_a_repeated_phrase_hides_no_copy(table):
    text = prose(vocabulary(3000), 1000, random.Random(1)).split()
    repeated = text[:500] + text[491:500] * 80 + text[500:]
    rows = [(1, " ".join(text)), (2, " ".join(repeated))]
    assert _kept(table, rows) == [1]


def test_simhash_alone_connects_near_copies(table, monkeypatch):
    """Without any table of samples, copies within three bits are found, and verified, by SimHash."""
    monkeypatch.setattr(near_duplicates, "proposals", lambda met: met.selectExpr("digest AS a", "digest AS b").limit(0))
    monkeypatch.setattr(near_duplicates, "bridges", lambda met, *_: met.selectExpr("digest AS a", "digest AS b").limit(0))
    draw = random.Random(5)
    texts = [prose(vocabulary(3000), 8000, draw).split() for _ in range(4)]
    rows = [(10 * i + k, " ".join(_changed(t, [4500] * k, draw))) for i, t in enumerate(texts) for k in range(2)]
    rows += [(50, ""), (51, " "), (52, None)]
    assert _kept(table, rows) == [0, 10, 20, 30, 50, 51]


def _changed(words, at, draw):
    out = list(words)
    for i in at:
        out[i] = f"new{draw.random()}"
    return out


def test_sets_of_copies_that_are_nearer_inside_than_across(table):
    draw = random.Random(1)
    one = prose(vocabulary(3000), 600, draw).split()
    other = _changed(one, range(20, 540, 65), draw)
    rows = [
        (100 * k + i, " ".join(_changed(x, [300 * k + 15 + 20 * i], draw))) for k, x in enumerate((one, other)) for i in range(12)
    ]
    assert _kept(table, rows) == [0]


def test_pairs_in_groups_of_many_chunks(table, monkeypatch):
    """Texts on one template, each with one copy: most others of a group are near and no copies."""
    monkeypatch.setattr(near_duplicates, "CHUNK", 64)
    draw, words = random.Random(3), vocabulary(3000)
    template, rows = prose(words, 200, draw).split(), []
    for i in range(200):
        shared = template + prose(words, 14, draw).split()
        rows += [(2 * i + k, " ".join(shared + prose(words, 22, draw).split())) for k in range(2)]
    sets = {i: _shingles(t) for i, t in rows}
    roots = classes(set(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert _kept(table, rows) == sorted(set(roots.values()))
