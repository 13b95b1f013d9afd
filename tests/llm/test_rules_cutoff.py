import random

from made_up import prose, vocabulary
from passagework.llm import rules


def test_repeats_and_symbols_within_the_base_rules_can_reject(table):
    draw, words = random.Random(6), vocabulary()
    rows = [(i, prose(words, int(draw.lognormvariate(5, 0.6)) + 60, draw)) for i in range(500)]
    for i in range(40):
        phrase = prose(words, 7, draw)
        rows.append((1000 + i, f"{prose(words, 130, draw)} {' '.join([phrase] * 10)}"))
        marked = prose(words, 200, draw).split()
        for at in range(0, 200, 5):
            marked[at] += "#"
        rows.append((2000 + i, " ".join(marked)))
    got = {r["doc_id"]: r for r in rules.quality_rules(table(rows)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert sum(r["kept"] for i, r in got.items() if i < 1000) == 500
    assert sum(r["kept"] for i, r in got.items() if i >= 1000) == 0
