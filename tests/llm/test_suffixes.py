import hashlib
import random
from collections import Counter

import pytest
from made_up import prose, vocabulary

from passagework.llm import suffixes


def brute(rows, length):
    codes = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(c[p : p + length] for _, c in codes for p in range(len(c) - length + 1))
    out = []
    for i, c in codes:
        gone = bytearray(len(c))
        for p in range(len(c) - length + 1):
            if seen[c[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        spans = sum(1 for p in range(len(c)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(x for x, g in zip(c, gone) if not g)
        out.append((i, len(c), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def test_whole_table(odd, odd_rows):
    assert sorted(repr(tuple(r)[:5]) for r in suffixes.remove_repeats(odd).collect()) == brute(odd_rows, 400)


@pytest.mark.parametrize(("seed", "group"), [(1, 50_000), (2, 50_000), (3, 4)])
def test_small_alphabets(table, monkeypatch, seed, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "BATCH", min(group // 2, 64))
    draw = random.Random(seed)
    passage = "".join(draw.choice("abcd") for _ in range(35))
    rows = []
    for i in range(60):
        text = "".join(draw.choice("ab" if i % 5 == 0 else "abcdé") for _ in range(draw.randint(0, 120)))
        if i % 2:
            at = draw.randint(0, len(text))
            text = text[:at] + passage[draw.randint(0, 6) : 35 - draw.randint(0, 6)] + text[at:]
        rows.append((i, text))
    rows += [(90, "xy" * 50), (91, "z" * 80), (92, rows[4][1]), (93, None)]
    got = suffixes.remove_repeats(table(rows).repartition(3), length=20, anchor=6).collect()
    assert sorted(repr(tuple(r)[:5]) for r in got) == brute(rows, 20)


def test_texts_longer_than_a_slice(table, monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 200)
    draw = random.Random(9)
    text = "".join(draw.choice("abcdefgh") for _ in range(1500))
    rows = [(1, text), (2, text[300:900]), (3, "q" * 10)]
    got = suffixes.remove_repeats(table(rows), length=40, anchor=12).collect()
    assert sorted(repr(tuple(r)[:5]) for r in got) == brute(rows, 40)


def test_short_passages_of_many_words_are_told(table, odd, odd_rows):
    draw, words = random.Random(4), vocabulary(5000)
    text = lambda n: prose(words, n, draw)
    passage, short, tiny = text(51).split(), text(39), " ".join(f"{c}{k}" for k in range(11) for c in "abcde")
    rows = [(i, f"{text(80)} {' '.join(passage)}\n{text(i)}") for i in range(12)]
    rows += [(100 + i, f"{text(60)} {short} {text(30)}") for i in range(12)] + [(200 + i, text(120)) for i in range(12)]
    rows += [(300, f"{text(70)} {tiny}"), (301, f"{tiny}\t{text(70)}"), (302, None), (303, "x")]
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(table(rows).repartition(3)).collect()}
    assert {i for i, r in got.items() if r["shares_passage"]} == {*range(12), 300, 301}
    assert any(not r["n_removed"] for i, r in got.items() if i < 12) and not got[300]["n_removed"]
    windows = Counter()
    for _, t in odd_rows:
        w = (t or "").split()
        windows.update(tuple(w[p : p + 51]) for p in range(len(w) - 50))
    for r in suffixes.remove_repeats(odd).collect():
        if r["shares_passage"] and not r["n_removed"]:
            assert r["n_bytes"] >= 40
    texts = {(t or "").encode(): t for _, t in odd_rows}
    shared = {t for t in texts.values() if any(windows[tuple((t or "").split()[p : p + 51])] > 1 for p in range(len((t or "").split()) - 50))}
    told = {r["doc_id"] for r in suffixes.remove_repeats(odd).collect() if r["shares_passage"]}
    assert {i for i, t in odd_rows if t in shared} <= told


def test_any_51_words_leave_a_mark():
    draw, words = random.Random(5), vocabulary(60)
    passage = prose(words, 51, draw)
    codes = [f"{prose(words, draw.randint(0, 50), draw)} {passage} {prose(words, draw.randint(0, 50), draw)}".encode() for _ in range(30)]
    doc, mark = suffixes.word_marks(codes)
    sets = [set(mark[doc == i].tolist()) for i in range(30)]
    assert all(a & b for a in sets for b in sets)
    assert all(len(suffixes.word_marks([c])[0]) == len(mark[doc == i]) for i, c in enumerate(codes))


def test_empty(empty):
    assert suffixes.remove_repeats(empty).collect() == []
