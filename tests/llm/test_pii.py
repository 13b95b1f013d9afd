import hashlib
import random
import re

import numpy as np

from passagework.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_plain_patterns():
    draw = random.Random(1)
    cards = ["4532015112830366", "4532 0151 1283 0366", "4532-0151-1283-0367", "6011000990139424"]
    parts = cards + ["@", "a@b", ".com", "a.b-c@d.e.f", "+1 (555) 123-4567", "10.0.0.1", "300.1.1.1.1", "255.", "007.1.2.3", "+", "1", "22", ".", "-", " ", "é", "😀", "x@y.z@w.v"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@a" * 100_000, "1 " * 150_000):
        pii.base_spans(text)
        pii.further_spans(text, [])


def test_table(table, odd_rows):
    token = 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"'
    rows = odd_rows + [(500 + i, f"é😀 mail a{i}@b.com {token} call +1 (555) 123-45{i:02d} or 10.0.0.{i}") for i in range(30)]
    got = pii.personal_spans(table(rows)).withColumn("spans", pii.described(pii.F.col("found"))).collect()
    for r in got:
        text = next((t or "") for i, t in rows if i == r["doc_id"] and (i is not None or True))
        if r["doc_id"] is None:
            continue
        spans = plain(text)
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert r["spans"].startswith(line)
    assert len(got) == len(rows)
    assert all("secret:" in r["spans"] for r in got if r["doc_id"] and r["doc_id"] >= 500)
    clean = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 40]
    assert all(r["spans"] == "" for r in clean)


def test_redaction(table, odd_rows):
    rows = odd_rows + [(500, "call +1 (555) 123-4567 or a@b.com, end"), (501, "nothing here")]
    frame = table(rows)
    got = pii.redact(frame).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == frame.first().asDict().keys()
    by = {r["doc_id"]: r for r in got}
    assert by[500]["text"] == "call <PHONE> or <EMAIL>, end" and by[500]["n_chars"] == len(by[500]["text"])
    assert by[501]["text"] == "nothing here" and by[100]["text"] is None


def test_reliabilities_are_recovered():
    draw = np.random.default_rng(2)
    truth = draw.random(20_000) < 0.3
    right = [0.95, 0.9, 0.85, 0.6, 0.8, 0.9]
    ballots = np.stack([np.where(draw.random(20_000) < r, truth, ~truth) + 1 for r in right], axis=1)
    codes = (ballots * 3 ** np.arange(5, -1, -1)).sum(axis=1)
    kinds, n = np.unique(codes, return_counts=True)
    post, like, prior = pii.reliabilities(pii.unfold(kinds), n)
    assert abs(prior - 0.3) < 0.02
    assert np.abs(like[1, :, 2] - right).max() < 0.04
    told = dict(zip(kinds.tolist(), post > 0.5))
    assert np.mean([told[c] == t for c, t in zip(codes.tolist(), truth)]) > 0.95


def test_empty(empty):
    assert pii.personal_spans(empty).collect() == [] and pii.redact(empty).collect() == []
