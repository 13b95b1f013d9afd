import math
import random
import re

import numpy as np
import pytest
from made_up import prose, vocabulary

from passagework.llm import rules


def statistics(text):
    text = text or ""
    words, lines, seen = re.findall(r"[^\x20\x09-\x0D]+", text), 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {p for v in windows.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, lines, len(repeated), failed


def test_statistics(table, odd_rows):
    draw = random.Random(2)
    few = ["a", "b", "cc", "#x", "ß|", "d\x0be", "<>"]
    rows = odd_rows + [(200 + i, "".join(draw.choice(few) + draw.choice(" \n\t") for _ in range(90))) for i in range(30)]
    rows += [(300, "same line\nsame line\n\n \n \nsame line "), (301, "a b c d"), (302, "x x x"), (303, "x x x x")]
    got = rules.quality_rules(table(rows)).collect()
    expected = [(i, *statistics(t)) for i, t in rows]
    assert sorted(repr(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))) for r in got) == sorted(map(repr, expected))
    assert all(not r["kept"] for r in got if r["base_failed"])


@pytest.fixture(scope="module")
def judged(table):
    draw, words = random.Random(4), vocabulary()
    rows = [(i, prose(words, int(draw.lognormvariate(5, 0.6)) + 60, draw)) for i in range(500)]
    rows += [(1000 + i, " ".join(f"{w}###" for w in prose(words, 150, draw).split())) for i in range(60)]
    rows += [(2000, prose(words, 9000, draw)), (2001, prose(words, 52, draw))]
    return {r["doc_id"]: r for r in rules.quality_rules(table(rows)).collect()}


def test_outliers_go_and_others_stay(judged):
    assert len(judged) == 562
    assert not any(judged[i]["kept"] for i in range(1000, 1060))
    assert all(judged[i]["kept"] for i in range(500))
    assert judged[2000]["kept"] and judged[2001]["kept"]


def _judge(vectors, near):
    """Robust distances read plainly: medians, concentration steps, scale by the median."""
    names, floors = list(rules.VECTOR), np.array([f for _, f in rules.VECTOR.values()])
    x = np.array([[v[n] for n in names] for v in vectors])
    centre = np.median(x, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(x - centre), axis=0), floors)
    factor = np.diag(spread)

    def distance(rows):
        return (np.linalg.solve(factor, (rows - centre).T) ** 2).sum(axis=0)

    for _ in range(rules.STEPS):
        d = np.floor(np.log(distance(x) + 1e-6) * 16)
        core = x[d <= np.sort(d)[int(np.ceil(rules.CORE * len(d))) - 1]]
        centre = core.mean(axis=0)
        factor = np.linalg.cholesky(np.cov(core.T, bias=True) + np.diag(floors**2))
    middle = np.sort(np.floor(np.log(distance(x) + 1e-6) * 16))[int(np.ceil(0.5 * len(x))) - 1]
    scale = max(1.0, np.exp((middle + 0.5) / 16) / rules.CHI_MEDIAN)
    return distance(np.array([[v[n] for n in names] for v in near])) / scale


def _vector(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words):
    return {
        "size": math.log(n_words), "word": math.log(word_chars / n_words), "symbols": math.log1p(100 * n_symbols / word_chars),
        "lines": math.log1p(20 * n_dup_lines / math.sqrt(n_words)), "repeats": math.log1p(20 * n_repeat_words / n_words),
    }


@pytest.mark.parametrize("rest", ["same", "other"])
def test_rare_sources_are_judged_by_all_of_their_language(spark, rest):
    """Junk of a rare source goes, its clean documents stay; distances as read plainly."""
    draw, words = random.Random(7), vocabulary()
    clean = lambda: prose(words, int(draw.lognormvariate(5, 0.6)) + 60, draw)
    junk = lambda: " ".join(f"{w}###" for w in clean().split())
    lang = {"same": "en", "other": "xx"}[rest]  # of a large language, or of one that is small as a whole
    rows = [(i, clean(), "en", "large") for i in range(500)]
    rows += [(1000 + i, junk(), lang, "rare") for i in range(3)] + [(2000 + i, clean(), lang, "rare") for i in range(3)]
    rows += [(3000, clean(), None, None), (3001, junk(), None, "rare")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in rules.quality_rules(df).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert sorted(i for i, r in got.items() if not r["kept"]) == [1000, 1001, 1002, 3001]
    vectors = {i: _vector(*statistics(t)[:5]) for i, t, *_ in rows}
    large = [i for i in vectors if i < 1000]
    spoken = [i for i, _, x, _ in rows if x == "en"]
    by = {"own": (large, large), "all": (list(vectors), [3000, 3001])}
    by["lang" if rest == "same" else "all"] = (
        (spoken, [i for i in spoken if i >= 1000]) if rest == "same" else (list(vectors), [i for i in vectors if i >= 1000])
    )
    by.setdefault("all", (list(vectors), [3000, 3001]))
    for of, judged in by.values():
        want = _judge([vectors[i] for i in of], [vectors[i] for i in judged])
        assert np.allclose([got[i]["outlier"] for i in judged], want, rtol=0.15, atol=0.3)


def test_empty(empty):
    assert rules.quality_rules(empty).collect() == []


def test_plan_has_no_python(odd):
    plan = rules.quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
