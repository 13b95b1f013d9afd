import hashlib
import random
import re

import pytest

from passagework.llm import decontaminate as decontaminate_module
from passagework.llm.decontaminate import decontaminate

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(LETTERS, (text or "").translate(LOWER))


def brute(rows, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = []
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[p : p + size]))) is not None:
                    hit |= set(range(p, p + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("window", [1, 3, 10])
def test_random_texts(spark, table, window):
    draw = random.Random(window)
    few = ["The", "the", "a", "É", "é", "x1", "of", "cat", "dog"]
    gaps = [" ", ", ", ".\n", "-"]

    def text(n):
        return "".join(draw.choice(few) + draw.choice(gaps) for _ in range(n))

    items = [(i, text(draw.choice([0, 1, 2, 5, 14, 20]))) for i in range(15)] + [(50, None), (51, "..."), (7, text(12))]
    rows = [(i, text(draw.randint(0, 40)) + (draw.choice(items)[1] or "") + text(3)) for i in range(60)]
    rows += [(90, None), (91, ""), (92, "§ ' "), rows[0], rows[0], (None, rows[1][1]), (93, rows[1][1]), (0, text(30))]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(table(rows), frame, window).drop("text_key").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, items, window)


def test_long_and_odd_texts(spark, odd, odd_rows):
    items = [(1, " ".join(odd_rows[2][1].split()[10:25])), (2, "Ünï 😀 x")]
    got = decontaminate(odd, spark.createDataFrame(items, "item_id long, text string")).drop("text_key").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(odd_rows, items, 10)
    assert sum(r["contaminated"] for r in got) >= 4


def test_empty(spark, odd, odd_rows, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate(odd, none).collect())
    assert decontaminate(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def near_brute(rows, items, window):
    """Two edits a window: every place of every window, by the definition alone."""
    windows, out = {}, []
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for t, held in windows.items():
            n, places = len(t), set()
            for p in range(-n, len(w)):
                def at(j, p=p):
                    return w[p + j] if 0 <= p + j < len(w) else None

                led = any(all(at(o + k) == t[o + k] for k in range(3)) for o in (0, n // 3, 2 * n // 3)) if n >= 9 else False
                alike = sum(any(at(o + k) == x for k in range(-2, 3)) for o, x in enumerate(t))
                if all(at(o) == x for o, x in enumerate(t)) or (led and alike >= n - 2):
                    places.add(p)
            if places:
                names |= held
                hit |= {p + o for p in places for o in range(n) if 0 <= p + o < len(w)}
        out.append((i, len(hit), len(names)))
    return sorted(map(repr, out))


def edited(draw, text, few):
    """The words of a text with one or two edits in every ten or so."""
    w = words(text)
    for p in range(len(w) - 1, -1, -1):
        if draw.random() < 0.15:
            w[p : p + draw.choice([0, 1, 1])] = draw.choice([[], [draw.choice(few)], ["new"]])
    return " ".join(w)


@pytest.mark.parametrize("window, lead_bytes", [(9, 1 << 25), (10, 20_000), (13, 1 << 25)])
def test_proximity(spark, table, monkeypatch, window, lead_bytes):
    monkeypatch.setattr(decontaminate_module, "LEAD_BYTES", lead_bytes)
    draw = random.Random(window)
    few = ["The", "a", "É", "x1", "of", "cat", "dog", "tree", "one", "two"]
    many = few + [f"w{i}" for i in range(30)]

    def text(n, among):
        return " ".join(draw.choice(among) for _ in range(n))

    items = [(i, text(draw.choice([0, 2, 8, 9, 10, 25]), draw.choice([few, many]))) for i in range(12)] + [(50, None), (51, "")]
    rows = [(i, f"{text(draw.randint(0, 12), few)} {edited(draw, draw.choice(items)[1], few)} {text(draw.randint(0, 9), few)}") for i in range(60)]
    rows += [(90, None), (91, ""), (None, rows[1][1]), rows[0], (92, items[11][1] or "cat")]
    got = decontaminate(table(rows), spark.createDataFrame(items, "item_id long, text string"), window, proximity=True)
    got = got.select("doc_id", "n_near", "n_near_items", "n_hit").collect()
    assert sorted(repr(tuple(r)[:3]) for r in got) == near_brute(rows, items, window)
    assert any(r["n_near"] and not r["n_hit"] for r in got) and all(r["n_near"] >= r["n_hit"] for r in got)


def test_every_two_edits_are_found(spark, table):
    """One word changed, put in or left out in each half of a window, at every place."""
    item = [f"w{i}" for i in range(10)]
    rows = []
    for p in range(10):
        for q in range(p):
            for low, high in (([], []), (["x"], ["y"]), ([item[q], "x"], [item[p], "y"]), ([], [item[p], "y"])):
                w = item[:q] + low + item[q + 1 : p] + high + item[p + 1 :]
                rows.append((len(rows), "before " + " ".join(w) + " after"))
    found = decontaminate(table(rows), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), proximity=True)
    assert found.where("n_near_items = 1").count() == len(rows) == 180
    two = table([(1, "before " + " ".join(item[:2] + ["x", "y", "z"] + item[5:]) + " after")])
    assert two.count() == decontaminate(two, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), proximity=True).where("n_near = 0").count()


def test_proximity_of_nothing(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["n_near"] or r["n_near_items"] for r in decontaminate(odd, none, proximity=True).collect())
    assert decontaminate(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string"), proximity=True).collect() == []
