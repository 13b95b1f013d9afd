import random
import re

from passagework.llm import licences


def test_statistics_are_longest_matches():
    draw = random.Random(1)
    templates = [[draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(1, 25))] for _ in range(5)]
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    automaton = licences.SuffixAutomaton(templates)
    for _ in range(200):
        words = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(draw.randint(0, 30))]
        longest = [max((n for n in range(i + 2) if tuple(words[i + 1 - n : i + 1]) in runs), default=0) for i in range(len(words))]
        want = [(i, n) for i, n in enumerate(longest) if n and (i + 1 == len(words) or longest[i + 1] <= n)]
        assert [(i, n) for i, n, _ in automaton.statistics(words)] == want


def _random_templates(draw):
    return [("t%d" % n, " ".join(draw.choice("abc") for _ in range(draw.randint(4, 14)))) for n in range(3)]


def _matches(words, template):
    """Every pair of places, as long as it goes, by definition."""
    out = []
    for i in range(len(words)):
        for a in range(len(template)):
            if i and a and words[i - 1] == template[a - 1]:
                continue
            n = 0
            while i + n < len(words) and a + n < len(template) and words[i + n] == template[a + n]:
                n += 1
            if n >= licences.MIN_MATCH:
                out.append((i, a, n))
    return sorted(out)


def _most(found):
    """Most words that any chain covers, by trying every chain."""

    def longer(last, covered):
        best = covered
        i, a, n = last
        for j, b, m in found:
            if j > i and b > a and j + m > i + n and b + m > a + n and j - (i + n) <= licences.GAP:
                best = max(best, longer((j, b, m), covered + m - max(0, i + n - j, a + n - b)))
        return best

    return max((longer(x, x[2]) for x in found), default=0)


def test_matches_and_chains_equal_brute_force():
    draw = random.Random(7)
    some = 0
    for _ in range(60):
        templates = _random_templates(draw)
        scanner = licences.Scanner(templates)
        words = [draw.choice([b"a", b"b", b"c", b"c", b"d"]) for _ in range(draw.randint(0, 40))]
        for t, at in ((0, 0), (1, 2)):
            part = scanner.words[t][at:]
            words += [w for w in part if draw.random() < 0.9]
        got = scanner.matches(words)
        best = {c.template: 0 for c in scanner.chains(words)}
        for c in scanner.chains(words):
            best[c.template] = max(best[c.template], c.words)
            assert c.share == c.words / len(scanner.words[c.template])
        for t, template in enumerate(scanner.words):
            want = _matches(words, template)
            assert sorted(map(tuple, got.get(t, []))) == want
            assert best.get(t, 0) == _most(want)
            some += len(want) > 1
    assert some > 20


def test_match_of_another_template_at_the_same_word():
    scanner = licences.Scanner((("one", "a b c d e f g h"), ("two", "e f g h x"), ("three", "c d e f z z z z")))
    spans = {(c.template, c.words, c.start, c.end) for c in scanner.chains(licences.file_words("a b c d e f g h y"))}
    assert spans == {(0, 8, 0, 8), (1, 4, 4, 8), (2, 4, 2, 6)}


def test_labels_of_whole_and_later_parts():
    parts = {}
    for label, words in licences.TEMPLATES:
        parts.setdefault(label, []).append(words)
    scanner = licences.Scanner()
    labels = {label: scanner.scan("\n\n".join(texts))[5] for label, texts in parts.items()}
    assert {k: v for k, v in labels.items() if v != k} == {}
    for label, words in licences.TEMPLATES:  # each part alone, in capitals and with punctuation
        assert label in scanner.scan("// " + words.upper().replace(" ", ", "))[5].split(",")


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_and_covered_spans(table, odd_rows):
    draw = random.Random(3)
    few = ["GNU", "General", "Public", "License", "MIT", "CC", "BY", "Apache", "x", "gnu.general"]
    rows = odd_rows + [(500 + i, "".join(draw.choice(few) + draw.choice([" ", "-", "\n"]) for _ in range(80))) for i in range(40)]
    bsd = next(words for label, words in licences.TEMPLATES if label == "bsd").split()
    rows += [(900, "x y " + " ".join(bsd)), (901, " ".join(bsd[:9] + ["odd", "words"] + bsd[9:])), (902, " ".join(bsd[:5]))]
    got = licences.licence_scan(table(rows)).collect()
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(repr(tuple(r[c] for c in names)) for r in got) == sorted(repr((i, *base(t))) for i, t in rows)
    by = {r["doc_id"]: r for r in got}
    assert by[900]["labels"] == by[901]["labels"] == "bsd" and by[902]["labels"] == ""
    assert [tuple(s) for s in by[900]["spans"]] == [("bsd", 2, 2 + len(bsd))]
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got)


def test_empty(empty):
    assert licences.licence_scan(empty).collect() == []
