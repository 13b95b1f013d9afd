import random
import re
import sys
import unicodedata
from itertools import groupby

from pyspark.sql import functions as F

from passagework.functions import text


def _apply(spark, values, *columns):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, t string").select("i", *columns)
    return [tuple(r)[1:] for r in sorted(df.collect())]


def shortened(value):
    """Runs of one symbol keep three at most; letters, digits, the underscore and white space keep all."""
    runs = ((c, len(list(run))) for c, run in groupby(value))
    return "".join(c * (n if c.isalnum() or c == "_" or c.isspace() else min(n, 3)) for c, n in runs)


def test_strip_knows_every_white_space(spark):
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    spaces = {c for c in points if chr(c).isspace()}
    assert {ord(c) for c in text.WHITE_SPACE} == spaces
    values = [chr(c) + "a" + chr(c) + "b" + chr(c) for c in sorted(spaces)]
    got = _apply(spark, values, text.strip(F.col("t")))
    assert [g for (g,) in got] == [v.strip() for v in values]


def test_lint_shortens_runs_of_symbols_only(spark):
    cases = {
        "Item 1. Business" + "." * 40 + "5": "Item 1. Business...5",
        "---": "---",
        "----": "---",
        "====..": "===..",
        "____": "____",
        "aaaaaa 111111": "aaaaaa 111111",
        "$$$$$": "$$$",
        "…………": "………",
        "—" * 9: "—" * 3,
        "ééééé": "ééééé",
        "....\n....": "...\n...",
        "\x1c\x1c\x1c\x1c\x1c": "\x1c\x1c\x1c\x1c\x1c",
        "\xa0\xa0\xa0\xa0\xa0": "\xa0\xa0\xa0\xa0\xa0",
        "": "",
    }
    got = _apply(spark, list(cases), text.lint(F.col("t")))
    assert [g for (g,) in got] == list(cases.values())


def test_lint_agrees_with_word_and_space_classes(spark):
    # code points of an early Unicode version, which the JVM surely knows
    known = unicodedata.ucd_3_2_0
    points = [c for c in range(1, 0x3000) if known.category(chr(c)) not in ("Cn", "Cs")]
    values = [chr(c) * 5 for c in points]
    want = [shortened(v) for v in values]
    got = [g for (g,) in _apply(spark, values, text.lint(F.col("t")))]
    assert [hex(p) for p, g, w in zip(points, got, want, strict=True) if g != w] == []


def test_lines_agree_with_sequential_rule(spark):
    rng = random.Random(5)
    alphabet = "ab  \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  é."
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    want = [
        [s for s in (re.sub(r"[ \t]+", " ", x).strip() for x in v.splitlines()) if s]
        for v in values
    ]
    got = _apply(spark, values, text.lines(F.col("t")))
    assert [g for (g,) in got] == want


def test_decode_replaces_invalid_bytes(spark):
    values = [b"plain", b"a\xffb", b"\xe2\x82", b"\xc3\xa9", b"\xf0\x9f\x98", b"\x80\x80", b""]
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, b binary")
    got = df.select("i", text.decode_utf8(F.col("b"))).orderBy("i").collect()
    assert [r[1] for r in got] == [v.decode("utf-8", errors="replace") for v in values]
