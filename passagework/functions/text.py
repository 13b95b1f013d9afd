"""Text clean-up as column expressions; all of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space in Unicode text.
WHITE_SPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)
# The line boundaries of Unicode text; one of two characters leaves a blank line, which is dropped.
LINE_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
# A symbol is neither letter, digit, underscore nor white space.
# What most characters are is turned away before the classes of Unicode are looked up.
SYMBOL_RUN = r"(?U)(?![A-Za-z0-9 ])([^\p{L}\p{N}_\s\x1c-\x1f])\1{3,}+"


def decode_utf8(content: Column) -> Column:
    """Bytes to text; invalid sequences become U+FFFD instead of failing the job."""
    return F.make_valid_utf8(content.cast("string"))


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` knows blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def lint(text: Column) -> Column:
    """Shorten runs of four or more equal symbols to three."""
    return F.regexp_replace(text, SYMBOL_RUN, "$1$1$1")


def lines(text: Column) -> Column:
    """Non-blank lines, stripped, with inner blanks and tabs collapsed."""
    # a blank by itself, as most are, stays without being replaced
    collapsed = F.regexp_replace(text, r" [ \t]++|\t[ \t]*+", " ")
    return F.filter(
        F.transform(F.split(collapsed, LINE_BREAK, -1), strip), lambda line: line != ""
    )
