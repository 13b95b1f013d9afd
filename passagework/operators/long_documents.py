"""Sections of documents that are too long for one row.

A section closes when its tokens reach a target, and counting starts again: where the
sections of a document lie depends on all lines before. But what a piece of lines does
is a small map, from the tokens of the section that is open before it to those after it
and the number of sections closed. Maps of consecutive pieces compose, so they are
composed group by group up a tree, and the counts each piece begins with come back
down. Then every piece cuts its own lines. No row holds more than a piece or a section.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passagework.functions import text
from passagework.functions.arrays import let
from passagework.functions.tokens import PatternTokenizer
from passagework.operators.parse import SECTION_TARGET_TOKENS, cut_sections, section_ends
from passagework.session import written

#: Lines of a piece, and pieces (or groups of them) of a group in the tree.
PIECE_LINES = 128
FAN = 16
_ID = "document_id"


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(document_id, block, at, line): the lines of text files, read by as many tasks as they have blocks.

    A document is a file and its id the path. ``block`` is where the part of the file begins that
    a task read; ``at`` rises with the lines in it. Bytes that are no UTF-8 become U+FFFD.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias(_ID),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        text.decode_utf8(F.col("value").cast("binary")).alias("line"),
    )


def body_lines(df: DataFrame, body: str = "body") -> DataFrame:
    """The same columns from documents that still fit into a row each."""
    cut = df.select(_ID, F.posexplode(F.split(body, "\n")).alias("at", "line"))
    return cut.select(_ID, F.lit(0).cast("long").alias("block"), F.col("at").cast("long").alias("at"), "line")


def _piece_map(counts: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
    """For every number of tokens before the piece: those after it, and the sections closed in it."""
    n = len(counts)
    upto = np.cumsum(counts, dtype=np.int64)
    before = np.concatenate(([0], upto))
    # the line that closes a section which begins with line i, n if none does
    closes = np.maximum(np.searchsorted(upto, before + target), np.arange(n + 1)).tolist()
    tokens, closed = [0] * (n + 1), [0] * (n + 1)
    total = int(before[-1])
    for i in range(n - 1, -1, -1):
        if (j := closes[i]) < n:
            tokens[i], closed[i] = tokens[j + 1], closed[j + 1] + 1
        else:
            tokens[i] = total - int(before[i])
    first = np.searchsorted(upto, target - np.arange(max(1, target)))
    after = np.minimum(first + 1, n)
    open_still = first == n
    return (
        np.where(open_still, np.arange(len(first)) + total, np.array(tokens)[after]),
        np.where(open_still, 0, np.array(closed)[after] + 1),
    )


def _maps(counts: Column, target: int) -> Column:
    """struct(tokens, closed) of arrays, by the tokens before the piece. Only counts cross to Python."""

    @F.pandas_udf("tokens array<int>, closed array<int>")
    def mapped(pieces: pd.Series) -> pd.DataFrame:
        found = [_piece_map(np.asarray(p, dtype=np.int64), target) for p in pieces]
        return pd.DataFrame({"tokens": [t for t, _ in found], "closed": [c for _, c in found]})

    return mapped(counts)


def _composed(maps: Column) -> Column:
    """One map that does what the maps of an array do one after the other."""

    def then(acc: Column, m: Column) -> Column:
        return F.struct(
            F.transform(acc["tokens"], lambda s: F.get(m["tokens"], s)).alias("tokens"),
            F.zip_with(acc["tokens"], acc["closed"], lambda s, c: c + F.get(m["closed"], s)).alias("closed"),
        )

    first = F.get(maps, F.lit(0))["map"]
    return F.aggregate(F.transform(F.slice(maps, 2, FAN), lambda m: m["map"]), first, then)


def _begun(maps: Column, tokens: Column, closed: Column) -> Column:
    """For each map of a group (no, tokens, closed): the counts that it begins with."""
    start = F.struct(
        tokens.alias("tokens"),
        closed.alias("closed"),
        F.array().cast("array<struct<no:long,tokens:int,closed:int>>").alias("out"),
    )

    def step(acc: Column, m: Column) -> Column:
        here = F.struct(m["no"].alias("no"), acc["tokens"].alias("tokens"), acc["closed"].alias("closed"))
        return F.struct(
            F.get(m["map"]["tokens"], acc["tokens"]).alias("tokens"),
            (acc["closed"] + F.get(m["map"]["closed"], acc["tokens"])).alias("closed"),
            F.array_append(acc["out"], here).alias("out"),
        )

    return F.aggregate(maps, start, step, lambda acc: acc["out"])


def piece_starts(maps: DataFrame) -> DataFrame:
    """(document_id, no, tokens, closed): open tokens and closed sections before each piece.

    ``maps`` has (document_id, no, map), numbered from 0 in each document. Each level of the
    tree is a job over rows that are ``FAN`` times fewer, up to one row per document.
    """
    last = maps.agg(F.max("no")).first()[0] or 0  # one number
    levels = [maps]
    while last := last // FAN:
        up = _groups(levels[-1]).select(_ID, F.col("group").alias("no"), _composed(F.col("maps")).alias("map"))
        levels.append(written(up, "maps"))
    top = _begun(F.col("maps"), F.lit(0), F.lit(0))
    begun = _groups(levels.pop()).select(_ID, F.explode(top).alias("b")).select(_ID, "b.*")
    while levels:
        above = begun.withColumnsRenamed({_ID: "d", "no": "g"})
        met = _groups(levels.pop()).join(above, F.col(_ID).eqNullSafe(F.col("d")) & (F.col("group") == F.col("g")))
        found = _begun(F.col("maps"), F.col("tokens"), F.col("closed"))
        begun = met.select(_ID, F.explode(found).alias("b")).select(_ID, "b.*")
    return begun


def _groups(maps: DataFrame) -> DataFrame:
    """Maps of ``FAN`` consecutive pieces in a row; such rows are never stored, readers batch thousands."""
    return maps.groupBy(_ID, F.expr(f"no div {FAN}").alias("group")).agg(
        F.sort_array(F.collect_list(F.struct("no", "map"))).alias("maps")
    )


def long_sections(
    lines: DataFrame,
    target_tokens: int = SECTION_TARGET_TOKENS,
    tokenizer=None,
    piece_lines: int = PIECE_LINES,
) -> DataFrame:
    """(document_id, page_number, text): the sections ``split_sections`` makes of the whole documents.

    ``lines`` has (document_id, block, at, line), in the order of block and at; plain text, as markup
    can't be cut at line ends. Null lines count as blank, and documents without a line that isn't
    blank have no section. A third of all lines may be one document's: its pieces are dealt like
    all others. Runs jobs that store the pieces and the levels of the tree.
    """
    tokenizer = tokenizer or PatternTokenizer()
    cut = F.expr(f"at div {int(piece_lines)}").alias("cut")
    raw = lines.groupBy(_ID, "block", cut).agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("raw"))
    cleaned = F.transform("raw", lambda x: text.lines(text.lint(F.coalesce(x["line"], F.lit("")))))
    cleaned = raw.select(_ID, "block", "cut", F.flatten(cleaned).alias("lines"))
    pieces = written(cleaned.select("*", tokenizer.line_counts(F.col("lines")).alias("counts")), "pieces")
    # three numbers a piece
    order = Window.partitionBy(_ID).orderBy("block", "cut")
    keys = pieces.select(_ID, "block", "cut").withColumn("no", F.row_number().over(order).cast("long") - 1)
    numbered = _keyed(pieces, written(keys, "numbers"))
    starts = piece_starts(
        written(numbered.select(_ID, "no", _maps(F.col("counts"), target_tokens).alias("map")), "maps")
    )
    starts = starts.withColumnsRenamed({_ID: "d", "no": "p"})
    begun = numbered.join(starts, F.col(_ID).eqNullSafe(F.col("d")) & (F.col("no") == F.col("p")))
    parts = let(
        section_ends(F.col("counts"), target_tokens, F.col("tokens")), lambda ends: cut_sections(F.col("lines"), ends)
    )
    fragments = written(
        begun.select(_ID, "no", "closed", parts.alias("parts"))
        .select(_ID, "no", "closed", F.size("parts").alias("of"), F.posexplode("parts").alias("i", "text"))
        .select(
            _ID,
            "no",
            (F.col("closed") + F.col("i") + 1).alias("page_number"),
            ((F.col("i") == 0) | (F.col("i") == F.col("of") - 1)).alias("edge"),
            "text",
        ),
        "fragments",
    )
    # only a piece's first and last sections may go on in others
    inner = fragments.where(~F.col("edge")).select(_ID, "page_number", "text")
    edges = fragments.where("edge").groupBy(_ID, "page_number").agg(
        F.sort_array(F.collect_list(F.struct("no", "text"))).alias("parts")
    )
    whole = edges.select(_ID, "page_number", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))
    return inner.unionByName(whole)


def _keyed(pieces: DataFrame, keys: DataFrame) -> DataFrame:
    """Pieces with their number in the document."""
    other = keys.withColumnsRenamed({_ID: "d", "block": "b", "cut": "c"})
    return pieces.join(
        other, F.col(_ID).eqNullSafe(F.col("d")) & (F.col("block") == F.col("b")) & (F.col("cut") == F.col("c"))
    ).drop("d", "b", "c")
