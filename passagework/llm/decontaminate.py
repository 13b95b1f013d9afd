"""Benchmark decontamination by a distributed positional inverted index.

Postings (term, document, position) of all training tokens that a test item uses are
stored once. Each window of test words starts from its rarest term and the two that
follow: their postings, shifted by the offset in the window, are the candidate
starts, and the postings of the window's other terms at their shifted positions are
intersected with those. Everything is DataFrame joins; no list of a term is gathered.

Proximity matches forgive two edited words a window. Two edits leave one of three parts of
a window whole, so the places where a part's first words stand are all candidates, and the
words around such a place are compared with the window where they are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.functions.arrays import with_once
from passagework.llm.common import ascii_lower
from passagework.session import written

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Not a word: stands after a document's last one and carries the number of its words.
END = "\x00"
#: Words of a window that may be changed, put in or left out in a proximity match.
EDITS = 2
#: Bytes of leads that are broadcast at a time; more take further passes over the documents.
LEAD_BYTES = 32 << 20
_DOC = ["doc_id", "text_key"]


def letter_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, A-Z lowered."""
    # on ASCII alone, ``lower`` is the same and much faster
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.array_remove(F.split(low, GAP), "")


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows as (win, size, off, term), and which items hold them as (win, item_id).

    Items of fewer words are one window; items without a word (null texts too) have none.
    """
    words = with_once(
        benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")), "words", letter_words(F.col("text"))
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    cut = words.select("item_id", F.explode(starts).alias("at"), "words").select(
        "item_id", F.slice("words", F.col("at"), window).alias("terms")
    )
    named = cut.withColumn("win", F.unhex(F.md5(F.array_join("terms", " "))))
    holds = written(named.select("win", "item_id").distinct(), "holds")
    terms = named.groupBy("win").agg(F.first("terms").alias("terms"))
    return (
        written(
            terms.select("win", F.size("terms").alias("size"), F.posexplode("terms").alias("off", "term")), "windows"
        ),
        holds,
    )


def _neighbour(word: Column) -> Column:
    """A small hash of the next word: narrows candidates; every term is checked later."""
    return F.pmod(F.hash(word), F.lit(32768)).cast("short")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, term, near1, near2) of every token in ``terms`` (term), and of ``END``.

    ``near1`` and ``near2`` stand for the next two words. Null texts have no words, only the end.
    """
    words = with_once(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text")),
        "words",
        F.array_append(letter_words(F.col("text")), F.lit(END)),
    )
    near = (_neighbour(F.get("words", F.col("pos") + k)).alias(f"near{k}") for k in (1, 2))
    tokens = words.select(*_DOC, F.posexplode("words").alias("pos", "word"), "words").select(*_DOC, "pos", "word", *near)
    return tokens.join(terms, F.col("word") == F.col("term")).select(*_DOC, "pos", "term", "near1", "near2")


def candidates(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, win, size) where a window's rarest term and those after it stand."""
    often = written(index.groupBy("term").agg(F.count("*").alias("often")), "often").withColumnRenamed("term", "t")
    ranked = windows.join(often, F.col("term") == F.col("t"), "left").drop("t")
    by = Window.partitionBy("win")
    for k in (1, 2):
        ranked = ranked.withColumn(f"after{k}", F.lead("term", k).over(by.orderBy("off")))
    # a window with a term that no document has is nowhere
    ranked = ranked.withColumn("found", F.count("often").over(by)).where(F.col("found") == F.col("size"))
    rank = F.row_number().over(by.orderBy("often", "off"))
    rarest = ranked.withColumn("rank", rank).where("rank = 1")
    # near the end of a window an earlier term leads, so that the rarest is one of the three
    lead = F.greatest(F.lit(0), F.least(F.col("off"), F.col("size") - 3)).alias("lead")
    rarest = rarest.select(F.col("win").alias("w"), lead)
    triples = ranked.join(rarest, (F.col("win") == F.col("w")) & (F.col("off") == F.col("lead"))).select(
        "win", "size", "off", F.col("term").alias("t"), *(_neighbour(F.col(f"after{k}")).alias(f"next{k}") for k in (1, 2))
    )
    triples = written(triples, "rarest")
    meet, first, second = (
        F.col("term") == F.col("t"),
        F.col("near1") == F.col("next1"),
        F.col("near2") == F.col("next2"),
    )
    three = index.join(triples.where("size > 2"), meet & first & second)
    two = index.join(triples.where("size = 2"), meet & first)
    one = index.join(triples.where("size = 1"), meet)
    found = three.unionByName(two).unionByName(one).where("pos >= off")
    return found.select(*_DOC, (F.col("pos") - F.col("off")).alias("start"), "win", "size").distinct()


def matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, win, size): every place where a whole window stands."""
    places = written(candidates(index, windows), "candidates")
    held = places.select(*(F.col(c).alias(f"_{c}") for c in _DOC)).distinct()
    near = index.where(F.col("term") != END).join(
        written(held, "held"),
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")),
        "left_semi",
    )
    wanted = places.join(windows.select(F.col("win").alias("w"), "off", "term"), F.col("win") == F.col("w")).select(
        *_DOC, "start", "win", "size", (F.col("start") + F.col("off")).alias("at"), F.col("term").alias("t")
    )
    other = near.distinct().select(*(F.col(c).alias(f"_{c}") for c in [*_DOC, "pos", "term"]))
    return (
        wanted.join(
            other,
            F.col("doc_id").eqNullSafe(F.col("_doc_id"))
            & (F.col("text_key") == F.col("_text_key"))
            & (F.col("at") == F.col("_pos"))
            & (F.col("t") == F.col("_term")),
        )
        .groupBy(*_DOC, "start", "win", "size")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == F.col("size"))
        .drop("n")
    )


def near_matches(docs: DataFrame, windows: DataFrame, window: int = WINDOW, edits: int = EDITS) -> DataFrame:
    """(doc_id, text_key, start, size, win): where a window stands but for ``edits`` words at most.

    At a place, all but ``edits`` words of the window stand at most ``edits`` words from where they
    should, and the first three words of one of its ``edits + 1`` parts stand exactly there. Whatever
    ``edits`` changes, insertions or deletions make of a window is found. Windows with parts of
    fewer than three words have no proximity matches. Spans are cut at the document's ends.

    The words around a token never leave the task that reads it: leads are broadcast instead, in
    parts of at most about ``LEAD_BYTES``, and documents are read once for each part.
    """
    parts = edits + 1
    ordered = F.sort_array(F.collect_list(F.struct("off", "term")))  # at most ``window`` words
    whole = (
        windows.where(F.col("size") >= 3 * parts)
        .groupBy("win")
        .agg(F.transform(ordered, lambda x: x["term"]).alias("terms"))
    )
    firsts = F.array(*(F.floor(F.size("terms") * k / parts).cast("int") for k in range(parts)))
    leads = whole.select("win", "terms", F.explode(firsts).alias("off")).select(
        "win",
        "terms",
        "off",
        F.get("terms", F.col("off")).alias("t"),
        *(_neighbour(F.get("terms", F.col("off") + k)).alias(f"next{k}") for k in (1, 2)),
    )
    leads = written(leads, "leads")
    words = with_once(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text")),
        "words",
        letter_words(F.col("text")),
    )
    behind = window * edits // parts + edits
    first = F.greatest(F.col("pos") - behind, F.lit(0))
    tokens = words.select(*_DOC, F.posexplode("words").alias("pos", "word"), "words").select(
        *_DOC,
        "pos",
        "word",
        F.size("words").alias("n_words"),
        *(_neighbour(F.get("words", F.col("pos") + k)).alias(f"near{k}") for k in (1, 2)),
        # the words that a window around this one can reach, and where they begin
        first.alias("first"),
        F.slice("words", first + 1, behind + window + edits).alias("zone"),
    )
    rows, chars = leads.agg(F.count("*"), F.sum(F.octet_length(F.array_join("terms", " ")))).first()
    passes = 1 + ((chars or 0) + 200 * rows) // LEAD_BYTES
    start, size = F.col("pos") - F.col("off"), F.size("terms")

    def stands(term: Column, off: Column) -> Column:
        low = start + off - edits - F.col("first")  # below zero only where the document begins
        long = F.greatest(F.lit(0), F.least(F.lit(2 * edits + 1), low + 2 * edits + 1))
        return F.array_contains(F.slice("zone", F.greatest(low, F.lit(0)) + 1, long), term)

    led = F.lit(True)
    for k in (1, 2):
        led &= F.get("zone", F.col("pos") - F.col("first") + k) == F.get("terms", F.col("off") + k)
    begin = F.greatest(start, F.lit(0))
    found = []
    for k in range(passes):
        part = leads.where(F.pmod(F.xxhash64("win"), F.lit(passes)) == k)
        met = tokens.join(
            F.broadcast(part),
            (F.col("word") == F.col("t")) & (F.col("near1") == F.col("next1")) & (F.col("near2") == F.col("next2")),
        )
        near = met.where(led).where(F.size(F.filter("terms", stands)) >= size - edits)
        found.append(
            near.select(
                *_DOC, begin.alias("start"), (F.least(start + size, F.col("n_words")) - begin).alias("size"), "win"
            )
        )
    return reduce(DataFrame.unionByName, found).distinct()


def _inside(found: DataFrame) -> DataFrame:
    """(d, k, hit): a document's words inside the spans (start, size)."""
    spans = found.groupBy(*_DOC, "start").agg(F.max("size").alias("size"))
    before = Window.partitionBy(*_DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.coalesce(F.max(F.col("start") + F.col("size")).over(before), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest("start", ends))
    return (
        spans.withColumn("fresh", fresh)
        .groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
        .agg(F.sum("fresh").alias("hit"))
    )


def _held(found: DataFrame, holds: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id), repeated: the items whose windows stand in a document."""
    return (
        found.select(*_DOC, "win").distinct()
        .join(holds.withColumnRenamed("win", "w"), F.col("win") == F.col("w"))
        .select(*_DOC, F.col("item_id").cast("string").alias("item_id"))
    )


def _with_near(judged: DataFrame, near: DataFrame, holds: DataFrame) -> DataFrame:
    """Add ``n_near`` and ``n_near_items`` from (doc_id, text_key, start, size, win)."""
    hits = _inside(near)
    items = (
        _held(near, holds)
        .groupBy(F.col("doc_id").alias("d2"), F.col("text_key").alias("k2"))
        .agg(F.countDistinct("item_id").alias("items"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    also = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_key") == F.col("k2"))
    return judged.join(hits, same, "left").join(items, also, "left").select(
        *judged.columns,
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("items", F.lit(0)).cast("long").alias("n_near_items"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, proximity: bool = False
) -> DataFrame:
    """Per document: n_words, n_hit (words inside any test window), n_items, items_sha256, contaminated.

    One row per input row. Repeated rows are told apart from others by ``doc_id`` and text and
    share their result. Without test items every document is clean. With ``proximity`` also
    ``n_near`` and ``n_near_items``: words inside exact or proximity matches, and items that have
    any; they don't change ``contaminated``.
    """
    windows, holds = test_windows(benchmark, window)
    terms = written(windows.select("term").distinct().union(windows.sparkSession.sql(f"SELECT '{END}' AS term")), "terms")
    index = written(postings(docs, terms), "postings")
    found = written(matches(index, windows), "matches")
    hits = _inside(found)
    items = (
        _held(found, holds).groupBy(*_DOC).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    items = items.select(F.col("doc_id").alias("d2"), F.col("text_key").alias("k2"), "items")
    all_docs = index.where(F.col("term") == END).select(*_DOC, F.col("pos").cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    also = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_key") == F.col("k2"))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    names = F.coalesce("items", F.array().cast("array<string>"))
    judged = all_docs.join(hits, same, "left").join(items, also, "left").select(
        *_DOC,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
    if not proximity:
        return judged
    near = written(near_matches(docs, windows, window), "near")
    either = near.unionByName(found.select(near.columns))
    return _with_near(judged, either, holds)
