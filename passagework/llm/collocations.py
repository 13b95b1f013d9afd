"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every word position is a pointer to the up to four words that follow it in its piece. Words
that are too rare to stand in a frequent phrase end a suffix. Suffixes are dealt out by
their leading words, as many of them as it takes to reach a word that is not hot, so that
no group is larger than a hot word's bound; copies within a block travel as one pointer
with a weight, words as numbers. A task parts its pointers by their two leading words,
abandons infrequent parts, and sorts the others by multikey three-way quicksort, word by
word and four words deep at most: the weight of an equal part is the count of its phrase,
and a part whose weight is below the least count is abandoned with all that is in it. Only
phrases of hot words alone are counted in several tasks, and summed afterwards.
"""

from __future__ import annotations

import itertools
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.common import small_batches
from passagework.session import written

DEPTH = 4
LEAST = 30
TOP = 2000
#: A candidate goes if a longer phrase around it has this share of its count, in percent.
NESTED = 80
BLOCK = 8 << 20
#: Suffixes a sorting task gets, and the count above which a word alone doesn't decide the task.
GROUP, HOT = 1_000_000, 200_000
NO_LANG = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLOCKS = "block long, id int, lang string, word string, n long, packet binary"
ROUTED = "route long, packet binary"
COUNTS = "words array<long>, size int, f long"


def _table() -> bytes:
    """A-Z lowered, every break a full stop."""
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    for c in BREAKS:
        table[c] = BREAKS[0]
    return bytes(table)


def _parts(code: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end where a piece ends."""
    at = 0
    while len(code) - at > size:
        cut = code.rfind(b".", at, at + size)
        cut = cut if cut >= 0 else code.find(b".", at + size)
        if cut < 0:
            break
        yield code[at : cut + 1]
        at = cut + 1
    yield code[at:]


def word_blocks(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of texts as word numbers (``packet``; 0 ends a piece), and the words of each with counts."""
    names = [x.split()[0] for x in BLOCKS.split(", ")]
    table = _table()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        pieces: list[np.ndarray] = []
        size = 0

        def fresh():
            count = itertools.count(1)

            def words():
                made = defaultdict(count.__next__)
                made[b"."] = 0
                return made

            return defaultdict(words)

        vocabulary = fresh()

        def close() -> Iterator[pd.DataFrame]:
            nonlocal number, size, vocabulary
            if not pieces:
                return
            ids = np.concatenate(pieces)
            counts = np.bincount(ids)
            for lang, words in vocabulary.items():
                made = pd.DataFrame({"word": list(words), "id": list(words.values())})
                made = made[made["id"] > 0]
                made["word"] = [w.decode() for w in made["word"]]
                made = made.assign(block=number, lang=lang, n=counts[made["id"].to_numpy()], packet=None)
                for a in range(0, len(made), 50_000):
                    yield made[names].iloc[a : a + 50_000]
            packet = zstandard.compress(ids.tobytes(), 1)
            yield pd.DataFrame([[number, None, None, None, None, packet]], columns=names)
            number, size, vocabulary = number + 1, 0, fresh()
            pieces.clear()

        for frame in small_batches(frames, "text", 1 << 20):
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                for code in _parts(text.encode().translate(table), block):
                    if size and size + len(code) > block:
                        yield from close()
                    words = code.replace(b".", b" . ").split()
                    words.append(b".")
                    pieces.append(np.fromiter(map(vocabulary[lang].__getitem__, words), np.int32, len(words)))
                    size += len(code)
        yield from close()

    slim = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInPandas(cut, BLOCKS)


def distinct_suffixes(numbers: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The different suffixes of two words or more, sorted, a column per word (0: ended), and how often each stands.

    ``numbers`` are the words' numbers in the order of the text, 0 where a suffix ends.
    """
    padded = np.concatenate([numbers, np.zeros(depth, numbers.dtype)])
    at = np.flatnonzero((numbers > 0) & (padded[1 : len(numbers) + 1] > 0))
    columns = [numbers[at]]
    for d in range(1, depth):
        columns.append(np.where(columns[-1] > 0, padded[at + d], 0))
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(at), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    return np.stack([c[first] for c in columns]), np.diff(np.append(first, len(at)))


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(32))


def route_of(columns: np.ndarray, spoken: np.ndarray, f: np.ndarray, routes: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Each suffix's route, and how many words at its start are all hot.

    A word that is not hot has one route. A hot one spreads over as many as its count asks
    for, by the words up to the first that is not hot; a pair of hot words over as many as
    the rarer one's count asks for, so that few tasks hold a part of its count.
    """
    n = columns.shape[1]
    run, mix, lead = np.ones(n, bool), np.zeros(n, np.uint64), np.zeros(n, np.int8)
    after: list[np.ndarray] = []
    for column in columns:
        mix = np.where(run, _mixed(mix + spoken[column].astype(np.uint64)), mix)
        after.append(mix)
        run = run & (f[column] > hot)
        lead += run
    counts = f[columns[:2]].astype(np.uint64)
    spread, inner = counts[0] // np.uint64(hot) + np.uint64(1), counts.min(axis=0) // np.uint64(hot) + np.uint64(1)
    offset = after[1] % spread + np.where(lead >= 2, mix % inner, np.uint64(0))
    offset = np.where(lead >= 1, offset % spread, np.uint64(0))
    return ((after[0] % np.uint64(routes) + offset) % np.uint64(routes)).astype(np.int64), lead


def routed(packets: DataFrame, asked: DataFrame, routes: int, hot: int) -> DataFrame:
    """Each block's different suffixes, dealt to ``routes`` by their leading words.

    ``asked`` has the numbers and counts of the block's frequent words.
    """

    def deal(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        out: list[tuple[int, bytes]] = []
        for packet in held["packet"]:
            ids = np.frombuffer(zstandard.decompress(packet), np.int32)
            if not len(asked):
                continue
            mine = asked["id"].to_numpy()
            size = max(int(ids.max()), int(mine.max())) + 1
            numbers = np.zeros(size, np.int32)
            numbers[mine] = np.arange(1, len(mine) + 1)
            spoken = np.append(0, asked["number"].to_numpy())
            spoken = spoken.astype(np.int32 if spoken.max() < 1 << 31 else np.int64)
            columns, weight = distinct_suffixes(numbers[ids], DEPTH)
            route, lead = route_of(columns, spoken, np.append(0, asked["f"].to_numpy()), routes, hot)
            order = np.argsort(route, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(route[order])) + 1):
                if len(rows):
                    body = (spoken[columns[:, rows]], lead[rows], weight[rows])
                    out.append((int(route[rows[0]]), zstandard.compress(pickle.dumps(body), 1)))
        return pd.DataFrame(out, columns=["route", "packet"])

    return packets.groupBy("of").cogroup(asked.groupBy("block")).applyInPandas(deal, ROUTED)


def three_way(columns: np.ndarray, weight: np.ndarray, lead: np.ndarray, least: int, parts: list[np.ndarray], depth: int) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers, from word ``depth`` on within each part.

    Gives (a pointer, words, weight) of every prefix longer than ``depth`` words. Parts that
    weigh less than ``least`` are abandoned, unless a prefix of hot words is in them
    (``lead`` counts a suffix's leading hot words), of which this task may hold a part only.
    """
    stack = [(rows, depth) for rows in parts]
    while stack:
        rows, depth = stack.pop()
        key = columns[depth][rows]
        n = len(rows)
        if n == 1:
            pivot, middle = key[0], rows
        else:
            a, b, c = int(key[0]), int(key[n // 2]), int(key[-1])
            pivot = max(min(a, b), min(max(a, b), c))
            same = key == pivot
            middle = rows[same]
            if len(middle) < n:
                low = key < pivot
                for part in (rows[low], rows[~(low | same)]):
                    if len(part) and (weight[part].sum() >= least or lead[part].max() > depth):
                        stack.append((part, depth))
        if not pivot:
            continue  # these ended before
        total = int(weight[middle].sum())
        if total < least and lead[middle[0]] <= depth:
            continue
        yield int(middle[0]), depth + 1, total
        if depth + 1 < len(columns):
            stack.append((middle, depth + 1))


def prefix_counts(columns: np.ndarray, weight: np.ndarray, lead: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(a pointer, words, weight) of every prefix of two words or more, infrequent ones left out.

    The pointers are parted by their two leading words at once; what is left of those parts
    goes on to the quicksort.
    """
    order = np.lexsort((columns[1], columns[0]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns[:2]:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    total = np.add.reduceat(weight[order], first) if len(first) else first
    stay = np.flatnonzero((total >= least) | (lead[order[first]] >= 2))
    last = np.append(first, len(order))[1:]
    parts = [order[first[i] : last[i]] for i in stay.tolist()]
    for part, n in zip(parts, total[stay].tolist(), strict=True):
        yield int(part[0]), 2, n
    yield from three_way(columns, weight, lead, least, parts, 2)


def _sorted_counts(dealt: DataFrame, least: int) -> DataFrame:
    """Counts of the phrases that start in each task's share; those of hot words alone in parts."""

    def count(held: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        columns, lead, weight = zip(*(pickle.loads(zstandard.decompress(x)) for x in held["packet"]), strict=True)
        columns, lead, weight = np.concatenate(columns, axis=1), np.concatenate(lead), np.concatenate(weight)
        found = [(columns[:n, at], n, f) for at, n, f in prefix_counts(columns, weight, lead, least)]
        return pd.DataFrame(found, columns=["words", "size", "f"])

    return dealt.groupBy("route").applyInPandas(count, COUNTS)


def _numbered(words: DataFrame) -> DataFrame:
    """Add ``number``: 1 for the first row, and so on, by the sizes of the table's parts."""
    parted = written(words.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)
    sizes = parted.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return parted.join(F.broadcast(before), part == F.col("part")).select(
        *words.columns, (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).alias("number")
    )


def phrase_counts(docs: DataFrame, least: int = LEAST, group: int = GROUP, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (lang, word, f, number), phrases of their numbers (words, size, f), words of each language (lang, n).

    Runs jobs.
    """
    held = written(word_blocks(docs), "words")
    local = held.where("packet IS NULL").drop("packet")
    counted = written(local.groupBy("lang", "word").agg(F.sum("n").alias("f")), "vocabulary")
    totals = written(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    often = written(_numbered(counted.where(F.col("f") >= least)), "frequent")
    named = often.select(F.col("lang").alias("l"), F.col("word").alias("w"), "number", "f")
    asked = local.join(named, (F.col("lang") == F.col("l")) & (F.col("word") == F.col("w"))).select("block", "id", "number", "f")
    total = often.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    packets = held.where("packet IS NOT NULL").select(F.col("block").alias("of"), "packet")
    dealt = written(routed(packets, asked, total // group + 1, hot), "suffixes")
    sums = _sorted_counts(dealt, least).groupBy("words", "size").agg(F.sum("f").alias("f"))
    return often, written(sums.where(F.col("f") >= least), "phrases"), totals


def weakest_cuts(phrases: DataFrame, often: DataFrame) -> DataFrame:
    """(words, size, a, l, r, score) of each phrase at its lowest-scoring cut. All parts of a phrase must be given."""
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "words", "size", F.col("f").alias("a"), "k",
        F.slice("words", 1, F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, F.col("size")).alias("rest"),
    )
    parts = often.select(F.array("number").alias("part"), "f").union(phrases.select("words", "f"))
    for side, name in (("first", "l"), ("rest", "r")):
        other = parts.select(F.col("part").alias("_p"), F.col("f").alias(name))
        # stored, so that a word in many phrases is split over tasks by the skew join
        cuts = written(cuts.join(other, F.col(side) == F.col("_p")).drop("_p", side), "cuts")
    score = F.expr("(2000000BD * CAST(a AS DECIMAL(25, 0))) DIV CAST(l + r AS DECIMAL(25, 0))")
    least = cuts.groupBy("words", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("words", "size", "a", "cut.l", "cut.r", "cut.score")


def inside_longer(phrases: DataFrame, nested: int = NESTED) -> DataFrame:
    """The ``words`` of phrases inside a longer one with ``nested`` percent of their count or more."""
    size = F.col("size")
    spans = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda i: F.transform(F.sequence(F.lit(2), F.least(size - 1, size - i + 1)), lambda n: F.slice("words", i, n)),
    )
    inner = phrases.where("size > 2").select(F.explode(F.array_distinct(F.flatten(spans))).alias("_p"), F.col("f").alias("outer"))
    most = inner.groupBy("_p").agg(F.max("outer").alias("outer"))
    both = phrases.join(most, F.col("words") == F.col("_p"))
    return both.where(100 * F.col("outer") >= nested * F.col("f")).select(F.col("words").alias("_p"))


def spoken(found: DataFrame, often: DataFrame) -> DataFrame:
    """Add ``lang`` and ``phrase`` to rows with different ``words``."""
    each = found.select("words", F.posexplode("words").alias("at", "_n"))
    named = written(each.join(often.select("number", "lang", "word"), F.col("_n") == F.col("number")), "spoken")
    texts = named.groupBy(F.col("words").alias("_w")).agg(
        F.min("lang").alias("lang"), F.array_join(F.array_sort(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase")
    )  # four words at most in a group
    return found.join(texts, F.col("words") == F.col("_w")).drop("_w")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, **sizes: int) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty; a null language counts as ``und``; repeated rows count each time;
    an empty table gives no rows. Arithmetic is exact. Runs jobs.
    """
    often, phrases, totals = phrase_counts(docs, least, **sizes)
    kept = weakest_cuts(phrases, often).join(inside_longer(phrases), F.col("words") == F.col("_p"), "left_anti")
    named = spoken(written(kept, "kept"), often)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("lang", "_l"), F.col("lang") == F.col("_l")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
