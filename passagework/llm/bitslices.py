"""Ranked lexical search over bit-sliced Bloom signatures.

Documents are put into blocks with others of about as many terms. A block is a bit matrix:
a row per hash position, a column per document; a term, and again each level that its
frequency reaches, sets three rows. The conjunction of a term's rows is a bitmap of the
documents that may hold it that often, and never misses one. Sums of the terms' weights
over such bitmaps, a sum per level, bound every document's score from above. Documents whose
bound is below the lowest score still needed are excluded by proof; all others are scored
exactly from their texts.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, texts
from passagework.session import written

TOP = 20
#: A level's bit says that a term stands at least so often; the last has no upper end.
LEVELS = (1, 2, 4, 8)
ROWS_PER_TERM = 3
#: Entries (term and level) of the smallest class of documents; each next class has four times as many.
ENTRIES, ROWS = 64, 1024
MOST_ROWS, CELLS, MOST_DOCS, TEXT_BYTES = 1 << 22, 1 << 24, 4096, 8 << 20
#: Bytes of query texts that are broadcast at a time.
QUERY_BYTES = 1 << 20
INDEX = "block long, members long, tokens long, terms binary, slices binary, packet binary"
FOUND = "q long, doc_id long, score long"


def _table() -> bytes:
    """A-Z lowered; every ASCII byte that is in no term a space."""
    table = bytearray(range(256))
    for c in range(128):
        if not chr(c).isalnum():
            table[c] = 32
    table[65:91] = range(97, 123)
    return bytes(table)


TERMS = _table()


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TERMS).split()


def positions(words: list[bytes], level: int, rows: int) -> np.ndarray:
    """The rows that each word sets at a level: (words, ROWS_PER_TERM)."""
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(w, level) for w in words], np.uint64)
    first, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    at = first[:, None] + step[:, None] * np.arange(ROWS_PER_TERM, dtype=np.uint64)[None, :]
    return (at & np.uint64(rows - 1)).astype(np.int64)


def shape(entries: int) -> tuple[int, int]:
    """(rows, documents) of the blocks for documents with so many entries; rows are a power of two."""
    rows = ROWS
    while entries > ENTRIES:
        entries, rows = -(-entries // 4), rows * 4
    rows = min(rows, MOST_ROWS)
    return rows, min(MOST_DOCS, max(64, CELLS // rows))


class _Block:
    """Documents of one class until their block is full."""

    def __init__(self, rows: int, room: int) -> None:
        self.rows, self.room = rows, room
        self.docs: list[tuple[int | None, int, bytes, Counter]] = []
        self.size = 0

    def add(self, doc_id: int | None, code: bytes, counts: Counter) -> bool:
        self.docs.append((doc_id, sum(counts.values()), code, counts))
        self.size += len(code)
        return len(self.docs) >= self.room or self.size >= TEXT_BYTES

    def row(self, number: int) -> tuple:
        import zstandard

        numbers: dict[bytes, int] = {}
        doc, word, often = [], [], []
        for d, (_, _, _, counts) in enumerate(self.docs):
            word += [numbers.setdefault(w, len(numbers)) for w in counts]
            often += counts.values()
            doc.append(np.full(len(counts), d, np.int64))
        docs = np.concatenate(doc) if doc else np.zeros(0, np.int64)
        word, often = np.array(word, np.int64), np.array(often, np.int64)
        words = list(numbers)
        width = -(-len(self.docs) // 64)
        slices = np.zeros(self.rows * width, np.uint64)
        for level in LEVELS:
            reach = often >= level
            if not reach.any():
                continue
            used, mine = np.unique(word[reach], return_inverse=True)
            at = positions([words[i] for i in used.tolist()], level, self.rows)[mine]
            bit = np.uint64(1) << (docs[reach] & 63).astype(np.uint64)
            for k in range(ROWS_PER_TERM):
                np.bitwise_or.at(slices, at[:, k] * width + (docs[reach] >> 6), bit)
        frequency = np.bincount(word, minlength=len(words))
        pack = lambda x: zstandard.compress(x, 1)
        members = sum(n > 0 for _, n, _, _ in self.docs)
        packet = ([x[0] for x in self.docs], [x[1] for x in self.docs], [x[2] for x in self.docs])
        return (
            number, members, sum(packet[1]), pack(pickle.dumps((words, frequency))),
            pack(slices.tobytes()), pack(pickle.dumps(packet)),
        )


def index(docs: DataFrame) -> DataFrame:
    """A row per block: how many documents have a term, their terms with repeats, document counts, slices, texts."""
    names = [x.split()[0] for x in INDEX.split(", ")]

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, {}
        for frame in small_batches(frames, "text", 1 << 20):
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = terms(text)
                counts = Counter(words)
                if not counts:
                    continue
                entries = sum(sum(n >= x for x in LEVELS) for n in counts.values())
                kind = shape(entries)
                block = held.setdefault(kind, _Block(*kind))
                if block.add(None if pd.isna(doc_id) else int(doc_id), b" ".join(words), counts):
                    yield pd.DataFrame([held.pop(kind).row(number)], columns=names)
                    number += 1
        for block in held.values():
            yield pd.DataFrame([block.row(number)], columns=names)
            number += 1

    return texts(docs, "doc_id").mapInPandas(build, INDEX)


def part(often: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 gives: rises with its frequency, falls with ``m``."""
    return (1_000_000_000 * often) // (1000 * often + 12 * m)


def mass(n: np.ndarray, members: int, tokens: int) -> np.ndarray:
    return 75 + (25 * n * members) // tokens


class Queries:
    """Queries of one broadcast: their different terms, and per query the terms' numbers and weights."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[bytes, int], members: int) -> None:
        self.names: list[int] = []
        self.terms: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        numbers: dict[bytes, int] = {}
        for q, text in items:
            counts = {w: c for w, c in Counter(terms(text)).items() if w in frequency}
            if not counts:
                continue
            weight = [c * math.floor(1000 * math.log((2 * members + 2) / (2 * frequency[w] + 1))) for w, c in counts.items()]
            self.names.append(q)
            self.terms.append(np.array([numbers.setdefault(w, len(numbers)) for w in counts], np.int64))
            self.weights.append(np.array(weight, np.int64))
        self.numbers = numbers


def upper_bounds(queries: Queries, slices: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(queries, documents): no score is above its bound. ``slices`` has a row of 64-bit words per hash position."""
    words = list(queries.numbers)
    out = np.zeros((len(queries.names), len(m)), np.int64)
    below = np.zeros(len(m), np.int64)
    for k, level in enumerate(LEVELS):
        hit = np.bitwise_and.reduce(slices[positions(words, level, len(slices))], axis=1)
        last = k + 1 == len(LEVELS)
        most = np.full(len(m), 1_000_000) if last else part(np.int64(LEVELS[k + 1] - 1), m)
        step, below = most - below, most
        full = np.unpackbits(hit.view(np.uint8), axis=1, bitorder="little")[:, : len(m)]
        for q, (mine, weight) in enumerate(zip(queries.terms, queries.weights, strict=True)):
            out[q] += step * (weight @ full[mine])
    return out


class _Best:
    """The ``top`` best (score, doc_id) of each query so far, ties to the smaller id, null ids last."""

    def __init__(self, queries: Queries, top: int) -> None:
        self.queries, self.top = queries, top
        self.held: list[list[tuple[int, bool, int]]] = [[] for _ in queries.names]
        self.floor = np.ones(len(queries.names), np.int64)

    def score(self, ids: list, codes: list[bytes], m: np.ndarray, chosen: np.ndarray) -> None:
        """Score the chosen documents exactly, for every query."""
        numbers = self.queries.numbers
        at, term, often = [], [], []
        for i, d in enumerate(chosen.tolist()):
            counts = Counter(x for x in map(numbers.get, codes[d].split()) if x is not None)
            at.append(np.full(len(counts), i, np.int64))
            term += counts.keys()
            often += counts.values()
        if not term:
            return
        at, term, often = np.concatenate(at), np.array(term, np.int64), np.array(often, np.int64)
        order = np.argsort(term, kind="stable")
        at, term = at[order], term[order]
        given = part(often[order], m[chosen][at])
        edges = np.searchsorted(term, np.arange(len(numbers) + 1))
        for q, (mine, weight) in enumerate(zip(self.queries.terms, self.queries.weights, strict=True)):
            sums = np.zeros(len(chosen), np.int64)
            for t, w in zip(mine.tolist(), weight.tolist(), strict=True):
                a, b = edges[t], edges[t + 1]
                sums[at[a:b]] += w * given[a:b]
            good = np.flatnonzero(sums >= self.floor[q])
            if len(good) > 4 * self.top:  # equals of the last one stay: their ids decide
                good = good[sums[good] >= np.partition(sums[good], -self.top)[-self.top]]
            new = [(-int(sums[i]), ids[d] is None, ids[d] or 0) for i, d in zip(good.tolist(), chosen[good].tolist(), strict=True)]
            if new:
                self.held[q] = sorted(self.held[q] + new)[: self.top]
                if len(self.held[q]) == self.top:
                    self.floor[q] = max(1, -self.held[q][-1][0])

    def frame(self) -> pd.DataFrame:
        rows = [
            (name, None if no_id else doc_id, -score)
            for name, held in zip(self.queries.names, self.held, strict=True)
            for score, no_id, doc_id in held
        ]
        return pd.DataFrame(rows, columns=["q", "doc_id", "score"]).astype({"doc_id": "Int64"})


def _document_counts(held: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each wanted term stands; as many rows as wanted terms come back."""
    shared = held.sparkSession.sparkContext.broadcast(wanted)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        sums: Counter = Counter()
        for frame in frames:
            for packed in frame["terms"]:
                words, frequency = pickle.loads(zstandard.decompress(packed))
                for w, n in zip(words, frequency.tolist(), strict=True):
                    if w in shared.value:
                        sums[w] += n
        yield pd.DataFrame({"term": list(sums.keys()), "n": list(sums.values())})

    counted = held.select("terms").mapInPandas(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r["term"]): r["n"] for r in counted.collect()}


def _ranked(held: DataFrame, queries: Queries, members: int, tokens: int, top: int) -> DataFrame:
    """The best documents of each query and task."""
    shared = held.sparkSession.sparkContext.broadcast(queries)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        best = _Best(shared.value, top)
        for frame in frames:
            for packed, packet in zip(frame["slices"], frame["packet"], strict=True):
                ids, sizes, codes = pickle.loads(zstandard.decompress(packet))
                m = mass(np.array(sizes, np.int64), members, tokens)
                slices = np.frombuffer(zstandard.decompress(packed), np.uint64).reshape(-1, -(-len(ids) // 64))
                bound = upper_bounds(shared.value, slices, m)
                first = np.zeros(len(ids), bool)
                for q in range(len(bound)):  # the most promising first: they raise the floor
                    some = np.argpartition(bound[q], -top)[-top:] if len(ids) > top else np.arange(len(ids))
                    first[some[bound[q, some] >= best.floor[q]]] = True
                best.score(ids, codes, m, np.flatnonzero(first))
                rest = (bound >= best.floor[:, None]).any(axis=0) & ~first
                best.score(ids, codes, m, np.flatnonzero(rest))
        yield best.frame()

    return held.select("slices", "packet").mapInPandas(search, FOUND)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of each row of ``items`` (item_id, text).

    Null texts have no terms; rows with equal ids are documents or queries of their own; equal
    scores rank by ``doc_id``, null ids last; items without a hit and empty tables give no
    rows. Queries are broadcast in parts of about ``query_bytes``; each part reads the index
    once. Runs jobs.
    """
    spark = docs.sparkSession
    held = written(index(docs), "index")
    members, tokens = held.agg(F.coalesce(F.sum("members"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    asked = texts(items, "item_id").withColumn("q", F.monotonically_increasing_id())
    asked = written(asked, "queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-size // query_bytes)
    found = spark.createDataFrame([], FOUND)
    for p in range(parts if tokens else 0):
        mine = asked.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == p).select("q", "text")
        rows = [(r["q"], r["text"]) for r in mine.collect()]  # one part's queries
        frequency = _document_counts(held, {w for _, t in rows for w in terms(t)})
        found = found.union(written(_ranked(held, Queries(rows, frequency, members), members, tokens, top), "found"))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select(F.col("q").alias("_q"), "item_id")
    return best.join(names, F.col("q") == F.col("_q")).select("item_id", "rank", "doc_id", "score")
