"""Language-model scores by prediction by partial matching over bytes.

Training counts every symbol (257: bytes and the end of a text) after every context of
up to ``ORDER`` bytes: a trie of contexts, kept as tables of counts. A text's symbols are
coded from the longest known context down: a context that has not seen the symbol
escapes with the share of its distinct symbols (method C), and symbols it has seen are
excluded below. Since a context's symbols are a subset of those of its suffix, all
exclusions are sums over the trie and are computed once per context, not per symbol.

Documents are read once and put into blocks. A block asks for the values of the distinct
runs of bytes, and words, that occur in it, and is scored beside these: no table of the
corpus is ever held whole by a task or broadcast, and a frequent run has a row per block,
not per place.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, texts
from passagework.session import written

ORDER = 4
#: Symbols besides bytes: the end of a text, and what stands before its first byte.
END, START = 256, 257
_BITS, _SYMBOL = 9, (1 << 9) - 1
#: Bytes of text in a block, and in what is coded at a time.
BLOCK, SLICE = 32 << 20, 1 << 20
COUNTS = "block long, key long, n long, packet binary"
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, word_score double, score double, distinct_tokens long"
)


def _grams(codes: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each symbol of each text its run of ``order`` + 1 symbols as a number, and the text's place."""
    sizes = np.array([len(c) for c in codes]) + order + 1
    ends = np.cumsum(sizes)
    line = np.full(ends[-1], START, np.uint64)
    for code, end in zip(codes, ends.tolist(), strict=True):
        line[end - 1 - len(code) : end - 1] = np.frombuffer(code, np.uint8)
        line[end - 1] = END
    key = np.zeros(len(line) - order, np.uint64)
    for k in range(order + 1):
        key = (key << np.uint64(_BITS)) | line[k : len(line) - order + k]
    owner = np.repeat(np.arange(len(codes)), sizes)[order:]
    real = line[order:] != START
    return key[real].view(np.int64), owner[real]


def word_key(word: bytes) -> int:
    """A negative number for a word; runs of symbols are positive. The empty word is the end."""
    from xxhash import xxh64_intdigest

    return (xxh64_intdigest(word) >> 1) - (1 << 63)


def _parts(codes: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE`` bytes."""
    a = size = 0
    for b, code in enumerate(codes):
        if size and size + len(code) > SLICE:
            yield a, b
            a, size = b, 0
        size += len(code)
    if a < len(codes):
        yield a, len(codes)


def _count(codes: list[bytes], learned: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a block and how often each occurs in texts to learn from."""
    keys, sums = [], []
    for a, b in _parts(codes):
        grams, owner = _grams(codes[a:b], order)
        found, distinct = pd.factorize(grams)
        keys.append(distinct)
        sums.append(np.bincount(found, learned[a:b][owner], len(distinct)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, distinct = pd.factorize(np.concatenate(keys))
    n = np.bincount(found, np.concatenate(sums), len(distinct))
    words: Counter[bytes] = Counter()
    other: set[bytes] = set()
    for code, learn in zip(codes, learned, strict=True):
        (words if learn else other).update(code.lower().split())
        (words if learn else other).update((b"",))
    named = [(word_key(w), c) for w, c in words.items()] + [(word_key(w), 0) for w in other - words.keys()]
    table = np.array(named, np.int64).reshape(-1, 2)
    return np.concatenate([distinct, table[:, 0]]), np.concatenate([n.astype(np.int64), table[:, 1]])


def blocks(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """Blocks of documents (``packet``), and each block's distinct keys with training counts."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        rows: list[tuple] = []
        number = TaskContext.get().partitionId() << 32

        def close() -> Iterator[pd.DataFrame]:
            nonlocal rows, number
            if not rows:
                return
            ids, held, codes = map(list, zip(*rows, strict=True))
            keys, n = _count(codes, ~np.array(held, bool), order)
            packet = zstandard.compress(pickle.dumps((ids, held, codes)), 9)
            for a in range(0, len(keys), 50_000):
                part = slice(a, a + 50_000)
                yield pd.DataFrame({"block": number, "key": keys[part], "n": n[part], "packet": None})
            yield pd.DataFrame({"block": [number], "key": [None], "n": [None], "packet": [packet]})
            rows, number = [], number + 1

        size = 0
        for frame in small_batches(frames, "text", 1 << 20):
            ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
            for doc_id, held, text in zip(ids, frame["held"], frame["text"], strict=True):
                code = text.encode()
                if size and size + len(code) > BLOCK:
                    yield from close()
                    size = 0
                rows.append((doc_id, bool(held), code))
                size += len(code)
        yield from close()

    held = F.coalesce(held_out, F.lit(False)).alias("held")
    return texts(docs.select("doc_id", "text", held), "doc_id", "held").mapInPandas(count, COUNTS)


def _key(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << _BITS * (order + 1)) - 1))


def _context(key: Column) -> Column:
    return F.shiftright(key, _BITS)


def code_lengths(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): log10 probability of the last symbol of each run in ``grams`` (key, n).

    ``n`` counts training occurrences; runs with none get values too. Runs jobs: a table of
    counts and one of contexts for each order, each as large as its distinct contexts.
    """
    counts, nodes = {}, {}
    last = grams.where("n > 0")
    for k in range(order, -1, -1):
        last = written(
            last.groupBy(_key(F.col("key"), k).alias("key")).agg(F.sum("n").alias("n")), f"order{k}"
        )
        counts[k] = last
    for k in range(order, 0, -1):
        shorter = counts[k - 1].select(F.col("key").alias("s"), F.col("n").alias("below"))
        rows = counts[k].join(shorter, _key(F.col("key"), k - 1) == F.col("s"))
        nodes[k] = written(
            rows.groupBy(_context(F.col("key")).alias("context")).agg(
                F.sum("n").alias(f"N{k}"), F.count("*").alias(f"D{k}"), F.sum("below").alias(f"E{k}")
            ),
            f"context{k}",
        )
    root = counts[0].agg(F.sum("n"), F.count("*")).first()
    out = grams.select("key")
    for k in range(order, -1, -1):
        held = counts[k].select(F.col("key").alias(f"key{k}"), F.col("n").alias(f"c{k}"))
        out = out.join(held, _key(F.col("key"), k) == F.col(f"key{k}"), "left")
        if k:
            node = nodes[k].withColumnRenamed("context", f"context{k}")
            out = out.join(node, _context(_key(F.col("key"), k)) == F.col(f"context{k}"), "left")
        else:
            out = out.withColumn("N0", F.lit(root[0] or 0)).withColumn("D0", F.lit(root[1] or 0))
    value, open_ = F.lit(0.0), F.lit(True)
    for k in range(order, -1, -1):
        seen, kinds = F.col(f"N{k}"), F.col(f"D{k}")
        if k < order:  # what the longer context has seen is excluded, if there is one
            seen = seen - F.coalesce(F.col(f"E{k + 1}"), F.lit(0))
            kinds = kinds - F.coalesce(F.col(f"D{k + 1}"), F.lit(0))
        known = F.col(f"N{k}").isNotNull() & (F.col(f"N{k}") > 0)
        coded = F.log10(F.col(f"c{k}") / (seen + kinds))
        escape = F.when(known & (kinds > 0), F.log10(kinds / (seen + kinds))).otherwise(0.0)
        hit = open_ & F.col(f"c{k}").isNotNull()
        # one column per level: nested, the expression would double at each of them
        out = out.withColumn(f"v{k}", F.when(hit, coded).when(open_, escape).otherwise(0.0))
        out = out.withColumn(f"o{k}", open_ & F.col(f"c{k}").isNull())
        value, open_ = value + F.col(f"v{k}"), F.col(f"o{k}")
    unseen = 257 - (root[1] or 0)
    final = F.when(open_, -F.log10(F.lit(float(max(unseen, 1))))).otherwise(0.0)
    return out.select("key", (value + final).alias("value"))


def ppm_scores(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """Score whole texts by a model of those for which ``held_out`` is false (null: false).

    ``score`` is the log10 probability of the text and its end. The base score is that of
    its words (A-Z lowered, one end each) by their training frequency. One row per input row;
    null texts are empty, an empty table gives none, and without training texts every symbol
    has probability 1/257. Runs jobs: texts are read once and shuffled once, compressed.
    """
    counted = written(blocks(docs, held_out, order), "blocks")
    asked = counted.where("key IS NOT NULL").select("block", "key", "n")
    grams = asked.where("key >= 0").groupBy("key").agg(F.sum("n").alias("n"))
    values = written(code_lengths(written(grams, "grams"), order), "values").withColumnRenamed("key", "k")
    of_grams = asked.where("key >= 0").join(values, F.col("key") == F.col("k")).select(
        "block", "key", "value", F.lit(False).alias("first")
    )
    alike = Window.partitionBy("key")
    total = F.sum("n").over(alike)
    of_words = asked.where("key < 0").select(
        "block",
        "key",
        total.cast("double").alias("value"),
        ((F.min("block").over(alike) == F.col("block")) & (total > 0)).alias("first"),
    )

    def score(packets: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        out = []
        told = told.sort_values("key")
        keys, value = told["key"].to_numpy(), told["value"].to_numpy()
        split = int(np.searchsorted(keys, 0))
        often: dict[bytes, float] = {}
        for packet in packets["packet"]:
            ids, held, codes = pickle.loads(zstandard.decompress(packet))
            scores = np.zeros(len(codes))
            for a, b in _parts(codes):
                run, owner = _grams(codes[a:b], order)
                found, distinct = pd.factorize(run)
                logs = value[split + np.searchsorted(keys[split:], distinct)]
                scores[a:b] = np.bincount(owner, logs[found], b - a)
            for doc_id, h, code, s in zip(ids, held, codes, scores, strict=True):
                words = code.lower().split()
                words.append(b"")
                new = [w for w in set(words) if w not in often]
                at = np.searchsorted(keys[:split], np.array(list(map(word_key, new)), np.int64))
                often.update(zip(new, value[at].tolist(), strict=True))
                n = np.array([often[w] for w in words])
                out.append((doc_id, h, len(n), int((n > 0).sum()), float(np.log10(n + 0.1).sum()), float(s), None))
        out.append((None, None, None, None, None, None, int(told["first"].sum())))
        return pd.DataFrame(out, columns=[x.split()[0] for x in SCORED.split(", ")]).astype(
            {"doc_id": "Int64", "n_tokens": "Int64", "n_known": "Int64", "distinct_tokens": "Int64"}
        )

    packets = counted.where("packet IS NOT NULL").select(F.col("block").alias("of"), "packet")
    told = of_grams.unionByName(of_words)
    rows = written(
        packets.groupBy("of").cogroup(told.groupBy("block")).applyInPandas(score, SCORED), "scores"
    )
    size = rows.agg(
        F.coalesce(F.sum("distinct_tokens"), F.lit(0)),
        F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.lit(0)),
    ).first()
    per_token = F.lit(float(np.log10(size[1] + 0.1 * (size[0] + 1))))
    return rows.where("n_tokens IS NOT NULL").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(size[1]).cast("long").alias("train_tokens"),
        (F.col("word_score") - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
    )
