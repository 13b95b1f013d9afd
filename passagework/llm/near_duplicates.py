"""Near-duplicate stage on word shingles.

Texts meet by SimHash first: fingerprints of their shingle sets within three bits, found and
discarded by the pivot tables of ``simhash``, then verified exactly. That connects the copies
that are nearly equal. At five words and a similarity (Jaccard) of 0.8, fingerprints differ in
ten bits on average, which no table of them finds at scale. So the others, beside SimHash and
not in its place, meet by fingerprints of *samples*: each of ``TABLES`` keys hashes the minimum shingles under
four random orders, which a similar pair shares in any one table with probability 0.8^4. Among
those that meet, each text's nearest by samples are verified exactly on their shingle sets, which
connects most copies. Then every pair that meets, is not connected yet and agrees in enough
samples is verified too, block against block of a group, so that no group needs a bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, unused
from passagework.llm.graph import components
from passagework.llm.simhash import SEED, links, majority, shingle_hashes
from passagework.session import written

WORDS = 5
SIMILARITY = 0.8
TABLES, SAMPLES = 16, 4
#: Most texts of a block; larger groups are compared block by block.
CHUNK = 1024
GROUP = ["table", "key", "low", "high"]
#: Nearest others that a text starts with, and the least share of equal samples of any pair.
NEAREST, LEAST = 3, 0.6
SKETCH = "doc_id long, digest binary, fingerprint long, signature binary, keys array<long>, shingles array<int>"


def _orders() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, TABLES * SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The least of the hashes under each order."""
    least = np.full(len(orders), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 4096):
        mixed = hashes[a : a + 4096, None] * orders[None, :]
        least = np.minimum(least, mixed.min(axis=0))
    return least


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Digest, SimHash fingerprint of the shingle set, signature, table keys and shingle set of every whole text."""
    from functools import partial

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        orders, key = _orders(), partial(xxh64_intdigest, seed=SEED)
        for frame in small_batches(frames, "text", 1_500_000):
            hashes = [shingle_hashes(t, words) for t in frame["text"]]
            marks = majority([np.unique(h) for h in hashes])  # distinct ones: no repeat decides a bit
            signatures, keys, sets = [], [], []
            for h in hashes:
                signature = _signature(h, orders)
                parts = signature.reshape(TABLES, SAMPLES)
                found = np.array([key(p.tobytes()) for p in parts], np.uint64) if len(h) else np.zeros(0, np.uint64)
                # a byte of each sample tells most pairs apart; sets decide later
                signatures.append((signature >> np.uint64(56)).astype(np.uint8).tobytes())
                keys.append(found.view(np.int64))
                sets.append(np.unique((h >> np.uint64(32)).astype(np.uint32)).view(np.int32))
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "digest": frame["digest"],
                    "fingerprint": marks.view(np.int64),
                    "signature": signatures,
                    "keys": keys,
                    "shingles": sets,
                }
            )

    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    return keyed.mapInPandas(sketch, SKETCH)


def _alike(samples: np.ndarray, i: int) -> np.ndarray:
    """How many samples each column has in common with column ``i``; too few count as none."""
    equal = (samples == samples[:, i : i + 1]).view(np.uint8).sum(axis=0, dtype=np.uint8)
    return np.where(equal >= LEAST * len(samples), equal, 0).astype(np.int64)


def _samples(group: pd.DataFrame) -> np.ndarray:
    held = np.frombuffer(b"".join(group["signature"]), np.uint8).reshape(len(group), -1)
    return np.ascontiguousarray(held.T)


def _nearest(group: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Pairs of each text with its nearest others; a start that settles most texts cheaply."""
    samples, names = _samples(group), list(map(bytes, group["digest"]))
    pairs = set()
    for i in range(len(group)):
        equal = _alike(samples, i)
        equal[i] = 0
        best = np.argsort(-equal, kind="stable")[:NEAREST]
        pairs |= {tuple(sorted((names[i], names[j]))) for j in best[equal[best] > 0].tolist()}
    return sorted(pairs)


def _apart(group: pd.DataFrame) -> list[np.ndarray]:
    """For each text, the others (positions) of another root that its samples call alike."""
    samples, roots = _samples(group), pd.factorize(group["root"].map(bytes))[0]
    return [np.flatnonzero((_alike(samples, i) > 0) & (roots != roots[i])) for i in range(len(group))]


def _verified(group: pd.DataFrame, similarity: float) -> list[tuple[bytes, bytes]]:
    """Pairs of roots, each with texts that are similar as sets; what they connect is not tried again."""
    names, codes = list(map(bytes, group["root"])), pd.factorize(group["root"].map(bytes))[0]
    sizes = group["shingles"].map(len).to_numpy()
    flat = np.unique(np.concatenate(group["shingles"].to_numpy()), return_inverse=True)[1]
    sets = np.split(flat, np.cumsum(sizes)[:-1])
    mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
    links = []
    for i, others in enumerate(_apart(group)):
        mark[sets[i]] = True
        for j in others[others < i].tolist():
            if codes[i] == codes[j]:
                continue
            common = np.count_nonzero(mark[sets[j]])
            if common >= similarity * (sizes[i] + sizes[j] - common):
                links.append((names[i], names[j]))
                codes[codes == codes[j]] = codes[i]
        mark[sets[i]] = False
    return links


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of two or more with equal ``GROUP``, which arrive together."""
    held: list[pd.DataFrame] = []
    now = None
    for frame in frames:
        if not len(frame):
            continue
        at = frame[GROUP].to_numpy()
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
        for a, b in zip(edges, edges[1:], strict=False):
            if held and tuple(at[a]) != now:
                if sum(map(len, held)) > 1:
                    yield pd.concat(held)
                held = []
            now = tuple(at[a])
            held.append(frame.iloc[a:b])
    if sum(map(len, held)) > 1:
        yield pd.concat(held)


def _by_group(rows: DataFrame, function: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """What ``function`` finds in each group."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, out = [x.split()[0] for x in schema.split(", ")], []
        for group in _groups(frames):
            out += function(group)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(walk, schema)


def simhash_pairs(sketched: DataFrame) -> DataFrame:
    """(a, b): pairs of digests whose SimHash fingerprints link; runs jobs.

    A fingerprint is stood for by its least digest, with which all others of it are paired.
    Blank texts have no fingerprint.
    """
    marks = sketched.where(F.size("shingles") > 0).select("digest", "fingerprint").distinct()
    least = written(marks.groupBy("fingerprint").agg(F.min("digest").alias("least")), "marks")
    linked = links(least.select("fingerprint")).where("a <> b")
    ends = {x: least.select(F.col("fingerprint").alias(f"f{x}"), F.col("least").alias(f"l{x}")) for x in "ab"}
    across = linked.join(ends["a"], F.col("a") == F.col("fa")).join(ends["b"], F.col("b") == F.col("fb"))
    within = marks.join(ends["a"], F.col("fingerprint") == F.col("fa")).where("digest <> la")
    found = across.select("la", "lb").union(within.select("la", "digest"))
    return found.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))


def meetings(sketched: DataFrame) -> DataFrame:
    """(digest, signature, table, key, block, blocks) of the texts that meet another in a table.

    Groups are cut into blocks at random, other ones in each table.
    """
    once = sketched.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("signature", "keys")))
    tables = written(once.select("digest", "signature", F.posexplode("keys").alias("table", "key")), "tables")
    sizes = tables.groupBy(F.col("table").alias("t"), F.col("key").alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / CHUNK).cast("int")
    return (
        tables.join(sizes.hint("shuffle_hash"), (F.col("table") == F.col("t")) & (F.col("key") == F.col("k")))
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("digest", "table"), F.col("blocks")).cast("int"))
        .drop("t", "k", "n")
    )


def _blocks(met: DataFrame, own: bool) -> DataFrame:
    """The rows of each block by itself, or of each pair of blocks of a group."""
    other = F.array("block") if own else F.sequence(F.lit(0), F.col("blocks") - 1)
    return met.withColumn("other", F.explode(other)).select(
        "*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def proposals(met: DataFrame) -> DataFrame:
    """(a, b): pairs of digests, each text with the nearest by samples of its block."""
    return _by_group(_blocks(met, True), _nearest, "a binary, b binary").distinct()


def bridges(met: DataFrame, roots: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of roots that are linked by any pair of their texts that meets in a table.

    No pair is left out but for those already connected and those whose samples agree too
    little. Texts with such a pair are found on samples first, and only their sets move.
    """
    roots = roots.select(F.col("node").alias("d"), F.col("root").alias("r")).hint("shuffle_hash")
    rooted = met.join(roots, F.col("digest") == F.col("d"), "left").withColumn("root", F.coalesce("r", "digest")).drop("d", "r")
    rooted = written(rooted, "rooted")
    # groups of a single root have nothing to bridge
    several = rooted.groupBy(F.col("table").alias("t"), F.col("key").alias("k")).agg(F.min("root").alias("x"), F.max("root").alias("y"))
    open_ = rooted.join(
        several.where("x <> y").hint("shuffle_hash"), (F.col("table") == F.col("t")) & (F.col("key") == F.col("k")), "left_semi"
    )

    def alike(group: pd.DataFrame) -> list[tuple]:
        some = [len(x) > 0 for x in _apart(group)]
        return list(group.loc[some, [*GROUP, "digest", "signature", "root"]].itertuples(index=False, name=None)) if any(some) else []

    asked = written(
        _by_group(_blocks(open_, False), alike, "table int, key long, low int, high int, digest binary, signature binary, root binary"), "asked"
    )
    wanted = asked.select(F.col("digest").alias("w")).distinct()
    sets = shingles.select(F.col("digest").alias("d"), "shingles")
    sets = sets.join(wanted.hint("shuffle_hash"), F.col("d") == F.col("w"), "left_semi").groupBy("d").agg(F.first("shingles").alias("shingles"))
    full = asked.join(written(sets, "sets").hint("shuffle_hash"), F.col("digest") == F.col("d")).drop("d")
    return _by_group(full, lambda group: _verified(group, similarity), "a binary, b binary").distinct()


def _joined(roots: DataFrame, higher: DataFrame) -> DataFrame:
    """(node, root) where ``higher`` connects roots, or texts that had none, with each other."""
    higher = higher.select(F.col("node").alias("n"), F.col("root").alias("h"))
    moved = roots.join(higher, F.col("root") == F.col("n"), "left").select("node", F.coalesce("h", "root").alias("root"))
    fresh = higher.join(roots.select(F.col("node").alias("o")), F.col("n") == F.col("o"), "left_anti")
    return written(moved.union(fresh.select(F.col("n").alias("node"), F.col("h").alias("root"))), "roots")


def duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest) of the documents that another one stands for; a stored table.

    Texts are linked if equal, or if their sets of shingles have at least this similarity. Of
    each component the smallest ``doc_id`` stays (null counts as largest). Blank texts have no
    shingles and are linked only if equal. SimHash links and the nearest by samples are verified
    first, then what else meets. Runs jobs.
    """
    sketched = written(sketches(docs, words), "sketches")
    met = written(meetings(sketched), "meetings")
    pairs = written(simhash_pairs(sketched).union(proposals(met)).distinct(), "proposals")
    sets = sketched.select(F.col("digest").alias("d"), "shingles")
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct(), "wanted")
    sets = written(
        sets.join(wanted.hint("shuffle_hash"), F.col("d") == F.col("w"), "left_semi").groupBy("d").agg(F.first("shingles").alias("s")), "sets"
    )
    both = (
        pairs.join(sets.withColumnsRenamed({"d": "da", "s": "sa"}), F.col("a") == F.col("da"))
        .join(sets.withColumnsRenamed({"d": "db", "s": "sb"}), F.col("b") == F.col("db"))
        .withColumn("common", F.size(F.array_intersect("sa", "sb")))
    )
    near = F.col("common") >= similarity * (F.size("sa") + F.size("sb") - F.col("common"))
    roots = components(written(both.where(near).select("a", "b"), "similar"))
    more = written(bridges(met, roots, sketched.select("digest", "shingles"), similarity), "bridges")
    if not more.isEmpty():
        roots = _joined(roots, components(more))
    rooted = (
        sketched.select("doc_id", "digest")
        .join(roots.withColumnRenamed("root", "r"), F.col("digest") == F.col("node"), "left")
        .select("doc_id", "digest", F.coalesce("r", "digest").alias("root"))
    )
    rooted = written(rooted, "rooted")
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    keepers = rooted.groupBy("root").agg(F.min(F.struct(last.alias("k"), F.col("digest").alias("g"))).alias("keep"))
    keepers = written(keepers.select(F.col("root").alias("of"), "keep.k", "keep.g"), "keepers")
    gone = rooted.join(keepers, F.col("root") == F.col("of")).where((last != F.col("k")) | (F.col("digest") != F.col("g")))
    return written(gone.select("doc_id", "digest").distinct(), "duplicates")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of copies; columns stay as they are."""
    # texts move once, to the names, at every size
    d, g, own = unused(docs, "_d", "_g", "_digest")
    gone = duplicates(docs).withColumnsRenamed({"doc_id": d, "digest": g}).hint("shuffle_hash")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    kept = docs.withColumn(own, digest).join(
        gone, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(g)), "left_anti"
    )
    # rows equal in id and text stand for each other too; ids are hardly ever repeated
    repeated = docs.groupBy("doc_id", digest.alias("g")).count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.select(*docs.columns)
