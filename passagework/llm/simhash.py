"""Near-duplicates by SimHash, with tables of distances to reference fingerprints.

Fingerprints that link differ in at most ``radius`` = 3 bits. Cut into six blocks, such
a pair agrees in three of them, so pairs meet under one of 20 keys of 32 bits each.
Under a key, the precomputed distances to many reference fingerprints (pivots) discard
a pair when any of them differs by more than the radius - by the triangle inequality no
link is lost - and the survivors are verified bit by bit. A key's group gives a spanning
forest of its links, never all its pairs. A group of more than ``GROUP`` fingerprints is
split: its members meet anew under keys of 48 bits, which 65,536 fingerprints can share
at most, so no group is without a bound and none is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, texts
from passagework.llm.graph import components
from passagework.session import written

SHINGLE = 3
RADIUS = 3
SEED = 42
PIVOTS = 16
GROUP = 4096


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: fixed random bits, the same in every run."""
    draw = np.random.default_rng(SEED).integers(0, 1 << 64, n, dtype=np.uint64)
    return [_signed(int(x)) for x in draw]


def _masks(bits: list[int]) -> list[int]:
    """Six blocks of the given bits; each choice of three as a mask."""
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(bits, 6)]
    return [sum(c) for c in combinations(blocks, 3)]


MASKS = _masks(list(range(64)))
#: For each mask, the choices of three of six blocks of the bits that it leaves open.
FINER = [[m | x for x in _masks([b for b in range(64) if not m >> b & 1])] for m in MASKS]


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles, repeats included; see ``fingerprints``."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split()  # both touch ASCII only
    if not found:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(words, len(found)) - 1 :].tolist()
    return np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n], ends, strict=True)),
        np.uint64,
        n,
    )


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """A fingerprint for each array: bits set in over half its hashes."""
    sizes = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        flat = np.concatenate([hashes[i] for i in some])
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        chosen = np.packbits(2 * ones > sizes[some][:, None], axis=1, bitorder="little")
        out[some] = np.ascontiguousarray(chosen).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint) of every whole text, A-Z lowered.

    Words are runs without ASCII white space. A text of fewer words than a shingle is one
    shingle; null, empty and blank texts have the fingerprint zero.
    """

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames, "text", 1_500_000):
            marks = majority([shingle_hashes(t, words) for t in frame["text"]])
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64"), "fingerprint": marks.view(np.int64)}
            )

    return texts(docs, "doc_id").mapInPandas(hashed, "doc_id long, fingerprint long")


def pivot_distances(fingerprint: Column, n: int = PIVOTS) -> Column:
    """The table's row of a fingerprint: Hamming distances to all pivots."""
    return F.array(
        *(F.bit_count(fingerprint.bitwiseXOR(F.lit(p))).cast("byte") for p in pivots(n))
    )


def _forest(marks: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what ``radius`` connects, one fewer than members at most."""
    left, links = np.arange(len(marks)), []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.flatnonzero(np.abs(table[left] - table[at]).max(axis=1) <= radius)
            near = near[np.bitwise_count(marks[left[near]] ^ marks[at]) <= radius]
            if len(near):
                found = left[near]
                links += [(int(marks[at]), int(marks[x])) for x in found]
                frontier += found.tolist()
                left = np.delete(left, near)
    return links


def _links(keyed: DataFrame, radius: int, most: int) -> DataFrame:
    """Links within each key's group; of larger groups, the members (``a`` null, ``mask`` set).

    Rows of a key arrive together and sorted; a task holds one group of ``most`` at a time.
    """

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        held_key, large = None, False

        def close() -> list[tuple]:
            if large or not held:
                return []
            group = pd.concat(held) if len(held) > 1 else held[0]
            if len(group) < 2:
                return []
            marks = group["fingerprint"].to_numpy().view(np.uint64)
            table = np.stack(group["distances"].to_numpy()).astype(np.int16)
            view = np.array(_forest(marks, table, radius), np.uint64).reshape(-1, 2).view(np.int64)
            return [(int(a), int(b), None) for a, b in view]

        for frame in frames:
            mask, key = frame["mask"].to_numpy(), frame["key"].to_numpy()
            edges = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            edges = [0, *edges.tolist(), len(frame)]
            out: list[tuple] = []
            for a, b in zip(edges, edges[1:], strict=False):
                if (mask[a], key[a]) != held_key:
                    out += close()
                    held, held_key, large = [], (mask[a], key[a]), False
                    if b < len(frame) and b - a == 1:
                        continue  # alone under its key
                if large:
                    out += [(None, int(x), int(mask[a])) for x in frame["fingerprint"].iloc[a:b]]
                    continue
                held.append(frame.iloc[a:b])
                if sum(map(len, held)) > most:
                    for part in held:
                        out += [(None, int(x), int(mask[a])) for x in part["fingerprint"]]
                    held, large = [], True
            yield pd.DataFrame(out, columns=["a", "b", "mask"], dtype="object")
        yield pd.DataFrame(close(), columns=["a", "b", "mask"], dtype="object")

    return (
        keyed.repartition("mask", "key")
        .sortWithinPartitions("mask", "key")
        .mapInPandas(walk, "a long, b long, mask int")
    )


def links(marks: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links (a, b) between the distinct values of ``fingerprint`` in ``marks``, as a stored table.

    All fingerprints within ``radius`` (3 at most) are connected by links, each of which is
    within ``radius``. Runs jobs.
    """
    if not 0 <= radius <= 3:
        raise ValueError("three of six blocks agree up to three differing bits")
    mark = F.col("fingerprint")
    distances = pivot_distances(mark).alias("distances")
    keys = F.posexplode(F.array(*(mark.bitwiseAND(F.lit(_signed(m))) for m in MASKS)))
    keyed = marks.select(mark, distances, keys.alias("mask", "key"))
    first = written(_links(keyed, radius, group), "links")
    pairs = first.where("a IS NOT NULL").select("a", "b")
    over = first.where("a IS NULL").select(F.col("b").alias("fingerprint"), F.col("mask").alias("m"))
    if over.isEmpty():
        return pairs.distinct()
    finer = F.element_at(
        F.array(*(F.array(*(F.lit(_signed(x)) for x in row)) for row in FINER)), F.col("m") + 1
    )
    again = (
        over.select("fingerprint", "m", F.posexplode(finer).alias("k", "bits"))
        .select(
            mark,
            distances,
            (F.col("m") * len(MASKS) + F.col("k")).alias("mask"),
            mark.bitwiseAND(F.col("bits")).alias("key"),
        )
    )
    second = written(_links(again, radius, 1 << 17), "links")
    return pairs.union(second.select("a", "b")).distinct()


def simhash_components(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest ``doc_id`` that links reach.

    One row per input row. Rows of equal fingerprint are linked; rows without a
    ``doc_id`` take part and don't name a component unless no other does (then null).
    """
    marks = written(fingerprints(docs, words), "fingerprints")
    nodes = written(marks.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(
        rooted.join(named, "root").select(F.col("fingerprint").alias("f"), "component_id"), "classes"
    )
    return marks.join(classes, F.col("fingerprint") == F.col("f")).select(
        "doc_id", "fingerprint", "component_id"
    )
