"""Exact removal of long repeated substrings by induced suffix sorting.

A byte goes if a string of ``length`` = 400 bytes that covers it starts anywhere else too.

Not all suffixes are sorted, and no shard is held whole. Each 400-byte string has an
anchor, the least-hashed 128-byte run in it, so equal strings have equal anchors at equal
places. Only suffixes that start at anchors which occur more than once are sorted: Spark's
external sort, which spills sorted runs to disk and merges them, plays the disk-backed
priority queue and hands out (anchor, suffix) tuples in order. From adjacent ones come
common-prefix values, and the order of all other suffixes of interest is induced from
theirs leftward, byte by byte: at distance a, suffixes are ordered by (class of the a
bytes before the anchor, rank of the anchor's suffix), and their common prefix is a plus
the least value between the two ranks. Two strings are equal when that reaches 400.

A flag tells of shorter passages too: runs of ``GRAM`` words are sampled by winnowing, which
picks at least one from any ``GRAM + SAMPLE - 1`` = 51 words in a row, and the same one
wherever these stand. A document shares a passage if one of its sampled runs stands
elsewhere too, or if it loses bytes. Nothing is removed by that.

Before any bytes move, runs of consecutive strings with one anchor are compared by a
digest: copies collapse to a count and one representative, so that a group of copies
costs a row each. A group that still has more than ``GROUP`` different members is split
by content: its strings are counted by their digests.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, texts
from passagework.session import written

LENGTH = 400
ANCHOR = 128
BLOCK, SLICE = 16 << 20, 1 << 20
GROUP, BATCH = 50_000, 20_000
GRAM, SAMPLE = 40, 12
_BASE = 0x9E3779B97F4A7C15
RUNS = "block long, doc int, anchor long, digest long, at int, more int, before int, again int, packet binary"
CONTEXTS = "block long, doc int, at int, anchor long, right binary, left binary"
SPANS = "block long, doc int, at int, last int, digest binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, shares_passage boolean"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(32))


def anchor_runs(line: np.ndarray, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of string starts that share an anchor: (first, last, anchor's place, its hash).

    ``line`` is texts end to end, fewer than 2^21 bytes or one text; ``ends`` where they end.
    """
    n = len(line)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty
    up, down = _powers(n + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((line.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)))
    hashes = _mixed((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    low = np.uint64((1 << 21) - 1)
    width = length - anchor + 1
    place = np.arange(len(hashes), dtype=np.uint64)
    value = (hashes & ~low) | (place & low)
    pad = -len(value) % width
    grid = np.concatenate([value, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    prefix = np.minimum.accumulate(grid, axis=1).ravel()
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(suffix[:count], prefix[width - 1 : width - 1 + count])
    starts = np.concatenate(([0], ends[:-1]))
    fits = np.zeros(count + 1, np.int64)
    long = ends - starts >= length
    np.add.at(fits, starts[long], 1)
    np.add.at(fits, ends[long] - length + 1, -1)
    good = np.flatnonzero(np.cumsum(fits[:count]) > 0)
    if not len(good):
        return empty, empty, empty, empty
    spot = (least[good] & low).astype(np.int64)
    cut = np.flatnonzero((np.diff(spot) != 0) | (np.diff(good) != 1)) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(good)])) - 1
    return good[first], good[last], spot[first], hashes[spot[first]].view(np.int64)


def _text_parts(codes: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray]]:
    """Texts in groups of about ``SLICE`` bytes; longer ones in pieces that overlap.

    Gives each piece's text number and place in it, the pieces end to end, and their ends.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out():
        line = b"".join(x[2] for x in held)
        return [x[0] for x in held], [x[1] for x in held], line, np.cumsum([len(x[2]) for x in held])

    for d, code in enumerate(codes):
        if len(code) < length:
            continue
        for a in range(0, max(1, len(code) - length + 1), SLICE):
            piece = code[a : a + SLICE + length - 1]
            if size and size + len(piece) > SLICE:
                yield out()
                held, size = [], 0
            held.append((d, a, piece))
            size += len(piece)
    if held:
        yield out()


def _runs(codes: list[bytes], length: int, anchor: int) -> pd.DataFrame:
    """A row per run: its text and first start, how many follow, and a digest of all it covers.

    Equal runs one after the other (of texts that repeat themselves) are one row, ``again`` > 0.
    """
    rows: list[list[int]] = []
    for docs, places, line, ends in _text_parts(codes, length):
        first, last, spot, hashes = anchor_runs(np.frombuffer(line, np.uint8), ends, length, anchor)
        owner = np.searchsorted(ends, first, "right").tolist()
        starts = [0, *ends[:-1].tolist()]
        for p, q, x, h, o in zip(first.tolist(), last.tolist(), spot.tolist(), hashes.tolist(), owner, strict=True):
            salt = (x - p).to_bytes(4, "little") + (q - p).to_bytes(4, "little")
            digest = hashlib.blake2b(line[p : q + length], digest_size=8, salt=salt).digest()
            digest = int.from_bytes(digest, "little", signed=True)
            at = p - starts[o] + places[o]
            old = rows[-1] if rows else None
            if old and old[0] == docs[o] and old[2] == digest and q == p and at == old[3] + old[6] + 1 and not old[4]:
                old[6] += 1
            else:
                rows.append([docs[o], h, digest, at, q - p, x - p, 0])
    return pd.DataFrame(rows, columns=["doc", "anchor", "digest", "at", "more", "before", "again"])


def word_marks(codes: list[bytes], gram: int = GRAM, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, mark) of the sampled runs of words: those least in hash among ``sample`` runs in a row."""
    import xxhash

    known: dict[bytes, int] = {}
    split = [code.split() for code in codes]
    sizes = np.array([len(x) for x in split])
    n = int(sizes.sum())
    if n < gram:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    for words in split:
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
    hashes = np.fromiter((known[w] for words in split for w in words), np.uint64, n)
    up, down = _powers(n + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * up[:n], dtype=np.uint64)))
    runs = _mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    owner = np.repeat(np.arange(len(codes)), sizes)
    # only windows of runs that lie within one text, so that its marks don't hang on its neighbours
    windows = max(0, len(runs) - sample + 1)
    within = owner[:windows] == owner[gram + sample - 2 :][:windows]
    least = runs[:windows].copy()
    for k in range(1, sample):
        least = np.minimum(least, runs[k : k + windows])
    chosen = np.zeros(len(runs), bool)
    for k in range(sample):
        chosen[k : k + windows] |= within & (runs[k : k + windows] == least)
    chosen = np.flatnonzero(chosen)
    return owner[chosen], runs[chosen].view(np.int64)


def _marks(codes: list[bytes]) -> pd.DataFrame:
    """Marks of a block as rows like those of its runs, at -1; a few texts at a time."""
    parts, start, size = [], 0, 0
    for i, code in enumerate([*codes, None]):
        if code is None or size > SLICE:
            doc, mark = word_marks(codes[start:i])
            parts.append(pd.DataFrame({"doc": doc + start, "anchor": mark}))
            start, size = i, 0
        size += len(code or b"")
    made = pd.concat(parts, ignore_index=True)
    return made.assign(digest=0, at=-1, more=0, before=0, again=0)


def blocks(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """Blocks of documents (``packet``), the runs of each, and marks of its words (at -1)."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        rows: list[tuple] = []
        number, size = TaskContext.get().partitionId() << 32, 0

        def close() -> Iterator[pd.DataFrame]:
            nonlocal rows, number
            if not rows:
                return
            ids, codes = map(list, zip(*rows, strict=True))
            found = pd.concat([_runs(codes, length, anchor), _marks(codes)], ignore_index=True)
            found.insert(0, "block", number)
            found["packet"] = None
            for a in range(0, len(found), 50_000):
                yield found.iloc[a : a + 50_000]
            packet = zstandard.compress(pickle.dumps((ids, codes)), 3)
            names = [x.split()[0] for x in RUNS.split(", ")]
            yield pd.DataFrame([[number, *[None] * (len(names) - 2), packet]], columns=names)
            rows, number = [], number + 1

        for frame in small_batches(frames, "text", 1 << 20):
            ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
            for doc_id, text in zip(ids, frame["text"], strict=True):
                code = text.encode()
                if size and size + len(code) > BLOCK:
                    yield from close()
                    size = 0
                rows.append((doc_id, code))
                size += len(code)
        yield from close()

    return texts(docs, "doc_id").mapInPandas(cut, RUNS)


def _packed(values: list[bytes], width: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(v) for v in values])
    out = np.zeros((len(values), width), np.uint8)
    for row, v in zip(out, values, strict=True):
        if v:
            row[: len(v)] = np.frombuffer(v, np.uint8)[::-1] if reverse else np.frombuffer(v, np.uint8)
    return out, sizes


def induce(anchors: np.ndarray, rights: list[bytes], lefts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, distance) of all strings that have an equal one among the members.

    Members are suffixes that start at an anchor, sorted by (anchor, suffix); ``lefts`` are the
    bytes before them. A string at distance a is a bytes of the left and length - a of the right.
    """
    n = len(anchors)
    suffix, sizes = _packed(rights, length)
    other = suffix[1:] != suffix[:-1]
    common = np.where(other.any(axis=1), other.argmax(axis=1), length)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    levels = [np.append(common, 0).astype(np.int32)]  # least common prefix over 2^k neighbours
    while 2 << (len(levels) - 1) < n:
        half = 1 << (len(levels) - 1)
        low = levels[-1].copy()
        low[:-half] = np.minimum(levels[-1][:-half], levels[-1][half:])
        levels.append(low)
    table = np.stack(levels)
    before, reach = _packed(lefts, max([1, *map(len, lefts)]), reverse=True)
    active = np.arange(n)
    group = np.cumsum(np.concatenate(([0], anchors[1:] != anchors[:-1])))
    who, far = [], []
    for a in range(before.shape[1] + 1):
        if a:
            keep = reach[active] >= a
            active, group = active[keep], group[keep]
            key = group * 256 + before[active, a - 1]
            order = np.argsort(key, kind="stable")
            active, key = active[order], key[order]
            group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) if len(key) else key
        if len(active) < 2:
            break
        same = group[1:] == group[:-1]
        i, j = active[:-1][same], active[1:][same]
        level = np.frexp((j - i).astype(float))[1] - 1
        least = np.minimum(table[level, i], table[level, j - (1 << level)])
        equal = least >= length - a
        found = np.unique(np.concatenate([i[equal], j[equal]]))
        who.append(found)
        far.append(np.full(len(found), a))
        both = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        active, group = active[both], group[both]
    return (np.concatenate(who), np.concatenate(far)) if who else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _induced(contexts: DataFrame, length: int) -> DataFrame:
    """Starts of repeated strings as ranges (at, last); of groups too large, starts with digests."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size, large = 0, None
        names = [x.split()[0] for x in SPANS.split(", ")]

        def close() -> Iterator[pd.DataFrame]:
            nonlocal held, size
            if size > 1:
                rows = pd.concat(held, ignore_index=True)
                who, far = induce(rows["anchor"].to_numpy(), rows["right"].tolist(), rows["left"].tolist(), length)
                if len(who):
                    at = rows["at"].to_numpy()[who] + rows["left"].str.len().to_numpy()[who] - far
                    yield pd.DataFrame(
                        {"block": rows["block"].to_numpy()[who], "doc": rows["doc"].to_numpy()[who], "at": at, "last": at, "digest": None}
                    )
            held, size = [], 0

        def split(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for row in rows.itertuples():
                line = row.left + row.right
                out = [
                    (row.block, row.doc, row.at + p, row.at + p, hashlib.blake2b(line[p : p + length], digest_size=16).digest())
                    for p in range(len(line) - length + 1)
                ]
                yield pd.DataFrame(out, columns=names)

        for frame in frames:
            anchors = frame["anchor"].to_numpy()
            edges = [0, *(np.flatnonzero(anchors[1:] != anchors[:-1]) + 1).tolist(), len(frame)]
            for a, b in zip(edges, edges[1:], strict=False):
                if large == anchors[a]:
                    yield from split(frame.iloc[a:b])
                    continue
                new = not held or held[-1]["anchor"].iloc[-1] != anchors[a]
                if new and size >= BATCH:
                    yield from close()
                held.append(frame.iloc[a:b])
                size += b - a
                if size > GROUP:  # the last group may be the only one
                    mine = [x[x["anchor"] == anchors[a]] for x in held]
                    if sum(map(len, mine)) > GROUP - BATCH:
                        held = [x[x["anchor"] != anchors[a]] for x in held]
                        held = [x for x in held if len(x)]
                        size, large = sum(map(len, held)), anchors[a]
                        yield from close()
                        for x in mine:
                            yield from split(x)
                        continue
        yield from close()

    return contexts.repartition("anchor").sortWithinPartitions("anchor", "right").mapInPandas(walk, SPANS)


def repeated_starts(runs: DataFrame, packets: DataFrame, length: int) -> DataFrame:
    """(block, doc, at, last): starts of all strings that occur elsewhere too. Runs jobs."""
    counted = runs.withColumn("places", F.col("again") + 1)
    shared = counted.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1").select(F.col("anchor").alias("a"))
    # stored, so that the join can split an anchor that a large share of the rows has
    alike = written(counted.join(written(shared, "anchors"), F.col("anchor") == F.col("a"), "left_semi"), "alike")
    where = F.struct("block", "doc", "at")
    kinds = written(
        alike.groupBy("anchor", "digest").agg(F.sum("places").alias("n"), F.min(where).alias("of")), "kinds"
    )
    several = written(
        kinds.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select(F.col("anchor").alias("a")), "several"
    )
    many = kinds.where("n > 1").select(F.col("anchor").alias("a"), F.col("digest").alias("g"))
    copies = alike.join(
        written(many, "many"), (F.col("anchor") == F.col("a")) & (F.col("digest") == F.col("g")), "left_semi"
    ).select("block", "doc", "at", (F.col("at") + F.col("again") + F.col("more")).alias("last"))
    # one of each kind, where an anchor has several kinds, goes on to be compared
    chosen = kinds.join(several, F.col("anchor") == F.col("a"), "left_semi").select(
        F.col("of.block").alias("b"), F.col("of.doc").alias("d"), F.col("of.at").alias("p")
    )
    pending = alike.join(
        written(chosen, "chosen"), (F.col("block") == F.col("b")) & (F.col("doc") == F.col("d")) & (F.col("at") == F.col("p")), "left_semi"
    ).select("block", "doc", "at", "more", "before", "anchor")

    def contexts(held: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        for packet in held["packet"]:
            _, codes = pickle.loads(zstandard.decompress(packet))
            out = [
                (r.block, r.doc, r.at, r.anchor, codes[r.doc][r.at + r.before : r.at + r.more + length], codes[r.doc][r.at : r.at + r.before])
                for r in rows.itertuples()
            ]
            return pd.DataFrame(out, columns=[x.split()[0] for x in CONTEXTS.split(", ")])
        return pd.DataFrame(columns=[x.split()[0] for x in CONTEXTS.split(", ")])

    found = packets.groupBy("of").cogroup(pending.groupBy("block")).applyInPandas(contexts, CONTEXTS)
    induced = written(_induced(found, length), "induced")
    split = induced.where("digest IS NOT NULL")
    spans = copies.union(induced.where("digest IS NULL").select("block", "doc", "at", "last"))
    if split.isEmpty():
        return spans
    again = split.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("g"))
    return spans.union(split.join(again, F.col("digest") == F.col("g"), "left_semi").select("block", "doc", "at", "last"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Per row: bytes, removed bytes, removed spans and the digest of what is kept.

    Texts are whole UTF-8 texts (null: empty); strings don't cross documents, overlap counts, and
    the same document counts as elsewhere. ``shares_passage`` is true for documents that lose
    bytes, and for those with 51 words in a row that start elsewhere too; below 40 words it
    never is by words alone. Runs jobs; texts move compressed, twice.
    """
    held = written(blocks(docs, length, anchor), "runs")
    runs = held.where("packet IS NULL AND at >= 0").drop("packet")
    packets = held.where("packet IS NOT NULL").select(F.col("block").alias("of"), "packet")
    spans = repeated_starts(runs, packets, length)
    marks = held.where("packet IS NULL AND at < 0").select("block", "doc", "anchor")
    often = marks.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(F.col("anchor").alias("a"))
    alike = marks.join(written(often, "marks"), F.col("anchor") == F.col("a"), "left_semi").select("block", "doc").distinct()
    flags = written(alike, "flags").select("block", "doc", F.lit(-1).alias("at"), F.lit(-1).alias("last"))
    spans = spans.union(flags)

    def cut(held: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        out = []
        flagged = set(spans["doc"][spans["at"] < 0])
        by_doc = {d: (x["at"].to_numpy(), x["last"].to_numpy()) for d, x in spans[spans["at"] >= 0].groupby("doc")}
        for packet in held["packet"]:
            ids, codes = pickle.loads(zstandard.decompress(packet))
            for d, (doc_id, code) in enumerate(zip(ids, codes, strict=True)):
                removed = spans_of = 0
                if d in by_doc:
                    marks = np.zeros(len(code) + 1, np.int64)
                    np.add.at(marks, by_doc[d][0], 1)
                    np.add.at(marks, by_doc[d][1] + length, -1)
                    gone = np.cumsum(marks[:-1]) > 0
                    removed, spans_of = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(code, np.uint8)[~gone].tobytes()
                else:
                    kept = code
                shares = removed > 0 or d in flagged
                out.append((doc_id, len(code), removed, spans_of, hashlib.sha256(kept).hexdigest(), shares))
        made = pd.DataFrame(out, columns=[x.split()[0] for x in RESULT.split(", ")])
        made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    return packets.groupBy("of").cogroup(spans.groupBy("block")).applyInPandas(cut, RESULT)
