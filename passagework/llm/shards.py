"""Token ids in training order: fixed-stride shards by a keyed permutation.

Documents' ids (each with its end) are joined within blocks and cut into sequences of one
length. A keyed Feistel network, walked until it falls below the number of sequences, is
a bijection that gives every sequence a global slot: the order is as good as shuffled, and
any slot can be traced back. Which documents share a sequence depends on the splits that
tasks read: the order is that of the shards once written, which resuming reads, and a
rewrite under other splits is another order. Ranges of slots are shards, in
which sequence i of a shard starts at i times the stride, so reading is sequential and may
resume anywhere.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.common import shared_fs, small_batches, texts
from passagework.llm.packing import END_ID, SEQ_LEN, encoder
from passagework.session import scratch_path, written

BLOCK = 16 << 20
SHARD = 32_768
ROUNDS = 6
KEY = 20
ID = np.dtype("<u2")
BLOCKS = "block long, part int, sequences long, tokens long, packet binary"
PLACED = "slot long, shard long, n_tokens int, ids binary"
MANIFEST = (
    "shard long, path string, first_slot long, sequences long, stride long, "
    "short array<struct<slot: long, n_tokens: int>>"
)
READ = "slot long, shard long, offset long, n_tokens long, ids_crc32 long"


def _round(half: np.ndarray, key: int, number: int, mask: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64(mask)


def feistel(values: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """A bijection of 0..n-1 chosen by ``key``; ``inverse`` undoes it."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = (1 << bits) - 1, np.uint64(bits)
    out = values.astype(np.uint64)
    left_to_do = np.arange(len(out))
    while len(left_to_do):  # walk the cycle until the value is in range
        x = out[left_to_do]
        a, b = x >> shift, x & np.uint64(mask)
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                a, b = b ^ _round(a, key, r, mask), a
            else:
                a, b = b, a ^ _round(b, key, r, mask)
        out[left_to_do] = (a << shift) | b
        left_to_do = left_to_do[out[left_to_do] >= n]
    return out.astype(np.int64)


def token_blocks(docs: DataFrame, seq_len: int = SEQ_LEN, vocabulary: str | None = None) -> DataFrame:
    """Blocks of token ids, compressed. A block's last sequence is filled up with the end id."""

    def tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode_to_numpy
        held: list[np.ndarray] = []
        size = number = 0

        def close() -> pd.DataFrame:
            nonlocal held, size, number
            ids = np.concatenate(held)
            row = ((part << 32) + number, part, -(-len(ids) // seq_len), len(ids), zstandard.compress(ids.tobytes(), 9))
            held, size, number = [], 0, number + 1
            return pd.DataFrame([row], columns=[x.split()[0] for x in BLOCKS.split(", ")])

        for frame in small_batches(frames, "text", 1 << 20):
            for text in frame["text"]:
                held.append(np.append(encode(text, allowed_special="all"), END_ID).astype(ID))
                size += len(text)
                if size >= BLOCK:
                    yield close()
        if held:
            yield close()

    return texts(docs).mapInPandas(tokens, BLOCKS)


def numbered(blocks: DataFrame) -> DataFrame:
    """Add ``base``, the number of sequences in earlier blocks: sums per task first, then within."""
    parts = blocks.groupBy("part").agg(F.sum("sequences").alias("n"))
    # one row per task that read documents, not per document
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.select("block", "part", (F.coalesce(F.sum("sequences").over(within), F.lit(0))).alias("own"))
    return own.join(parts, F.col("part") == F.col("p")).select(
        F.col("block").alias("b"), (F.col("from") + F.col("own")).alias("base")
    )


def write_shards(
    docs: DataFrame, folder: str, seq_len: int = SEQ_LEN, per_shard: int = SHARD, key: int = KEY
) -> tuple[DataFrame, int]:
    """Write ``docs`` (null texts: just an end) as shards in ``folder``: (manifest, sequences).

    Files are named by attempt; those that count are the ones in the manifest, which Spark
    commits, so that a task may run twice. An empty table gives no shard. Runs jobs.
    """
    blocks = written(token_blocks(docs, seq_len), "tokens")
    total = blocks.agg(F.coalesce(F.sum("sequences"), F.lit(0))).first()[0]
    bases = written(numbered(blocks.drop("packet")), "bases")
    stride = seq_len * ID.itemsize

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        pack = zstandard.ZstdCompressor(3).compress
        for frame in frames:
            for row in frame.itertuples():
                raw = zstandard.decompress(row.packet)
                raw += np.full(-len(raw) // ID.itemsize % seq_len, END_ID, ID).tobytes()
                slots = feistel(np.arange(row.base, row.base + row.sequences), total, key)
                sizes = np.full(row.sequences, seq_len)
                sizes[-1] = row.tokens - (row.sequences - 1) * seq_len
                for a in range(0, len(slots), 1024):
                    part = slots[a : a + 1024]
                    # sequences move compressed, each by itself
                    ids = [pack(raw[i * stride : (i + 1) * stride]) for i in range(a, a + len(part))]
                    yield pd.DataFrame({"slot": part, "shard": part // per_shard, "n_tokens": sizes[a : a + len(part)], "ids": ids})

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        fs, root = shared_fs(folder)
        fs.create_dir(root, recursive=True)
        unpack = zstandard.ZstdDecompressor().decompress
        now, out, row = None, None, None

        def close() -> pd.DataFrame:
            out.close()
            names = ["shard", "path", "first_slot", "sequences", "stride", "short"]
            return pd.DataFrame([row], columns=names)

        for frame in frames:
            columns = (frame[c] for c in ("slot", "shard", "n_tokens", "ids"))
            for slot, shard, n_tokens, ids in zip(*columns, strict=True):
                if shard != now:
                    if out:
                        yield close()
                    name = f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
                    out, now = fs.open_output_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20), shard
                    row = [shard, os.path.join(folder, name), slot, 0, stride, []]
                out.write(unpack(ids))
                row[3] += 1
                if n_tokens < seq_len:  # at most one a block of texts
                    row[5].append({"slot": slot, "n_tokens": n_tokens})
        if out:
            yield close()

    placed = blocks.join(bases, F.col("block") == F.col("b")).select("base", "sequences", "tokens", "packet")
    # a task a shard, whatever their number
    shards = placed.mapInPandas(place, PLACED).repartitionById(max(1, -(-total // per_shard)), F.col("shard").cast("int"))
    shards = shards.sortWithinPartitions("shard", "slot")
    return written(shards.mapInPandas(write, MANIFEST), "manifest"), total


def read_shards(manifest: DataFrame, first_slot: int = 0) -> DataFrame:
    """A row per sequence from ``first_slot`` on, read in order of slots within each shard.

    ``n_tokens`` leaves out what fills a sequence up, as the manifest tells; ``ids_crc32`` is of
    all its ids as little-endian 16-bit numbers.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zlib import crc32

        for frame in frames:
            for row in frame.itertuples():
                fs, path = shared_fs(row.path)
                short = {x["slot"]: x["n_tokens"] for x in row.short}
                skip = max(0, first_slot - row.first_slot)
                if skip >= row.sequences:
                    continue
                with fs.open_input_file(path) as file:
                    for at in range(skip, row.sequences, 512):
                        count = min(512, row.sequences - at)
                        raw = file.read_at(count * row.stride, at * row.stride)
                        ids = np.frombuffer(raw, ID).reshape(count, -1)
                        slots = row.first_slot + np.arange(at, at + count)
                        yield pd.DataFrame(
                            {
                                "slot": slots,
                                "shard": row.shard,
                                "offset": np.arange(at, at + count) * row.stride,
                                "n_tokens": [short.get(slot, ids.shape[1]) for slot in slots.tolist()],
                                "ids_crc32": [crc32(x.tobytes()) for x in ids],
                            }
                        )

    # a row is a whole shard: rows few in bytes are not few in work, so their number is given
    return manifest.repartition(max(1, manifest.count()), "path").mapInPandas(read, READ)


def training_order(docs: DataFrame, seq_len: int = SEQ_LEN, per_shard: int = SHARD, key: int = KEY) -> DataFrame:
    """Write the shards to the shared folder, read them back, and trace each slot to its sequence."""
    manifest, total = write_shards(docs, scratch_path(docs.sparkSession, "shards"), seq_len, per_shard, key)

    @F.pandas_udf("long")
    def sequence(slot: pd.Series) -> pd.Series:
        return pd.Series(feistel(slot.to_numpy(), total, key, inverse=True))

    return read_shards(manifest).select(sequence("slot").alias("sequence_id"), "*")
