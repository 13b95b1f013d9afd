"""Best-fit packing by a plan over the histogram of lengths.

The driver packs *counts*: at most ``capacity`` lengths, each with the number of
pieces that have it, are placed longest first into the tightest open space. The plan
is a short list of placements, whose size depends on the capacity and not on the
corpus. Pieces then find their place by joining on their rank within their length.

Ranks are not taken by a window over a whole length, which may be shared by a third of
all pieces: pieces are dealt to (length, bucket) groups, the groups' counts give each
group its first rank, and only within a group rows are numbered.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.common import partitions, small_batches, texts, worker_cache
from passagework.session import written

SEQ_LEN = 1024
END_ID = 2
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACEMENT_SCHEMA = (
    "at_length long, first_rank long, items long, first_sequence long, per_sequence long, at_offset long"
)


def load_encoder(path: str | None = None):
    """The byte-level vocabulary of ``byte_bpe_50k.json``, read from its file of ranks.

    Both files hold the same vocabulary and give equal ids (tested); the encoder of the
    rank file is about six times as fast. Strings of special tokens in a text become
    special ids, as in the other library by default.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "byte_bpe_50k",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens=SPECIAL,
    )


def encoder(path: str | None = None):
    return worker_cache(f"encoder {path}", lambda: load_encoder(path))


def token_pieces(
    docs: DataFrame,
    seq_len: int = SEQ_LEN,
    end_id: int = END_ID,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Token ids of every document, cut into pieces of at most ``seq_len``.

    A document is its text's ids, then ``end_id``; null and empty texts are just the
    end. Only longer documents are cut, and then the first piece is the shorter one.
    ``with_ids`` adds the ids themselves. Equal rows each give their pieces.
    """
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zlib import crc32

        encode = encoder(vocabulary).encode_to_numpy
        for frame in small_batches(frames, "text", 4_000_000):
            out: list[tuple] = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = np.append(encode(text, allowed_special="all"), end_id).astype("<u4")
                first = len(ids) % seq_len or seq_len
                edges = [0, *range(first, len(ids) + 1, seq_len)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    row = (doc_id, k, a, b - a, crc32(ids[a:b].tobytes()))
                    out.append((*row, ids[a:b].astype("i4")) if with_ids else row)
            names = [x.split()[0] for x in schema.split(", ")]
            made = pd.DataFrame(out, columns=names)
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    return texts(docs, "doc_id").mapInPandas(cut, schema)


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: placements (see ``PLACEMENT_SCHEMA``).

    Sequences with equal free space are one run of consecutive numbers. All pieces of a
    length go to the tightest run first, as many per sequence as fit, which is what
    best-fit does piece by piece. Piece ``first_rank + i`` of its length goes to sequence
    ``first_sequence + i // per_sequence`` at ``at_offset + i % per_sequence * length``.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)
    placements: list[tuple[int, int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = min((r for r, runs in free.items() if r >= length and runs), default=0)
            if room:
                first, n = free[room].pop()
            else:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            per = room // length
            full = min(n, left // per)
            placed = full * per
            if full:
                free[room - per * length].append((first, full))
            rest = n - full
            if rest and 0 < left - placed:
                free[room - (left - placed) * length].append((first + full, 1))
                placed, full, rest = left, full + 1, rest - 1
            if rest:
                free[room].append((first + full, rest))
            placements.append((length, rank, placed, first, per, capacity - room))
            left, rank = left - placed, rank + placed
    return placements


def pack(pieces: DataFrame, capacity: int = SEQ_LEN, order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; runs one job over the lengths.

    ``pieces`` is a stored table, as it is read three times. ``order`` names columns that
    number equal lengths repeatably. Lengths that are null or not within 1 to
    ``capacity`` have no place: both columns are null. Equal rows get places of their own.
    """
    spark = pieces.sparkSession
    fits = F.col("length").between(1, capacity)
    histogram = pieces.where(fits).groupBy("length").count().collect()  # capacity rows at most
    placements = spark.createDataFrame(
        plan_packing({r["length"]: r["count"] for r in histogram}, capacity), PLACEMENT_SCHEMA
    )
    keys = [F.col(c) for c in order] or [F.col(c) for c in pieces.columns]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(partitions(pieces))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
        .withColumnsRenamed({"length": "of_length", "bucket": "of_bucket"})
    )
    within = Window.partitionBy("length", "bucket").orderBy(*keys)
    ranked = (
        dealt.withColumn("row", F.row_number().over(within) - 1)
        .join(
            bases,
            F.col("length").eqNullSafe(F.col("of_length")) & (F.col("bucket") == F.col("of_bucket")),
        )
        .withColumn("rank", F.col("base") + F.col("row"))
    )
    step = F.col("rank") - F.col("first_rank")
    return ranked.join(
        # a plan over lengths: its size is bounded by the capacity, whatever the corpus
        F.broadcast(placements),
        (F.col("length") == F.col("at_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("items")),
        "left",
    ).select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(step / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("at_offset") + step % F.col("per_sequence") * F.col("length")).alias("offset"),
    )


def best_fit_packing(docs: DataFrame, seq_len: int = SEQ_LEN, with_ids: bool = False) -> DataFrame:
    """Pack whole documents: a row per piece with its sequence and place in it."""
    pieces = written(token_pieces(docs, seq_len, with_ids=with_ids), "pieces")
    return pack(pieces, seq_len, ("doc_id", "piece", "ids_crc32"))
