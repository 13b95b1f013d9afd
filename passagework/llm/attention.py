"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages and only the bag is labelled. Every passage of the whole text
is encoded (hashed words and statistics, one hidden layer); gated attention gives each
passage a weight, learnt from the document labels; the weighted sum of the encodings is
scored. Training is gradient descent on a bounded sample of labelled documents; scoring is
one pass over all documents, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.llm.common import small_batches, texts, worker_cache

#: Labelled documents that the model is fitted on, at most: those with the least hashed ids.
FIT_ROWS = 4096
#: Words of a passage; a text of more than ``MOST`` passages has longer ones instead.
PASSAGE, MOST = 64, 64
BUCKETS, HIDDEN, GATE = 512, 32, 16
EPOCHS, BAGS, RATE, DECAY = 30, 64, 3e-3, 1e-4
THRESHOLD = 0.7
STATISTICS = 15
_MOST_WORDS = 1 << 20
_DIGITS, _UPPER, _LOWER = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_MARKS = b".,;:!?'\"()-"
_ASCII = bytes(range(128))
RESULT = "doc_id long, held_out boolean, score double, predicted int"


class Words:
    """What a worker knows of the words it has met: a bucket, a sign and counts of their characters."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.known = np.zeros((0, 8), np.float32)

    def ids(self, words: list[bytes]) -> np.ndarray:
        numbers = self.numbers
        out = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        if len(numbers) > len(self.known):
            new = list(numbers)[len(self.known) :]
            self.known = np.concatenate([self.known, np.array([self._row(w) for w in new], np.float32)])
        return out

    def forget(self) -> None:
        """Start anew when there are too many; numbers are only used within a batch."""
        if len(self.numbers) > _MOST_WORDS:
            self.__init__()

    @staticmethod
    def _row(word: bytes) -> tuple[float, ...]:
        core = word.lower().strip(_MARKS)
        hashed = zlib.crc32(core)
        size = len(word)
        return (
            hashed % BUCKETS,
            1.0 if hashed >> 31 else -1.0,
            size,
            size - len(word.translate(None, _DIGITS)),
            size - len(word.translate(None, _UPPER)),
            size - len(word.translate(None, _LOWER)),
            size - len(word.translate(None, _MARKS)),
            len(word.translate(None, _ASCII)),
        )


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[back] > 1


def encode(batch: list[str], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(features, bag of each passage) of whole texts; a text without words is one passage of zeros."""
    split = [t.encode().split() for t in batch]
    sizes = np.array([len(s) for s in split], np.int64)
    length = np.maximum(PASSAGE, -(-sizes // MOST))
    count = np.maximum(1, -(-sizes // length))
    bag = np.repeat(np.arange(len(batch)), count)
    start = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(batch)), sizes)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    of = start[doc] + place // length[doc]
    ids = words.ids([w for s in split for w in s])
    known = words.known[ids]
    n = len(bag)
    hashed = np.bincount(of * BUCKETS + known[:, 0].astype(np.int64), weights=known[:, 1], minlength=n * BUCKETS)
    hashed = hashed.reshape(n, BUCKETS).astype(np.float32)
    hashed /= np.maximum(np.sqrt((hashed * hashed).sum(axis=1, keepdims=True)), 1e-6)

    base = len(words.numbers) + 1

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=values, minlength=n)

    many = np.maximum(total(np.ones(len(of))), 1)
    chars = np.maximum(total(known[:, 2]), 1)
    kinds = [total(known[:, c]) for c in range(3, 8)]
    rest = chars - sum(kinds)
    follows = np.append((doc[1:] == doc[:-1]), False) if len(doc) else np.zeros(0, bool)
    after = np.append(ids[1:], 0)
    in_passage = _repeated(of * base + ids) if len(ids) else np.zeros(0, bool)
    pair = ids * base + after
    _, pair = np.unique(pair, return_inverse=True)
    pairs = _repeated(doc * (len(pair) + 1) + pair) & follows if len(ids) else np.zeros(0, bool)
    same = (ids == after) & follows
    lines = [t.split("\n") for t in batch]
    filled = [[x for x in (y.strip() for y in some) if x] for some in lines]
    again = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in filled])
    wide = total(known[:, 2].astype(np.float64) ** 2) / many - (chars / many) ** 2
    statistics = [
        np.log1p(sizes[bag]),
        np.log1p(many),
        chars / many,
        np.sqrt(np.maximum(wide, 0)),
        *(np.sqrt(k / chars) for k in kinds),
        np.sqrt(np.maximum(rest, 0) / chars),
        total(in_passage) / many,
        total(pairs) / many,
        total(same) / many,
        again[bag],
        np.array([len(x) for x in filled])[bag] / np.maximum(sizes[bag], 1),
    ]
    return np.concatenate([np.stack(statistics, axis=1).astype(np.float32), hashed], axis=1), bag


@dataclass
class Model:
    """Scaling of the statistics, and the layers: encoder, gated attention, classifier."""

    centre: np.ndarray
    spread: np.ndarray
    layers: dict[str, np.ndarray]

    def scaled(self, features: np.ndarray) -> np.ndarray:
        out = features.copy()
        out[:, :STATISTICS] = np.clip((features[:, :STATISTICS] - self.centre) / self.spread, -8, 8)
        return out

    def scores(self, features: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        return _sigmoid(forward(self.layers, self.scaled(features), bag, bags)["logit"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _per_bag(values: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    out = np.zeros((bags, *values.shape[1:]), np.float64)
    np.add.at(out, bag, values)
    return out


def forward(layers: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
    """Everything of one pass: passages' encodings ``h``, their weights ``a``, each bag's sum ``z`` and ``logit``."""
    h = np.tanh(x @ layers["encode"] + layers["encode_b"])
    t, g = np.tanh(h @ layers["tanh"]), _sigmoid(h @ layers["gate"])
    raw = (t * g) @ layers["attend"]
    most = np.full(bags, -np.inf)
    np.maximum.at(most, bag, raw)
    e = np.exp(raw - most[bag])
    a = e / _per_bag(e, bag, bags)[bag]
    z = _per_bag(a[:, None] * h, bag, bags)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ layers["out"] + layers["out_b"][0]}


def gradients(layers: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of the bags' labels."""
    s = forward(layers, x, bag, len(y))
    d = (_sigmoid(s["logit"]) - y) / len(y)
    out = {"out": s["z"].T @ d, "out_b": np.array([d.sum()])}
    dz = d[:, None] * layers["out"][None, :]
    da = (dz[bag] * s["h"]).sum(axis=1)
    dh = s["a"][:, None] * dz[bag]
    draw = s["a"] * (da - _per_bag(s["a"] * da, bag, len(y))[bag])
    out["attend"] = (s["t"] * s["g"]).T @ draw
    du = draw[:, None] * layers["attend"][None, :]
    dt, dg = du * s["g"] * (1 - s["t"] ** 2), du * s["t"] * s["g"] * (1 - s["g"])
    out["tanh"], out["gate"] = s["h"].T @ dt, s["h"].T @ dg
    dh = (dh + dt @ layers["tanh"].T + dg @ layers["gate"].T) * (1 - s["h"] ** 2)
    out["encode"], out["encode_b"] = x.T @ dh, dh.sum(axis=0)
    return out


def fit(features: np.ndarray, bag: np.ndarray, labels: np.ndarray, seed: int = 5) -> Model:
    """Adam over shuffled bags. Without both labels the score is their share (0.5 without any)."""
    draw = np.random.default_rng(seed)
    width = features.shape[1]
    layers = {
        "encode": draw.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), "encode_b": np.zeros(HIDDEN),
        "tanh": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)), "gate": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
        "attend": draw.normal(0, 1 / np.sqrt(GATE), GATE), "out": draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "out_b": np.zeros(1),
    }
    plain = features[:, :STATISTICS]
    centre = plain.mean(axis=0) if len(plain) else np.zeros(STATISTICS)
    spread = np.maximum(plain.std(axis=0), 1e-3) if len(plain) else np.ones(STATISTICS)
    share = labels.mean() if len(labels) else 0.5
    layers["out_b"][0] = np.log((share + 1e-3) / (1 - share + 1e-3))
    model = Model(centre, spread, layers)
    if share in (0.0, 1.0) or not len(labels):
        layers["out"] *= 0
        return model
    x = model.scaled(features).astype(np.float64)
    first = np.searchsorted(bag, np.arange(len(labels) + 1))
    mean = {k: np.zeros_like(v) for k, v in layers.items()}
    square = {k: np.zeros_like(v) for k, v in layers.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BAGS):
            some = order[at : at + BAGS]
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in some])
            of = np.repeat(np.arange(len(some)), first[some + 1] - first[some])
            step += 1
            for k, g in gradients(layers, x[rows], of, labels[some].astype(np.float64)).items():
                g = g + DECAY * layers[k] * (layers[k].ndim > 1)
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                layers[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    layers.update({k: v.astype(np.float32) for k, v in layers.items()})
    return model


def training_sample(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = FIT_ROWS) -> DataFrame:
    """(text, quality) of at most ``rows`` labelled documents that are not held out, the same ones on every run.

    An id labelled more than once has the mean of its labels, rounded; rows without a label are no part.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_d"))
    known = known.agg(F.round(F.avg("quality")).cast("int").alias("quality"))
    mine = texts(docs.where(~F.coalesce(held_out, F.lit(False))), "doc_id")
    chosen = known.join(mine.select("doc_id").distinct(), F.col("_d") == F.col("doc_id")).select("_d", "quality")
    chosen = chosen.orderBy(F.xxhash64("_d"), "_d").limit(rows)
    return mine.join(chosen, F.col("doc_id") == F.col("_d")).orderBy(F.xxhash64("_d"), "_d", "text").limit(rows).select("text", "quality")


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = FIT_ROWS) -> Model:
    """The model of a bounded sample. Only the sample's features reach the driver."""
    sample = training_sample(docs, labels, held_out, rows)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = worker_cache("quality_words", Words)
        for frame in small_batches(frames, "text", 1 << 19):
            words.forget()
            made, bag = encode(frame["text"].tolist(), words)
            cut = np.searchsorted(bag, np.arange(1, len(frame)))
            yield pd.DataFrame({"features": [x.tobytes() for x in np.split(made, cut)], "quality": frame["quality"].to_numpy()})

    rows_ = sample.mapInPandas(features, "features binary, quality int").collect()
    bags = [np.frombuffer(bytes(r["features"]), np.float32).reshape(-1, STATISTICS + BUCKETS) for r in rows_]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    full = np.concatenate(bags) if bags else np.zeros((0, STATISTICS + BUCKETS), np.float32)
    return fit(full, bag, np.array([r["quality"] for r in rows_], np.int64))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``: how likely its quality label is 1.

    Scores rest on the text alone, all of it. Null and empty texts are one empty passage, a
    null id is not held out, repeated rows are scored each, an empty table gives no rows; no
    label at all gives 0.5 to all, one kind of label only a score near it. Runs jobs.
    """
    model = fit_quality(docs, labels, held_out, rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the layers

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = worker_cache("quality_words", Words)
        for frame in small_batches(frames, "text", 1 << 19):
            words.forget()
            made, bag = encode(frame["text"].tolist(), words)
            scores = shared.value.scores(made, bag, len(frame))
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "held_out": frame["held_out"],
                    "score": scores.astype(np.float64),
                    "predicted": (scores >= threshold).astype(np.int32),
                }
            )

    flagged = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return texts(flagged, "doc_id", "held_out").mapInPandas(score, RESULT)
