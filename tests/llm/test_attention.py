import random

import numpy as np
import pytest
from made_up import prose, vocabulary
from pyspark.sql import functions as F

from passagework.llm import attention


@pytest.fixture(scope="module")
def held(spark):
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    sizes = {"encode": (6, 5), "encode_b": (5,), "tanh": (5, 3), "gate": (5, 3), "attend": (3,), "out": (5,), "out_b": (1,)}
    layers = {k: draw.normal(0, 0.7, v) for k, v in sizes.items()}
    x, bag, y = draw.normal(0, 1, (9, 6)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1.0, 0.0, 1.0, 0.0])

    def loss():
        p = attention._sigmoid(attention.forward(layers, x, bag, 4)["logit"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    found = attention.gradients(layers, x, bag, y)
    for k, value in layers.items():
        for at in np.ndindex(value.shape):
            old = value[at]
            value[at] = old + 1e-6
            high = loss()
            value[at] = old - 1e-6
            low = loss()
            value[at] = old
            assert found[k][at] == pytest.approx((high - low) / 2e-6, abs=1e-6)


def test_weights_are_a_share_of_each_bag():
    draw = np.random.default_rng(2)
    model = attention.fit(draw.normal(0, 1, (40, attention.STATISTICS + 20)), np.repeat(np.arange(10), 4), np.arange(10) % 2)
    x = draw.normal(0, 1, (7, attention.STATISTICS + 20))
    bag = np.array([0, 0, 0, 1, 2, 2, 2])
    a = attention.forward(model.layers, model.scaled(x), bag, 3)["a"]
    assert np.allclose(attention._per_bag(a, bag, 3), 1)


def test_whole_texts_are_passages():
    words = attention.Words()
    texts = ["", "one two", " ".join("w%d" % i for i in range(64)), " ".join("v%d" % i for i in range(65)), "x " * 40_000]
    _, bag = attention.encode(texts, words)
    assert np.bincount(bag).tolist() == [1, 1, 1, 2, 64]
    plain, _ = attention.encode([" ".join(["good"] * 100)], words)
    tail, _ = attention.encode([" ".join(["good"] * 99 + ["#bad#"])], words)
    assert np.allclose(plain[0, attention.STATISTICS :], tail[0, attention.STATISTICS :])
    assert not np.allclose(plain[1], tail[1])


def test_a_batch_does_not_change_a_score():
    words, texts = attention.Words(), ["a b. c\nd", "", "e f e f e f\nq\nq", "É 123 #" * 50]
    together, bag = attention.encode(texts, words)
    for i, text in enumerate(texts):
        alone, _ = attention.encode([text], attention.Words())
        assert np.allclose(alone, together[bag == i], atol=1e-6)


@pytest.fixture(scope="module")
def labelled(spark, table):
    draw, words = random.Random(6), vocabulary()
    rows, marks = [], []
    for i in range(500):
        text = prose(words, draw.randint(30, 300), draw).split()
        good = draw.random() < 0.8
        if not good:  # one bad passage somewhere
            at = draw.randint(0, len(text))
            text[at:at] = draw.choice([["zap#"] * 30, prose(["$$", "|", "&&x"], 30, draw).split()])
        rows.append((i, " ".join(text)))
        marks.append((i, int(good), 0))
    return table(rows).repartition(3), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled, held):
    docs, labels = labelled
    got = attention.quality_scores(docs, labels, held)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").collect()
    apart = [r for r in rows if r["held_out"]]
    assert len(rows) == 500 and len(apart) > 80
    assert np.mean([r["predicted"] == r["quality"] for r in apart]) >= 0.95
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) for r in rows)


def test_held_out_labels_and_other_columns_are_not_used(labelled, held):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string")})
    first = attention.quality_scores(docs, labels, held, 200)
    second = attention.quality_scores(other, turned, held, 200)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_the_sample_is_bounded_and_fixed(labelled, held):
    docs, labels = labelled
    twice = [sorted(map(tuple, attention.training_sample(d, labels, held, 50).collect())) for d in (docs, docs.repartition(5))]
    assert twice[0] == twice[1] and len(twice[0]) == 50


def test_odd_rows_and_few_labels(spark, odd, odd_rows, empty, held):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, None, 1), (None, 0, 0), (777, 0, 0)], none.schema)
    two = one.union(spark.createDataFrame([(4, 0, 0), (5, 0, 0), (5, 1, 0), (7, 0, 0)], none.schema))
    for labels, check in ((none, lambda s: s == 0.5), (one, lambda s: s > 0.9), (two, lambda s: 0 <= s <= 1)):
        rows = attention.quality_scores(odd, labels, held).collect()
        assert len(rows) == len(odd_rows) and all(check(r["score"]) for r in rows)
        assert sum(r["doc_id"] is None for r in rows) == 2
    assert attention.quality_scores(empty, two, held).collect() == []
