import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passagework.operators.messages import NOT_JSON, check_messages
from passagework.sources import queue
from passagework.streaming.ingest import drain, message_queue


def _sink(folder):
    """Rows per batch, as an idempotent sink keeps them."""
    kept = {}

    def apply(batch, batch_id):
        kept[batch_id] = [(r["body"], r["_order"]["log"]) for r in batch.collect()]

    return kept, apply


def _start(spark, folder, apply, max_bytes, checkpoint="checkpoint"):
    return (
        message_queue(spark, folder + "/queue", max_bytes)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{folder}/{checkpoint}")
        .trigger(processingTime="0 seconds")
        .start()
    )


def _fill(folder, per_log, logs=3):
    sent = []
    for n in range(logs):
        bodies = [json.dumps({"log": n, "i": i, "pad": "é" * (i % 50)}) for i in range(per_log)]
        queue.append_messages(folder + "/queue", f"log-{n}", bodies)
        sent += [(b, f"log-{n}") for b in bodies]
    return sent


@given(st.lists(st.binary(max_size=40), min_size=1, max_size=30), st.integers(1, 60))
@settings(max_examples=60, deadline=None)
def test_ranges_hold_each_line_once(tmp_path_factory, lines, step):
    root = str(tmp_path_factory.mktemp("queue"))
    queue.append_messages(root, "a", lines)
    reader = queue.QueueReader(root, "g", 1 << 20, step)
    end = reader.latestOffset()
    assert end == {"a": queue.Queue(root).sizes()["a"]}
    batches = [b for part in reader.partitions({}, end) for b in reader.read(part)]
    got = [body for b in batches for body in b.column("body").to_pylist()]
    raw = [line.replace(b"\n", b" ") for line in lines]
    assert len(got) == len(raw)
    for body, line in zip(got, raw, strict=True):
        assert body.startswith(queue.UNREADABLE) or body.encode() == line


def test_admission_is_bounded_and_whole_lines(folder):
    _fill(folder, 100)
    reader = queue.QueueReader(folder + "/queue", "g", 3000, 1000)
    offsets, seen = reader.initialOffset(), 0
    while (later := reader.latestOffset()) != offsets:
        assert sum(later.values()) - sum(offsets.values()) <= 3000
        seen += sum(b.num_rows for part in reader.partitions(offsets, later) for b in reader.read(part))
        offsets = later
    assert seen == 300
    with pytest.raises(ValueError, match="log-1"):
        reader.partitions(offsets, offsets | {"log-1": 0})


def test_an_idle_log_leaves_its_share(folder):
    assert queue.shares({"a": 10, "b": 1000, "c": 1000}, 600) == {"a": 10, "b": 295, "c": 295}
    # a line longer than the share goes whole, one without an end waits
    queue.append_messages(folder, "a", ["x" * 500, "y"])
    with open(folder + "/logs/a", "ab") as out:
        out.write(b"unfinished")
    reader = queue.QueueReader(folder, "g", 10, 1000)
    assert [reader.latestOffset()["a"] for _ in range(3)] == [501, 503, 503]


def test_killed_batch_is_neither_lost_nor_doubled(spark, folder):
    sent = _fill(folder, 200)
    kept, apply = _sink(folder)

    def fails_late(batch, batch_id):
        apply(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        drain(_start(spark, folder, fails_late, 6000))
    assert sorted(kept) == [0, 1, 2]
    killed = sorted(kept[2])
    sent += _fill(folder, 5, logs=4)  # more arrives, in a new log too
    drain(_start(spark, folder, apply, 6000))
    assert sorted(kept[2]) == killed and len(kept) > 4
    assert sorted(x for rows in kept.values() for x in rows) == sorted(sent)
    # the next run has only what came since
    sent_later = _fill(folder, 1)
    before = set(kept)
    drain(_start(spark, folder, apply, 6000))
    assert sorted(x for b in set(kept) - before for x in kept[b]) == sorted(sent_later)


def test_unreadable_messages_are_refused_with_their_bytes(spark, folder):
    queue.append_messages(folder + "/queue", "a", [b"\xff\xfe", "", "{}"])
    found = {}

    def apply(batch, batch_id):
        found.update({r["body"]: r["reason"] for r in check_messages(batch.select("body")).collect()})

    drain(_start(spark, folder, apply, 1 << 20))
    assert set(found) == {"base64://4=", "", "{}"}
    assert found["base64://4="] == found[""] == NOT_JSON


def test_fill(spark, folder):
    rows = spark.range(50).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE 'm' || id END AS body", "id % 3 AS k")
    assert queue.fill_queue(rows, folder + "/queue", 4, F.col("k")) == 45
    assert not [f for f in os.listdir(folder + "/queue/logs") if f.startswith(".")]
    kept, apply = _sink(folder)
    drain(_start(spark, folder, apply, 100))
    bodies = sorted(b for rows in kept.values() for b, _ in rows)
    assert bodies == sorted(f"m{i}" for i in range(50) if i % 10)
    # an empty queue has nothing, and stops
    empty, apply = _sink(folder)
    drain(
        message_queue(spark, folder + "/none", 100).writeStream.foreachBatch(apply)
        .option("checkpointLocation", folder + "/c2").start()
    )
    assert not any(empty.values())
