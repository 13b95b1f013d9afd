"""A message queue as a streaming source, on Spark's Python data source interface.

A queue is a folder of logs in a file system that all executors reach. A log holds one
message a line and only grows; producers that hash messages by their key to a log keep
the order of a key. The reader's offsets are byte positions per log. A micro-batch
admits a bounded number of bytes, cut at line ends, and its tasks each read a range of
them, so that one hot log is read by many tasks.

The same batch is always read again as it was: Spark keeps its offsets, and the position
handed out last is kept with the queue, so that a restarted reader never falls back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from passagework.sources.raw import _file_system

SCHEMA = "body string, log string, position bigint"
#: What stands before the bytes, in base64, of a message that is no UTF-8: never valid JSON.
UNREADABLE = "base64:"
_LOOK = 64 << 10
_BLOCK = 1 << 20
_ROWS = 4096


@dataclass
class Range(InputPartition):
    """The messages of a log that begin in ``start <= position < end``."""

    log: str
    start: int
    end: int
    aligned: bool


class Queue:
    """The logs of a queue and the positions of one group of readers."""

    def __init__(self, root: str, group: str = "default") -> None:
        self.store, base = _file_system(root)
        self.base, self.group = base.rstrip("/"), group

    def log(self, name: str) -> str:
        return f"{self.base}/logs/{name}"

    def sizes(self) -> dict[str, int]:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(f"{self.base}/logs", allow_not_found=True))
        # names with a dot in front are still being written
        logs = (f for f in found if f.type == fs.FileType.File and not f.base_name.startswith("."))
        return {f.base_name: f.size for f in logs}

    def position(self, kind: str) -> dict[str, int] | None:
        try:
            with self.store.open_input_stream(f"{self.base}/groups/{self.group}/{kind}.json", compression=None) as file:
                return json.loads(file.read())
        except FileNotFoundError:
            return None

    def keep_position(self, kind: str, offsets: dict[str, int]) -> None:
        folder = f"{self.base}/groups/{self.group}"
        self.store.create_dir(folder, recursive=True)
        fresh = f"{folder}/.{uuid.uuid4().hex}"
        with self.store.open_output_stream(fresh, compression=None) as file:
            file.write(json.dumps(offsets).encode())
        self.store.move(fresh, f"{folder}/{kind}.json")

    def line_end(self, name: str, start: int, wanted: int, size: int) -> int:
        """The last line end in (start, wanted]; of a longer line its own; ``start`` if it has none yet."""
        with self.store.open_input_file(self.log(name)) as file:
            at = wanted
            while at > start:
                below = max(start, at - _LOOK)
                found = file.read_at(at - below, below).rfind(b"\n")
                if found >= 0:
                    return below + found + 1
                at = below
            at = wanted
            while at < size:
                block = file.read_at(min(_LOOK, size - at), at)
                found = block.find(b"\n")
                if found >= 0:
                    return at + found + 1
                at += len(block)
        return start


def shares(waiting: dict[str, int], total: int) -> dict[str, int]:
    """``total`` dealt out evenly; what a log doesn't need goes to the others."""
    out = {}
    for done, (name, size) in enumerate(sorted(waiting.items(), key=lambda x: x[1])):
        out[name] = min(size, max(1, total // (len(waiting) - done)))
        total -= out[name]
    return out


class QueueReader(DataSourceStreamReader):
    def __init__(self, root: str, group: str, batch_bytes: int, range_bytes: int) -> None:
        self.root, self.group = root, group
        self.batch_bytes, self.range_bytes = batch_bytes, range_bytes

    def initialOffset(self) -> dict:
        """Where the group has got to, for a query without a checkpoint of its own.

        Spark asks for it after the first ``latestOffset``, which is never below it.
        """
        return Queue(self.root, self.group).position("settled") or {}

    def latestOffset(self) -> dict:
        queue = Queue(self.root, self.group)
        offsets, sizes = queue.position("handed") or {}, queue.sizes()
        waiting = {n: s - offsets.get(n, 0) for n, s in sizes.items() if s > offsets.get(n, 0)}
        ends = {
            name: queue.line_end(name, offsets.get(name, 0), offsets.get(name, 0) + share, sizes[name])
            for name, share in shares(waiting, self.batch_bytes).items()
        }
        latest = offsets | ends
        if latest != offsets:
            queue.keep_position("handed", latest)
        return latest

    def partitions(self, start: dict, end: dict) -> list[Range]:
        back = sorted(n for n in start if end.get(n, 0) < start[n])
        if back:
            raise ValueError(f"the queue's position lies before what was read already: {', '.join(back)}")
        out = []
        for name, upto in sorted(end.items()):
            first = start.get(name, 0)
            cuts = [*range(first, upto, self.range_bytes), upto]
            out += [Range(name, a, b, a == first) for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        import base64

        def body(line: bytes) -> str:
            try:
                return line.decode()
            except UnicodeDecodeError:
                return UNREADABLE + base64.b64encode(line).decode()

        queue, rows = Queue(self.root), []

        def batch() -> pa.RecordBatch:
            bodies, positions = zip(*rows, strict=True)
            columns = [pa.array(bodies, pa.string()), pa.array([partition.log] * len(rows), pa.string()), pa.array(positions, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["body", "log", "position"])

        with queue.store.open_input_file(queue.log(partition.log)) as file:
            # a line that begins before the range is another task's
            first = partition.start if partition.aligned else next(_lines(file, partition.start - 1))[1]
            if first >= partition.end:
                return
            for at, after, line in _lines(file, first):
                rows.append((body(line), at))
                last = after >= partition.end
                if last or len(rows) == _ROWS:
                    yield batch()
                    rows = []
                if last:
                    return

    def commit(self, end: dict) -> None:
        """All up to ``end`` is done: new groups of queries go on from here, and producers may drop it."""
        Queue(self.root, self.group).keep_position("settled", end)


def _lines(file, at: int) -> Iterator[tuple[int, int, bytes]]:
    """(begin, begin of the next, bytes) of each line from ``at`` on; the last one must be whole."""
    begin, parts = at, []
    while True:
        block = file.read_at(_BLOCK, at)
        if not block:
            raise EOFError("a log of the queue is shorter than it was")
        at += len(block)
        *whole, rest = block.split(b"\n")
        for piece in whole:
            line = b"".join([*parts, piece])
            yield begin, begin + len(line) + 1, line
            begin, parts = begin + len(line) + 1, []
        parts.append(rest)


class QueueSource(DataSource):
    """``spark.readStream.format("message_queue")`` with ``path`` and, as options, the bounds."""

    @classmethod
    def name(cls) -> str:
        return "message_queue"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> QueueReader:
        return QueueReader(
            self.options["path"],
            self.options.get("group", "default"),
            int(self.options.get("maxBytesPerTrigger", 64 << 20)),
            int(self.options.get("bytesPerTask", 8 << 20)),
        )


def read_queue(spark: SparkSession, root: str, max_bytes: int = 64 << 20, group: str = "default", task_bytes: int = 8 << 20) -> DataFrame:
    """The stream of a queue's messages: ``body``, ``log`` and ``position``.

    A batch holds at most ``max_bytes`` (one message a log at least), a task about
    ``task_bytes``. A line that isn't finished yet waits. Messages that are no UTF-8 come
    as ``base64:...``, which the check of messages refuses with its reason, so nothing is
    lost. One query of a ``group`` at a time; one with a new checkpoint reads the group's last
    batch again.
    """
    spark.dataSource.register(QueueSource)
    return (
        spark.readStream.format(QueueSource.name())
        .option("group", group)
        .option("maxBytesPerTrigger", max_bytes)
        .option("bytesPerTask", task_bytes)
        .load(root)
    )


def append_messages(root: str, log: str, bodies: list[str | bytes]) -> None:
    """Add messages to a log, for one producer of that log. Line feeds, blank in JSON, become spaces."""
    queue = Queue(root)
    queue.store.create_dir(f"{queue.base}/logs", recursive=True)
    with queue.store.open_append_stream(queue.log(log), compression=None) as file:
        file.write(b"".join(_record(b) for b in bodies))


def _record(body: str | bytes) -> bytes:
    raw = body.encode() if isinstance(body, str) else body
    return raw.replace(b"\n", b" ") + b"\n"


def fill_queue(messages: DataFrame, root: str, logs: int, key: Column) -> int:
    """Write the ``body`` of each row to a new queue of ``logs`` logs by ``key``; the number written.

    A log appears when it is whole, so a task may run again. Rows without a body are left out.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        queue = Queue(root)
        queue.store.create_dir(f"{queue.base}/logs", recursive=True)
        fresh, done = queue.log(f".{uuid.uuid4().hex}"), 0
        with queue.store.open_output_stream(fresh, compression=None) as file:
            for batch in batches:
                for body in batch.column("body").to_pylist():
                    file.write(_record(body))
                    done += 1
        queue.store.move(fresh, queue.log(f"log-{TaskContext.get().partitionId():05d}"))
        yield pa.RecordBatch.from_pydict({"n": pa.array([done], pa.int64())})

    rows = messages.where("body IS NOT NULL").repartition(logs, key).select("body").mapInArrow(write, "n long")
    return sum(r["n"] for r in rows.collect())  # a row per log
