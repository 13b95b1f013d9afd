"""WARC archives: written as one gzip stream each, then normalised to a member per record.

Many archives come as a single gzip stream over the whole file, in which no record can be
reached but by inflating all before it. The normaliser inflates such a stream once, in
pieces, writes every record as a gzip member of its own and lists the members' offsets in
a sidecar index; records are then read back in parallel by ranges of the index.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.common import shared_fs
from passagework.session import scratch_path, written

ARCHIVE = 64 << 20
CHUNK = 1 << 20
SALTS = 16
#: Records of a reading task.
READ_RECORDS = 4096
ARCHIVES = "path string, records long"
INDEX = "path string, offset long, length long, record_type string, record_id string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_PAGE = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None, page: str) -> str:
    """One header line's worth of a URL: other characters are percent-encoded."""
    if not url:
        return _PAGE + page
    return "".join(chr(c) if 32 < c < 127 else f"%{c:02X}" for c in url.encode())


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit that names the response with the same payload."""
    page = "none" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_PAGE}{page}>",
        f"WARC-Target-URI: {_uri(url, page)}",
        "WARC-Date: 2026-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: <{_PAGE}{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """Header fields of a record or of its HTTP block, names lowered."""
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): equal payloads refer to the smallest ``page_id``.

    Payloads shorter than ``min_bytes`` refer to none. Null html is an empty payload; a row
    with the smallest id of its payload, or a group without ids, is a response.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    least = rows.groupBy(F.col("sha").alias("s")).agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    # only payloads met again are looked up, each under several salts: a common page is many tasks'
    least = written(least.where("n > 1 AND least IS NOT NULL").drop("n"), "originals")
    least = least.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    other = (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("least"))
    return rows.join(least, (F.col("sha") == F.col("s")) & (F.col("salt") == F.col("t")), "left").select(
        "page_id", "url", "payload", F.when(other, F.col("least")).alias("refers_to")
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write each partition as one gzip stream over all its records: (path, records).

    Names hold the attempt; the table that Spark commits says which files count.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = shared_fs(folder)
        fs.create_dir(root, recursive=True)
        out = name = pack = None
        size = count = 0

        def close() -> pd.DataFrame:
            nonlocal out
            out.write(pack.flush())
            out.close()
            out = None
            return pd.DataFrame({"path": [os.path.join(folder, name)], "records": [count]})

        for frame in frames:
            for page_id, url, payload, refers_to in zip(
                frame["page_id"], frame["url"], frame["payload"], frame["refers_to"], strict=True
            ):
                if out is None:
                    name = f"whole-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None, buffer_size=CHUNK)
                    pack, size, count = zlib.compressobj(6, wbits=31), 0, 0
                ids = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                page, other = ids
                made = record(page, url, bytes(payload), other)
                out.write(pack.compress(made))
                size, count = size + len(made), count + 1
                if size >= archive_bytes:
                    yield close()
        if out is not None:
            yield close()

    return records.mapInPandas(write, ARCHIVES)


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, whole record) of one gzip stream, inflated once in pieces."""
    inflate, held = zlib.decompressobj(wbits=31), bytearray()

    def more() -> bool:
        raw = stream.read(CHUNK)
        held.extend(inflate.decompress(raw) if raw else inflate.flush())
        return bool(raw)

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if bytes(held).strip():
                    raise ValueError("a record is cut off")
                return
        head = headers(bytes(held[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        while len(held) < size:
            if not more() and len(held) < size:
                raise ValueError("a record is cut off")
        yield head, bytes(held[:size])
        del held[:size]


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite each whole-stream archive with a member per record: its sidecar index as rows.

    The index also lies beside the archive, as tab-separated lines (``.idx``). Archives are
    dealt to as many tasks as there are archives, whatever their listing weighs; a task reads
    one in pieces of a megabyte and holds one record. Counts the archives, which runs a job.
    """

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in INDEX.split(", ")]
        for frame in frames:
            for path in frame["path"]:
                to = f"{path.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}-members.warc.gz"
                (fs, source), (_, target) = shared_fs(path), shared_fs(to)
                rows: list[tuple] = []
                at = 0
                with fs.open_input_stream(source, compression=None) as stream, fs.open_output_stream(target, compression=None) as out:
                    with fs.open_output_stream(f"{target}.idx", compression=None) as index:
                        for head, raw in _records(stream):
                            pack = zlib.compressobj(6, wbits=31)
                            member = pack.compress(raw) + pack.flush()
                            out.write(member)
                            row = (to, at, len(member), head["warc-type"], head["warc-record-id"].strip("<>"))
                            index.write("\t".join(map(str, row[1:])).encode() + b"\n")
                            rows.append(row)
                            at += len(member)
                            if len(rows) >= 10_000:
                                yield pd.DataFrame(rows, columns=names)
                                rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return archives.repartitionByRange(max(1, archives.count()), "path").mapInPandas(rewrite, INDEX)


def _page(uri: str | None) -> int | None:
    found = (uri or "").strip("<>").removeprefix(_PAGE)
    return int(found) if found.lstrip("-").isdigit() else None


def read_records(index: DataFrame) -> DataFrame:
    """A row per record, each reached by its offset; a response's payload is checked by its digest."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in READ.split(", ")]
        file = now = None
        for frame in frames:
            out = []
            for path, offset, length in zip(frame["path"], frame["offset"], frame["length"], strict=True):
                if path != now:
                    if file:
                        file.close()
                    fs, source = shared_fs(path)
                    file, now = fs.open_input_file(source), path
                raw = zlib.decompress(file.read_at(int(length), int(offset)), wbits=31)
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = headers(head)
                http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
                named = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response" and digest(payload) != named:
                    raise ValueError(f"a payload in {path} at {offset} differs from its digest")
                out.append(
                    (
                        _page(fields["warc-record-id"]),
                        int(headers(http)["content-length"]),
                        named,
                        fields["warc-type"],
                        _page(fields.get("warc-refers-to")),
                    )
                )
            yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
        if file:
            file.close()

    tasks = index.count() // READ_RECORDS + 1
    return index.repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset").mapInPandas(read, READ)


def round_trip(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write ``pages`` as whole-stream archives, normalise them, and read every record back.

    One row per input row; an empty table writes no archive. Runs jobs.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    archives = written(write_archives(with_originals(pages, min_bytes), folder, archive_bytes), "archives")
    return read_records(written(normalise(archives), "index"))
