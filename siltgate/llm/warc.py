"""WARC archives whose records are Zstandard frames sharing a dictionary.

Each archive is ``.warc.zst``: a skippable frame that holds the dictionary, then one frame per
record. Repeated payloads become revisit records. Archives are written by the tasks that hold
the records and read back with Spark's binary reader.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the frame number the format reserves for a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payload that one archive holds before the next is begun; a larger record has an archive of its own.
ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 48 << 10
# Records are taken evenly from the archive until their sizes reach this; the dictionary is trained on them.
TRAINED_BYTES = 3 << 20
LEAST_REVISIT = 1000
INDEX = "page_id long, path string, offset long, length long"
RECORD = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def _target(url: str | None) -> str:
    """A URI without characters that would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else ""


def _record(page_id, url, html: bytes | None, n_bytes: int, digest: bytes, first) -> bytes:
    """One record. ``first`` is None, or (page id, url) of the response whose payload this one repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if first else http + (html or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_target(url)}")
    if first:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{first[0]}>"]
        if first[1] is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_target(first[1])}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained on whole records taken evenly; None where there are too few to train on."""
    total = sum(map(len, records))
    step = max(1, -(-total // TRAINED_BYTES))
    sample = records[::step]
    if len(sample) < 16 or sum(map(len, sample)) > 4 * TRAINED_BYTES:
        sample = [r for r in sample if len(r) <= TRAINED_BYTES // 8]
    if len(sample) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8)
    except zstandard.ZstdError:
        return None


def _archive(records: list[bytes]) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes of an archive and where each record's frame lies."""
    out, places = io.BytesIO(), []
    known = _dictionary(records)
    if known:
        raw = known.as_bytes()
        out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
    packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)
    for record in records:
        frame = packer.compress(record)
        places.append((out.tell(), len(frame)))
        out.write(frame)
    return out.getvalue(), places


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = _open(folder)
        held, ids, size, n = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            content, places = _archive(held)
            name = f"pages-{context.partitionId():06d}-{n:05d}.warc.zst"
            # A task that runs twice writes the same bytes under the same name; the move makes them visible whole.
            part = f"{root}/.{name}.{context.taskAttemptId()}"
            with store.open_output_stream(part) as stream:
                stream.write(content)
            store.move(part, f"{root}/{name}")
            columns = [ids, [name] * len(ids), [p[0] for p in places], [p[1] for p in places]]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "path", "offset", "length"])

        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(names.index(x)) for x in ("page_id", "url", "html", "n_bytes", "digest", "first_id", "first_url", "again")]
            for i in range(batch.num_rows):
                page_id, url, html, n_bytes, digest, first_id, first_url, again = (c[i].as_py() for c in columns)
                record = _record(page_id, url, html, n_bytes, bytes.fromhex(digest), (first_id, first_url) if again else None)
                if held and size + len(record) > archive_bytes:
                    yield flush()
                    held, ids, size, n = [], [], 0, n + 1
                held.append(record)
                ids.append(page_id)
                size += len(record)
        if held:
            yield flush()

    return write


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) in ``folder``; returns an index (page_id, path, offset, length).

    The index is a plan: the archives are written when it is stored. Of rows with equal payloads of at
    least 1000 bytes those with the largest page_id are responses and the others revisit them; NULL ids
    never are the largest, and where all ids of a payload are NULL all are responses. NULL html is an
    empty payload, a NULL url leaves its header out. Payloads are told apart by SHA-1 and length. Rows
    are ordered within a task, so that a task that runs again writes the same files. The folder must be
    one that all executors share; other columns do not matter.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html")).select(
        "*", F.octet_length("html").cast("long").alias("n_bytes"), F.sha1("html").alias("digest")
    )
    large = rows.where((F.col("n_bytes") >= LEAST_REVISIT) & F.col("page_id").isNotNull())
    # Counts and maxima meet per payload after map-side aggregation: a payload of very many pages is one row a task.
    firsts = (
        large.groupBy("digest", "n_bytes")
        .agg(F.max(F.struct("page_id", "url")).alias("first"))
        .select("digest", "n_bytes", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    joined = rows.join(firsts, ["digest", "n_bytes"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    marked = joined.withColumn("again", again).withColumn("html", F.when(~F.col("again"), F.col("html")))
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    return marked.sortWithinPartitions("digest", "page_id", "url", "n_bytes").mapInArrow(_writer(folder, archive_bytes), INDEX)


def dictionary_of(content: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary an archive begins with, and where its records begin."""
    if len(content) >= 8:
        magic, size = struct.unpack("<II", content[:8])
        if magic == DICTIONARY_FRAME:
            return zstandard.ZstdCompressionDict(content[8 : 8 + size]), 8 + size
    return None, 0


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, one after the other."""
    known, at = dictionary_of(content)
    unpacker = zstandard.ZstdDecompressor(dict_data=known)
    stream = io.BufferedReader(unpacker.stream_reader(memoryview(content)[at:], read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line.rstrip(b"\r\n") != b"WARC/1.1":
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            for headers, block in records(content.as_py()):
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
                kind = headers["warc-type"]
                n_bytes = int(re.search(rb"Content-Length: (\d+)", http)[1])
                if kind == "response" and (len(payload) != n_bytes or hashlib.sha1(payload).digest() != digest):
                    raise ValueError("a payload differs from its digest")
                refers = _page(headers["warc-refers-to"]) if kind == "revisit" else None
                rows.append(
                    (_page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind, None if refers is not None else payload, n_bytes, digest.hex(), refers)
                )
                size += len(payload)
                if size > 4 << 20:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives in ``folder``: page_id, url, type, payload (NULL for revisits), its size and digest, refers_to."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(_parse, RECORD)
