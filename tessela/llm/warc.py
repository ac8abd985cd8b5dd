r"""WARC archives with dictionary compression: written by tasks, and read back.

Each record is a Zstandard frame of its own, so it can be read alone. A task gathers records up to ``ARCHIVE_BYTES``,
builds a dictionary from them (trained on at most ``SAMPLE_BYTES`` of pieces taken evenly from the archive's records;
from records too few or too much alike to train any, a dictionary of their raw content), and writes an archive: first
a skippable frame that holds the dictionary, then the records. An archive needs nothing but itself to be read.

Among records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest page_id is a
response, the others are revisits that refer to it and carry no payload. Digests decide. Only (digest, page_id) is
shuffled to find the repeated ones, with the largest id of a digest taken before the shuffle. If at most
``BROADCAST_ROWS`` digests are repeated they are broadcast and pages stay where they were read; more of them are joined
by digest, where the engine splits hot ones.

Tasks write under a name with their attempt's number, first with a suffix, then renamed. What was written is told
by a manifest table, which only holds rows of attempts that Spark committed, so the files of lost or repeated
attempts are never read.

Defined results: null html is an empty payload; a long one makes a record, and an archive, of its own size; a null url
is written as an empty target; payloads under the limit are all responses; rows with equal page_id and payload are
both responses if their page_id is the largest; a null page_id sorts first, is written as such and refers to nothing
if it is a response; other columns, whatever their names, are not looked at; an empty table gives no archive and an
empty table.
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
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.shared import shared_dir, written

ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
PIECE_BYTES = 16 << 10
REVISIT_BYTES = 1000
#: Repeated digests that are broadcast, some 100 bytes each.
BROADCAST_ROWS = 200_000
#: Archives that a task reads.
READ_ARCHIVES = 8
LEVEL = 3

#: The skippable frame that holds a dictionary, and what its content starts with.
SKIPPABLE = 0x184D2A5D
DICTIONARY = 0xEC30A437
DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record in WARC 1.1. A revisit has the full payload's digest and length, but not its bytes."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    block = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """Trained from pieces of the records taken evenly; where that can't be done (few or all alike), the pieces themselves,
    which serve as a dictionary of raw content.
    """
    pieces = [r[i : i + PIECE_BYTES] for r in records for i in range(0, len(r), PIECE_BYTES)]
    step = max(1, -(-sum(map(len, pieces)) // SAMPLE_BYTES))
    some = pieces[::step]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, some)) // 8)), some).as_bytes()
    except zstandard.ZstdError:
        return b"".join(some)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    trained = len(raw) >= 4 and struct.unpack("<I", raw[:4])[0] == DICTIONARY
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def compress(records: list[bytes]) -> bytes:
    """An archive."""
    raw = dictionary(records)
    made = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw))
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(made.compress, records)])


def records(source: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one after another."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not start with a dictionary")
    raw = source.read(size)
    made = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
    stream = io.BufferedReader(made.stream_reader(source, read_across_frames=True), 1 << 16)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:20]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        yield head, block


def decided(pages: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(page_id, url, html, digest, refers_to): what to write of each page."""
    pages = pages.select(F.col("page_id").try_cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    again = pages.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "last")
    again = written(again)
    if again.count() <= broadcast_rows:
        again = F.broadcast(again)
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last"))
    return pages.join(again, "digest", "left").select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as Spark names it (a path, file:/..., hdfs://, s3a://, gs://), and the path there."""
    scheme, _, rest = folder.partition(":") if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", folder) else ("file", "", folder)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes archives into ``folder``; the manifest (path, records, bytes) of what was written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = _store(folder)
        store.create_dir(root)
        held: list[bytes] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            data = compress(held)
            name = f"{root}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:04d}.warc.zst"
            with store.open_output_stream(f"{name}.tmp") as to:
                to.write(data)
            store.move(f"{name}.tmp", name)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)]), pa.array([len(data)])], names=["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*batch.columns, strict=True):
                held.append(record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes() if html.is_valid else b"", digest.as_py(), refers_to.as_py()))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return written(pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, "path string, records long, bytes long"))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload; digests are checked."""

    def number(name: str | None) -> int | None:
        return int(name[len("<urn:page:") : -1]) if name and name != "<urn:page:>" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as source:
                    rows: list[tuple] = []
                    for head, block in records(source):
                        digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        if head["WARC-Type"] == "response" and (hashlib.sha1(block).hexdigest() != digest or len(block) != int(head["WARC-Payload-Length"])):  # noqa: S324
                            raise ValueError(f"{path}: {head['WARC-Record-ID']} is damaged")
                        rows.append((number(head["WARC-Record-ID"]), head["WARC-Target-URI"], int(head["WARC-Payload-Length"]), digest, head["WARC-Type"], number(head.get("WARC-Refers-To")), block))
                        if len(rows) >= 256:
                            yield table(rows)
                            rows = []
                    if rows:
                        yield table(rows)

    types = (("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], names=[n for n, _ in types])

    n = manifest.count()
    tasks = max(-(-n // READ_ARCHIVES), min(n, manifest.sparkSession.sparkContext.defaultParallelism), 1)
    files = manifest.select("path").repartition(tasks)  # a number, so that small rows with much behind them aren't put together
    return files.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as archives, and tells what is in these."""
    folder = shared_dir(spark)
    manifest = write(decided(spark.read.parquet(f"{sf_dir}/pages.parquet")), folder)
    return read(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), g AS (SELECT d, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY d HAVING count(*) > 1)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN p.page_id < g.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < g.last THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d
"""
