"""WARC archives: one gzip member per record, written and read sequentially by Spark tasks."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.tables import join_counted, stored
from millrace.session import new_folder

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30  # a task begins a new archive beyond this size
BATCH_BYTES = 16 << 20
CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"
ID = re.compile(r"<urn:x-row:(-?\d*)>")
UNSAFE = re.compile(r"[\x00-\x20\x7f]")

FILES = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
RECORDS = pa.schema(
    [
        ("id", pa.int64()),
        ("record_type", pa.string()),
        ("uri", pa.string()),
        ("date", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("digest_ok", pa.bool_()),
        ("record_id", pa.string()),
        ("refers_to_id", pa.string()),
        ("payload", pa.binary()),
    ]
)


def with_revisits(rows: DataFrame, id: str, payload: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``_payload`` (binary), ``_digest`` and ``_first``, the smallest id among the rows of an
    equal payload of ``min_bytes`` or more, or NULL where a row is itself such a first one.

    Only digests that occur more than once are joined; frequent ones by broadcast, so a payload
    that a third of all rows share is no one task's work.
    """
    data = rows.withColumn("_payload", F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8"))
    data = data.withColumn("_digest", F.sha2("_payload", 256))
    large = F.octet_length("_payload") >= min_bytes
    data = data.withColumn("_equal", F.when(large, F.col("_digest")))
    groups = data.where(large).groupBy("_equal").agg(F.min(id).alias("_least"), F.count("*").alias("_n"))
    repeated = stored(groups.where("_n > 1"), "repeated-payloads")
    marked = join_counted(data, repeated, ["_equal"], "_n", [F.monotonically_increasing_id()], how="left")
    first = F.when(large & ~F.col(id).eqNullSafe(F.col("_least")), F.col("_least"))
    return marked.withColumn("_first", first).drop("_least", "_n", "_equal")


def record(id: int | None, uri: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-row:{'' if id is None else id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        head.append("WARC-Target-URI: " + UNSAFE.sub(lambda c: f"%{ord(c[0]):02X}", uri))
    if first is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:x-row:{first}>")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = ["\r\n".join(head).encode("utf-8", "surrogatepass"), b"\r\n\r\n", block, b"\r\n\r\n"]
    return b"".join([*(pack.compress(part) for part in whole), pack.flush()])


def write_archives(
    rows: DataFrame,
    folder: str | None = None,
    id: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    date: str = DATE,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row and return the list of archives: ``path``, ``n_records``, ``n_bytes``.

    Of rows with equal payloads (UTF-8) of ``min_revisit_bytes`` or more, those with the smallest
    id become responses and the others revisits of it; all smaller payloads are responses.
    Each task writes archives of its own under a name of its own, and the list, written to the
    shared folder, names those of the tasks that succeeded: an attempt that was lost leaves a
    file that nobody reads. ``folder`` has to be one that all executors reach (default: a new
    one below the shared folder), with a scheme that pyarrow opens.

    NULL payload: an empty response. NULL uri: no target in the record. A NULL id is never the
    smallest unless all are NULL, in which case all are responses. Rows that repeat the smallest id
    are all responses. An empty table gives an empty list. Other columns are not written.
    """
    spark = rows.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(folder or new_folder(spark, "warc"))
    place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    given = rows.select(F.col(id).cast("bigint").alias("id"), F.col(uri).alias("uri"), F.col(payload).alias("text"))
    planned = with_revisits(given, "id", "text", min_revisit_bytes).select("id", "uri", "_payload", "_digest", "_first")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(place)
        system.create_dir(base, recursive=True)
        out, done = None, []
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out, n, size = system.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                    member = record(row["id"], row["uri"], row["_payload"], row["_digest"], row["_first"], date)
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    if size >= archive_bytes:
                        out.close()
                        out = done.append((f"{place}/{name}", n, size))
            if out is not None:
                out.close()
                done.append((f"{place}/{name}", n, size))
        finally:
            if out is not None and not out.closed:
                out.close()
        columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), FILES.types, strict=True)] if done else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FILES.types, strict=True)], schema=FILES)

    return stored(planned.mapInArrow(write, "path string, n_records bigint, n_bytes bigint"), "archives")


def header_fields(raw: bytes, path: str) -> dict[str, str]:
    """The fields of a record's head; a line that begins with white space goes on with the one before."""
    try:
        text = raw.decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
    first, *lines = re.sub(r"\r\n[ \t]+", " ", text).split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"{path}: no WARC record")
    head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    if not re.fullmatch("[0-9]+", head.get("content-length", "")):
        raise ValueError(f"{path}: a record without a length")
    return head


def members(stream, path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, decompressed piece by piece.

    A record has to fill its gzip member exactly, as its content length says.
    """
    data = stream.read(CHUNK)
    while data:
        unpack = zlib.decompressobj(31)
        got, head, need = bytearray(), None, None
        while not unpack.eof:
            if not data:
                raise ValueError(f"{path}: the archive ends inside a record")
            got += unpack.decompress(data, CHUNK)
            data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail or stream.read(CHUNK)
            if head is None and (at := got.find(b"\r\n\r\n")) >= 0:
                head = header_fields(bytes(got[:at]), path)
                del got[: at + 4]
                need = int(head["content-length"])
            if need is not None and len(got) > need + 4:
                raise ValueError(f"{path}: more data than the content length says")
        if head is None or len(got) != need + 4 or bytes(got[need:]) != b"\r\n\r\n":
            raise ValueError(f"{path}: a record is not as long as it says")
        yield head, bytes(got[:need])
        data = data or stream.read(CHUNK)


def digest_matches(given: str | None, data: bytes) -> bool | None:
    """Whether data has a digest ``algorithm:value`` (hex or base32); None if none is given or the algorithm is unknown."""
    algorithm, _, value = (given or "").strip().partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return None
    made = hashlib.new(algorithm, data)
    return value.lower() == made.hexdigest() or value.upper().rstrip("=") == base64.b32encode(made.digest()).decode().rstrip("=")


def own_id(value: str | None) -> int | None:
    """The row id in a record id that this writer gave; others have none."""
    found = ID.fullmatch(value or "")
    return int(found[1]) if found and found[1] else None


def parsed(head: dict[str, str], block: bytes) -> dict:
    """A record's row, of any type and any writer. Digests are verified by their own algorithm, where they are given."""
    kind, http, body, length = head.get("warc-type"), b"", block, None
    if head.get("content-type", "").lower().startswith("application/http") or block[:5] == b"HTTP/":
        http, _, body = block.partition(b"\r\n\r\n")
        length = re.search(rb"(?mi)^content-length:\s*(\d+)", http)
    revisit = kind == "revisit"
    checks = [digest_matches(head.get("warc-block-digest"), block)]
    if not revisit and kind != "request":
        same = digest_matches(head.get("warc-payload-digest"), body)
        # of a chunked or encoded body the digest may be that of what it stands for
        plain = not re.search(rb"(?mi)^(transfer|content)-encoding:", http)
        checks.append(same if same or plain else None)
    if own_id(head.get("warc-record-id")) is not None and length and not revisit:
        checks.append(int(length[1]) == len(body))
    known = [c for c in checks if c is not None]
    given = head.get("warc-payload-digest")
    return {
        "id": own_id(head.get("warc-record-id")),
        "record_type": kind,
        "uri": head.get("warc-target-uri"),
        "date": head.get("warc-date"),
        "refers_to": own_id(head.get("warc-refers-to")),
        "payload_bytes": int(length[1]) if length and revisit else None if revisit else len(body),
        "payload_digest": given.removeprefix("sha256:") if given else None,
        "digest_ok": all(known) if known else None,
        "record_id": head.get("warc-record-id"),
        "refers_to_id": head.get("warc-refers-to"),
        "payload": None if revisit else body,
    }


def read_archives(spark: SparkSession, archives: DataFrame, payload: bool = True, strict: bool = True) -> DataFrame:
    """Read the archives that the column ``path`` names, one task per archive at a time.

    Returns ``id, record_type, uri, date, refers_to, payload_bytes, payload_digest, digest_ok, record_id, refers_to_id``
    and, if asked for, ``payload`` (NULL for revisits, whose length is that of their HTTP head).

    Archives of other writers are read too: records of every type, with or without an HTTP head (without one the
    payload is the whole block). ``id`` and ``refers_to`` are the row ids of this writer and NULL in others' records, whose ids are in
    ``record_id`` and ``refers_to_id``. ``payload_digest`` is a bare SHA-256, or ``algorithm:value`` as given,
    or NULL. MD5 and SHA digests in hex or base32 are verified; ``digest_ok`` is NULL where there is none to verify.
    A wrong or missing frame always fails with the archive's name; a wrong digest fails unless ``strict`` is off, when
    ``digest_ok`` is false. An empty list gives no rows.
    """
    schema = RECORDS if payload else RECORDS.remove(RECORDS.get_field_index("payload"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            system, place = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with system.open_input_stream(place, compression=None) as stream:
                for head, block in members(stream, path):
                    row = parsed(head, block)
                    if strict and row["digest_ok"] is False:
                        raise ValueError(f"{path}: record {row['record_id']} does not have its digest")
                    rows.append(row)
                    size += 500 + len(block) * payload
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    columns = "id bigint, record_type string, uri string, date string, refers_to bigint, payload_bytes bigint, payload_digest string, digest_ok boolean, record_id string, refers_to_id string"
    paths = archives.select("path").repartition(max(1, archives.count()))  # in turn, so that no task gets two
    return paths.mapInArrow(read, columns + (", payload binary" if payload else ""))
