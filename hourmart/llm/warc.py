"""Web archives: one gzip member per record, written and read in sequence."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, map_arrow, packed, tuned

#: Payloads of fewer bytes are always stored in full.
LEAST_REVISIT = 100
#: A task starts a new file beyond this size.
FILE_BYTES = 64 << 20
#: Bytes that the reader asks for at once.
READ_BYTES = 1 << 18
#: Speed over size; the format allows any level.
GZIP_LEVEL = 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


class WarcError(ValueError):
    """A file that is not a sequence of whole records."""


# Writing


def _sha256(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return "<urn:x-page:none>" if page_id is None else f"<urn:x-page:{page_id}>"


def _uri(url: str | None, page_id: int | None) -> str:
    """A target address without spaces and control characters."""
    if not url:
        return _record_id(page_id)[1:-1]
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None
) -> bytes:
    """One record as a gzip member; without a payload it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload or b"")
    kind = "response" if payload is not None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha256:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Block-Digest", _sha256(block)),
    ]
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    member = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return member.compress(head.encode() + block + b"\r\n\r\n") + member.flush()


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit: int = LEAST_REVISIT,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write every row as a record below ``folder``; lazily gives (path, records, bytes) of the files.

    Of records with equal payloads of at least ``least_revisit`` bytes, that with the
    smallest identifier is a response and the others revisit it.  Repeated payloads
    are found by digest and length in an aggregate that combines before the shuffle;
    the payloads of revisits are dropped before rows move.

    A file's name is new in each attempt of a task, so a task that runs again leaves
    an unlisted file, not a broken one.  ``folder`` is a shared folder that pyarrow
    can open.  Null payloads are empty; null addresses become the record's name; rows
    with a null identifier revisit only others and are revisited only if there are no others.
    """
    spark = tuned(pages.sparkSession)
    scratch = Scratch(spark, "warc")
    payload = F.coalesce(F.col(f"row.`{payload_col}`"), F.lit("")).cast("binary")
    own = packed(pages).select(
        F.col(f"row.`{id_col}`").cast("long").alias("page_id"),
        F.col(f"row.`{url_col}`").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    repeated = (
        own.where(F.col("size") >= least_revisit)
        .groupBy("digest", "size")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("first"))
        .where("copies > 1 and first is not null")
        .select("digest", "size", "first")
    )
    # Stored, so its measured size decides whether it is sent to all tasks or joined by shuffle.
    first = scratch.store(repeated, "repeated")
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    rows = own.join(first, ["digest", "size"], "left").select(
        "page_id",
        "url",
        F.when(~revisits, F.col("payload")).alias("payload"),
        "digest",
        "size",
        F.when(revisits, F.col("first")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        out, path, records, done = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{path}"], "records": [records], "bytes": [done]}
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if out is None:
                    path, records, done = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{path}", compression=None)
                data = record_bytes(*row)
                out.write(data)
                records, done = records + 1, done + len(data)
                if done >= file_bytes:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()

    return map_arrow(rows, write, "path string, records long, bytes long")


# Reading


@dataclass
class Record:
    """A record's fields, in lower case, and its whole block."""

    fields: dict[str, str]
    block: bytes

    def http(self) -> tuple[dict[str, str], bytes]:
        head, gap, body = self.block.partition(b"\r\n\r\n")
        if not gap:
            raise WarcError("HTTP headers without end")
        return _fields(head), body


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _members(stream: BinaryIO, read_bytes: int) -> Iterator[Iterator[bytes]]:
    """For each gzip member of a stream the pieces of its content, inflated as they are read."""
    waiting = stream.read(read_bytes)
    while waiting:
        inflate = zlib.decompressobj(31)

        def pieces(inflate=inflate) -> Iterator[bytes]:  # noqa: ANN001
            nonlocal waiting
            while not inflate.eof:
                if not waiting and not (waiting := stream.read(read_bytes)):
                    raise WarcError("file ends inside a member")
                data = inflate.decompress(waiting, read_bytes * 4)
                waiting = inflate.unconsumed_tail if not inflate.eof else inflate.unused_data
                if data:
                    yield data

        yield pieces()
        if not waiting:
            waiting = stream.read(read_bytes)


def read_records(stream: BinaryIO, read_bytes: int = READ_BYTES) -> Iterator[Record]:
    """The records of one file in order, each framed by its Content-Length."""
    try:
        for member in _members(stream, read_bytes):
            held = bytearray()
            for data in member:
                held += data
                if (end := held.find(b"\r\n\r\n")) >= 0:
                    break
            else:
                raise WarcError("headers without end")
            if not held.startswith(b"WARC/1."):
                raise WarcError("not a record")
            fields = _fields(bytes(held[:end]))
            length = int(fields["content-length"])
            del held[: end + 4]
            for data in member:
                held += data
                if len(held) > length + 4:
                    break
            if len(held) != length + 4 or held[length:] != b"\r\n\r\n":
                raise WarcError("content length does not match the member")
            yield Record(fields, bytes(held[:length]))
    except (zlib.error, KeyError) as fault:
        raise WarcError(str(fault)) from fault


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _hex(digest: str | None) -> str | None:
    kind, _, value = (digest or "").partition(":")
    return base64.b32decode(value).hex() if kind == "sha256" else None


def read_archives(
    spark: SparkSession, files: DataFrame, tasks: int | None = None, payloads: bool = True
) -> DataFrame:
    """The records of the files in column ``path``, one row each.

    Gives page_id, payload_bytes, payload_digest (hex), record_type, refers_to,
    digest_ok and, with ``payloads``, payload (null for revisits).  A response's
    payload length and digest are those of the payload read; ``digest_ok`` says
    whether block and payload match the digests in the record.  A revisit has no
    payload: its length and digest are those that the record states.  A file is read
    in sequence in bounded pieces by one task; a broken file raises ``WarcError``.
    """
    tuned(spark)
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, digest_ok boolean" + (", payload binary" if payloads else "")
    )
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
    names = [part.split()[0] for part in schema.split(", ")]

    def rows(path: str) -> Iterator[tuple]:
        store, inner = _open(path)
        with store.open_input_stream(inner, compression=None) as stream:
            for record in read_records(stream):
                stated = _hex(record.fields.get("warc-payload-digest"))
                http, payload = record.http()
                kind = record.fields["warc-type"]
                right = _sha256(record.block) == record.fields.get("warc-block-digest")
                size, digest = int(http["content-length"]), stated
                if kind == "response":
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    right = right and digest == stated and size == int(http["content-length"])
                yield (
                    _page(record.fields.get("warc-record-id")),
                    size,
                    digest,
                    kind,
                    _page(record.fields.get("warc-refers-to")),
                    right,
                    payload if kind == "response" else None,
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for row in rows(path):
                    held.append(row)
                    size += row[1] + 100
                    if size > (8 << 20):
                        yield made(held)
                        held, size = [], 0
                if held:
                    yield made(held)

    def made(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))[: len(names)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=False)], names
        )

    paths = files.select("path")
    return map_arrow(paths.repartition(tasks) if tasks else paths, read, schema)
