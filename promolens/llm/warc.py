"""WARC archives: write whole-file gzip streams, normalise them to one member a record, read."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import map_batches, text_bytes
from promolens.session import stage, staging_path

MIN_REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
_READ = 1 << 20
_GZIP = 31  # zlib's window setting for a gzip wrapper
_LOW = (1 << 62) - 1
_BLANKS = " \t"
EPOCH = "1970-01-01T00:00:00Z"
# Fixed value: the profile of revisits that the WARC standard names for equal payloads.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it; ``s3a`` and ``s3n`` are S3."""
    if re.match(r"[a-z][a-z0-9+.-]*:", uri) and not uri.startswith("file:"):
        return pafs.FileSystem.from_uri(store_uri(uri))
    return pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", uri)


def store_uri(uri: str) -> str:
    """The folder under the scheme that Arrow knows it by."""
    return re.sub(r"^s3[an]://", "s3://", uri)


def _field(value) -> str:
    """A header value without line breaks or outer blanks (percent-encoded)."""
    return re.sub(
        r"[\r\n%]|\A[ \t]+|[ \t]+\Z",
        lambda m: "".join(f"%{ord(c):02X}" for c in m[0]),
        str(value),
    )


def _unfield(value: str) -> str:
    return re.sub("%(0D|0A|25|20|09)", lambda m: chr(int(m[1], 16)), value)


def page_record_id(page_id: int) -> str:
    """The record id of the response that others may refer to: a custom UUID (version 8) whose
    last 64 bits, but for the two that mark the variant, are the page's id."""
    value = page_id % (1 << 64)
    number = 8 << 76 | (value >> 62) << 64 | 0b10 << 62 | value & _LOW
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(record_id: str) -> int:
    """The page's id in a ``page_record_id``."""
    number = uuid.UUID(record_id.strip("<>").removeprefix("urn:uuid:")).int
    value = (number >> 64 & 3) << 62 | number & _LOW
    return value - (1 << 64) if value >> 63 else value


def _record(head: dict, body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def info_bytes(name: str, date: str) -> bytes:
    """The warcinfo record that opens an archive."""
    body = b"software: promolens\r\nformat: WARC File Format 1.1\r\n"
    head = {
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": date,
        "WARC-Filename": name,
        "Content-Type": "application/warc-fields",
        "Content-Length": len(body),
    }
    return _record(head, body)


def record_bytes(
    page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str = EPOCH
) -> bytes:
    """A response with its HTTP head and payload, or a revisit with the HTTP head alone.

    A response that others refer to is named after its page, so rows that repeat such a page share
    the id; any other record has an id of its own.
    """
    body = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    named = not revisit and refers_to is not None
    # Only a URL with line breaks or outer blanks is encoded; percent escapes of others are their
    # own.
    encode = re.search(r"[\r\n]|\A[ \t]|[ \t]\Z", url or "")
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": page_record_id(page_id) if named else f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": date,
        "WARC-Target-URI": _field(url) if encode else url,
        "X-Encoded": "WARC-Target-URI" if encode else None,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": page_record_id(refers_to) if revisit else None,
        "WARC-Refers-To-Date": date if revisit else None,
        "X-Page-Id": page_id,
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(body) + (0 if revisit else len(payload)),
    }
    return _record(head, body if revisit else body + payload)


def inflate(stream) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, piece by piece, read once."""
    engine, inside = zlib.decompressobj(_GZIP), False
    while piece := stream.read(_READ):
        if not inside:  # padding may go on in the next read
            piece = piece.lstrip(b"\0")
        while piece or inside:
            out = engine.decompress(piece, _READ)
            inside = True
            if out:
                yield out
            if engine.eof:  # zeros may pad the end of a member
                piece, inside = engine.unused_data.lstrip(b"\0"), False
                engine = zlib.decompressobj(_GZIP)
            else:
                piece = engine.unconsumed_tail
                if not piece and len(out) < _READ:
                    break
    if inside:
        raise ValueError("the gzip stream ends early")


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields, name = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name is not None:  # a folded line
            fields[name] = f"{fields[name]} {line.strip(_BLANKS)}".strip(_BLANKS)
        elif line:
            name, value = line.split(":", 1)
            fields[name] = value.strip(_BLANKS)
    return fields


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record's header fields and its whole bytes. Holds one record at a time."""
    buffer = bytearray()
    pieces = iter(pieces)

    def fill(size: int) -> bool:
        while len(buffer) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("the archive ends in a header")
        head = parse_head(bytes(buffer[:end]))
        size = end + 4 + int(head["Content-Length"]) + 4
        if not fill(size):
            raise ValueError("the archive ends in a record")
        yield head, bytes(buffer[:size])
        del buffer[:size]


def deflate_member(record: bytes) -> bytes:
    engine = zlib.compressobj(4, zlib.DEFLATED, _GZIP)
    return engine.compress(record) + engine.flush()


def write_archives(
    pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, date: str = EPOCH
) -> DataFrame:
    """Write rows (page_id, url, payload, digest, first_id, revisit) as gzip streams.

    Each task rolls to a new file after ``file_bytes`` of records. Files get unique names; a
    repeated task leaves files that no row names. Returns (file).
    """

    def write(batches: Iterator[dict]) -> Iterator[dict]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out = engine = name = None
        written = 0
        for batch in batches:
            columns = ("page_id", "url", "_payload", "_digest", "_first", "_revisit")
            for row in zip(*(batch[c] for c in columns), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    engine = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
                    written = 0
                    out.write(engine.compress(info_bytes(name, date)))
                record = record_bytes(*row, date)
                out.write(engine.compress(record))
                written += len(record)
                if written >= file_bytes:
                    out.write(engine.flush())
                    out.close()
                    out = None
                    yield {"file": [name]}
        if out is not None:
            out.write(engine.flush())
            out.close()
            yield {"file": [name]}

    return map_batches(pages, write, "file string")


def normalise_file(store, source: str, target: str) -> int:
    """Rewrite one archive with a gzip member for each record and an index beside it.

    The index has a line for each record: offset, length, type, record id. Returns the records.
    """
    count = offset = 0
    with (
        store.open_input_stream(source, compression=None) as stream,
        store.open_output_stream(target, compression=None) as out,
        store.open_output_stream(f"{target}.idx", compression=None) as index,
    ):
        for head, record in split_records(inflate(stream)):
            member = deflate_member(record)
            out.write(member)
            line = f"{offset}\t{len(member)}\t{head['WARC-Type']}\t{head['WARC-Record-ID']}\n"
            index.write(line.encode())
            offset += len(member)
            count += 1
    return count


def normalise_archives(files: DataFrame, source: str, target: str) -> DataFrame:
    """Normalise each named archive, one stream a task. Returns (file, n_records)."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        store, here = open_store(source)
        _, there = open_store(target)
        store.create_dir(there, recursive=True)
        for batch in batches:
            for name in batch["file"]:
                new = f"{uuid.uuid4().hex}-{name}"
                n = normalise_file(store, f"{here}/{name}", f"{there}/{new}")
                yield {"file": [new], "n_records": [n]}

    return map_batches(files, run, "file string, n_records long")


def read_record(member: bytes) -> dict:
    """One record from its own member; a response's digest is computed from its payload."""
    data = zlib.decompress(member, _GZIP)
    end = data.index(b"\r\n\r\n")
    head = parse_head(data[:end])
    block = data[end + 4 : end + 4 + int(head["Content-Length"])]
    body = block.split(b"\r\n\r\n", 1)[1]  # after the HTTP head
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = head["WARC-Type"] == "revisit"
    uri = head.get("WARC-Target-URI")
    if "X-Encoded" in head:
        uri = _unfield(uri)
    if not revisit and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": int(head["X-Page-Id"]) if "X-Page-Id" in head else None,
        "payload_bytes": int(head["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": page_of(head["WARC-Refers-To"]) if revisit else None,
        "target_uri": uri,
    }


RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, target_uri string"
)


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Every record of normalised archives, each fetched by its entry in the sidecar index."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        store, root = open_store(folder)
        for batch in batches:
            for name in batch["file"]:
                with store.open_input_stream(f"{root}/{name}.idx", compression=None) as index:
                    entries = [line.split("\t") for line in index.read().decode().splitlines()]
                entries = [e for e in entries if e[2] != "warcinfo"]
                with store.open_input_file(f"{root}/{name}") as data:
                    for at in range(0, len(entries), 1000):
                        rows = [
                            read_record(data.read_at(int(length), int(offset)))
                            for offset, length, *_ in entries[at : at + 1000]
                        ]
                        yield {c.split()[0]: [r[c.split()[0]] for r in rows]
                               for c in RECORD.split(", ")}

    return map_batches(files, run, RECORD)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add payload, digest, and which page holds the payload that this one only refers to.

    Of equal payloads of at least ``min_bytes`` the smallest page_id is the response (all rows
    of that id, if it repeats); NULL ids come last.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_bytes("html").alias("_payload"),
    ).withColumn("_digest", F.sha2("_payload", 256))
    firsts = (
        rows.where(F.octet_length("_payload") >= min_bytes)
        .groupBy(F.col("_digest").alias("_same"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _first is not null")
        .drop("_n")
    )
    joined = rows.join(firsts, rows["_digest"] == firsts["_same"], "left").drop("_same")
    revisit = F.coalesce(~F.col("_first").eqNullSafe(F.col("page_id")), F.lit(True))
    return joined.withColumn("_revisit", F.col("_first").isNotNull() & revisit)


def archive_round_trip(
    spark: SparkSession,
    pages: DataFrame,
    min_bytes: int = MIN_REVISIT_BYTES,
    date: str | None = None,
) -> DataFrame:
    """Write, normalise and read back one record per page.

    NULL html is an empty payload, NULL url and page_id are left out of the record and read as
    NULL; an empty table gives no file and no row. Texts of any length are one record, repeated
    rows a record each. Other columns are not read. ``date`` (UTC, ``YYYY-MM-DDThh:mm:ssZ``, by
    default now) is the WARC-Date of all records, as pages do not tell theirs. Archives lie in
    the session's shared folder.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    raw, clean = staging_path(spark, "warc-stream"), staging_path(spark, "warc")
    rows = with_revisits(pages, min_bytes)
    written = stage(write_archives(rows, raw, date=date), "warc-files")
    spread = written.repartition(max(1, written.count()))
    done = stage(normalise_archives(spread, raw, clean), "warc-normalised")
    return read_archives(done.select("file").repartition(max(1, done.count())), clean)
