"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id (see shards), each is a gzip member of
its own, and files roll by compressed size. Headers and digests are made anew
from the payload: record id and date depend on the content and a parameter
only, so equal input gives equal bytes. Of records with equal payloads the
first is a ``response``; the others are ``revisit`` records that name it and
carry no body. Files are written under temporary names and published by
manifest.

Which records repeat is found on slim (id, digest) rows; the page bodies are
shuffled once, straight to their shard, where the notes about repeats sort in
just before the record they concern.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import read_table, shared_folder
from ledgerlens.llm.shards import commit, file_system, range_sorted, spread, temporary_name

MANIFEST = "shard long, part int, temporary string, file string, n_records long, n_bytes long, sha256 string"
SHARD_BYTES = 8 << 20
FILE_BYTES = 32 << 20
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _line(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int,
                 refers_to: int | None, date: str) -> bytes:
    """One record, before compression. ``payload`` None makes a revisit."""
    revisit = payload is None
    key = f"{page_id}\n{url}\n{digest}\n{refers_to}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"")
    head += [f"WARC-Block-Digest: sha1:{digest32(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(source) -> Iterator[bytes]:
    """The uncompressed members of an open gzip file, one at a time."""
    data = b""
    while True:
        if not data and not (data := source.read(1 << 20)):
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data and not (data := source.read(1 << 20)):
                raise ValueError("truncated member")
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names), http head and payload of a record; raises
    ValueError if a length or digest does not fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if rest[len(block):] != b"\r\n\r\n" or fields["warc-block-digest"] != "sha1:" + digest32(block):
        raise ValueError("damaged record")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != "sha1:" + digest32(payload):
        raise ValueError("damaged payload")
    return fields | {"http": http, "payload": payload}


class _Archive:
    def __init__(self, folder: str, shard: int, part: int):
        files, root = file_system(folder)
        files.create_dir(f"{root}/_temporary", recursive=True)
        self.row = {"shard": shard, "part": part, "temporary": temporary_name("").lstrip("/"),
                    "file": f"pages-{shard:08d}-{part:05d}.warc.gz", "n_records": 0, "n_bytes": 0}
        self.out, self.sum = files.open_output_stream(f"{root}/{self.row['temporary']}"), hashlib.sha256()

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.row["n_records"] += 1
        self.row["n_bytes"] += len(data)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
        schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in MANIFEST.split(", "))])
        return pa.RecordBatch.from_pylist([self.row | {"sha256": self.sum.hexdigest()}], schema)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               body_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
               shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row and return the manifest.

    A null body is an empty payload. Payloads below ``least_bytes`` are
    always responses. Of equal payloads the record with the smallest id is
    the response; among rows that repeat that id, the first by URL. Rows with
    a null id come first in shard 0, and are the response only if no record
    of the payload has an id. An empty table publishes an empty manifest.
    Other columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"),
                        F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8").alias("_body"))
    slim = rows.select("_id", F.unhex(F.sha1("_body")).alias("_sha"), F.octet_length("_body").alias("_size"))
    heads = (slim.where(F.col("_size") >= least_bytes).groupBy("_sha")
             .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    # One note per (id, payload) that has copies; the writer meets it first.
    notes = (slim.join(heads.select("_sha", "_first"), "_sha").distinct()
             .select("_id", F.lit(None).cast("string").alias("_url"), F.lit(None).cast("binary").alias("_body"),
                     F.lit(0).cast("long").alias("_weight"), F.lit(0).alias("_kind"), "_sha", "_first"))
    bodies = rows.select("_id", "_url", "_body", (F.octet_length("_body") + 512).cast("long").alias("_weight"),
                         F.lit(1).alias("_kind"), F.lit(None).cast("binary").alias("_sha"),
                         F.lit(None).cast("long").alias("_first"))
    placed = range_sorted(bodies, "_id", "_weight", shard_bytes, ["_id", "_kind", "_url", "_body"], also=notes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, noted = None, (), {}
        for batch in batches:
            for shard, page, url, body, kind, sha, first in zip(*(batch[c].to_pylist() for c in (
                    "_shard", "_id", "_url", "_body", "_kind", "_sha", "_first"))):
                if at != (shard, page):
                    at, noted = (shard, page), {}
                if kind == 0:
                    noted[sha] = first
                    continue
                sha = hashlib.sha1(body).digest()
                digest, refers, size = base64.b32encode(sha).decode("ascii"), None, len(body)
                if sha in noted:
                    if noted[sha] != page:
                        refers = noted[sha]
                    elif page is not None and (sha, "seen") in noted:
                        refers = page
                    noted[sha, "seen"] = True
                if out is not None and (out.row["shard"] != shard or out.row["n_bytes"] >= file_bytes):
                    part = out.row["part"] + 1 if out.row["shard"] == shard else 0
                    yield out.close()
                    out = _Archive(folder, shard, part)
                elif out is None:
                    out = _Archive(folder, shard, 0)
                out.add(gzip_member(record_bytes(page, url, body if refers is None else None, digest, size,
                                                 refers, date)))
        if out is not None:
            yield out.close()

    return commit(placed.select("_shard", "_id", "_url", "_body", "_kind", "_sha", "_first")
                  .mapInArrow(write, MANIFEST), folder)


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the published archives, lengths and digests
    checked: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for a revisit)."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        for batch in batches:
            for name in batch["file"].to_pylist():
                with files.open_input_stream(f"{root}/{name}", compression=None) as source:
                    held, size = [], 0
                    for data in members(source):
                        r = parse_record(data)
                        length = next(int(x[16:]) for x in r["http"].decode().split("\r\n")
                                      if x.lower().startswith("content-length: "))
                        response = r["warc-type"] == "response"
                        held.append((number(r.get("x-page-id")), r.get("warc-target-uri"), length,
                                     r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"],
                                     number(r.get("x-refers-to-page-id")), r["payload"] if response else None))
                        size += len(data)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return spread(manifest.select("file")).mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, payload binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all whole ``pages`` as WARC, read the archives back, and return
    what each record says of its payload."""
    folder = shared_folder(spark, "warc")
    manifest = write_warc(read_table(spark, sf_dir, "pages"), folder)
    return read_warc(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op1_warc": op1_warc}
