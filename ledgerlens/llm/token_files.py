"""Token-id files: length-delimited binary records with a separate index.

A record is: payload length (uint64), masked checksum of those eight bytes
(uint32), payload, masked checksum of the payload (uint32), all little-endian.
The checksum is CRC-32, masked by rotating right 15 bits and adding a
constant, so that checksums of data that hold checksums stay apart. The
payload is the document id (int64), a null flag (uint8), the bytes per id
(uint8: 2 or 4) and the ids. Beside each ``.rec`` file lies an ``.idx`` file with
one (offset uint64, ids before it in the file uint64, ids uint32) entry per
record for shuffled reads.

Files hold ranges of ascending ids (see shards), roll by size, and are
published by manifest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from struct import Struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import id_and_text, read_table, shared_folder
from ledgerlens.llm.shards import commit, file_system, range_sorted, spread, temporary_name
from ledgerlens.llm.tokens import vocabulary_path, word_ids

HEAD, TAIL, META, ENTRY = Struct("<QI"), Struct("<I"), Struct("<qBB"), Struct("<QQI")
MANIFEST = ("shard long, part int, temporary string, file string, temporary_index string, index string, "
            "n_records long, n_tokens long, n_bytes long")
#: Text bytes of a shard and record bytes after which a file rolls.
SHARD_BYTES = 16 << 20
FILE_BYTES = 64 << 20


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return size + TAIL.pack(masked(size)) + payload + TAIL.pack(masked(payload))


def read_frame(source) -> bytes | None:
    """The next payload of an open file, None at its end; raises ValueError
    on a short or changed record."""
    head = source.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size or masked(head[:8]) != HEAD.unpack(head)[1]:
        raise ValueError("damaged record length")
    payload = source.read(HEAD.unpack(head)[0])
    tail = source.read(TAIL.size)
    if len(tail) < TAIL.size or masked(payload) != TAIL.unpack(tail)[0]:
        raise ValueError("damaged record")
    return payload


def payload_of(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return META.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def parse_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, missing, width = META.unpack_from(payload)
    return None if missing else doc_id, np.frombuffer(payload, f"<u{width}", offset=META.size).astype("<u4")


class _File:
    """A record file and its index, both under temporary names."""

    def __init__(self, folder: str, shard: int, part: int):
        self.row = {"shard": shard, "part": part, "n_records": 0, "n_tokens": 0, "n_bytes": 0}
        files, root = file_system(folder)
        files.create_dir(f"{root}/_temporary", recursive=True)
        name = f"ids-{shard:08d}-{part:05d}"
        for key, kind in (("", "rec"), ("_index", "idx")):
            self.row["temporary" + key] = temporary_name("").lstrip("/") + f".{kind}"
        self.row |= {"file": f"{name}.rec", "index": f"{name}.idx"}
        self.data = files.open_output_stream(f"{root}/{self.row['temporary']}")
        self.entries = files.open_output_stream(f"{root}/{self.row['temporary_index']}")

    def add(self, doc_id, ids: np.ndarray, width: int) -> None:
        record = frame(payload_of(doc_id, ids, width))
        self.entries.write(ENTRY.pack(self.row["n_bytes"], self.row["n_tokens"], len(ids)))
        self.data.write(record)
        self.row["n_bytes"] += len(record)
        self.row["n_tokens"] += len(ids)
        self.row["n_records"] += 1

    def close(self) -> pa.RecordBatch:
        self.data.close()
        self.entries.close()
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
        schema = pa.schema([(n, kinds[c.split()[1]]) for n, c in zip(names, MANIFEST.split(", "))])
        return pa.RecordBatch.from_pylist([self.row], schema)


def gathered(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches put together up to about ``size`` bytes, so the
    words they share are looked up once."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text",
                      shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row in ascending id order and return the manifest.

    A null text is empty (a record of the end id alone); null ids come first;
    repeated rows give repeated records, ordered by text. An empty table
    publishes an empty manifest. Other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col).select(
        F.col("_id").cast("long").alias("_id"), "_text", (F.octet_length("_text") + 64).alias("_weight"))
    placed = range_sorted(rows, "_id", "_weight", shard_bytes, ["_id", "_text"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, end = word_ids(vocabulary), None, np.array([end_id], "<u4")
        width = 2 if max(end_id, encoder.tokenizer.get_vocab_size()) <= 1 << 16 else 4
        for batch in gathered(batches):
            coded = encoder.encode(batch["_text"].cast(pa.binary()).to_pylist())
            for shard, doc_id, ids in zip(batch["_shard"].to_pylist(), batch["_id"].to_pylist(), coded):
                if out is not None and (out.row["shard"] != shard or out.row["n_bytes"] >= file_bytes):
                    part = out.row["part"] + 1 if out.row["shard"] == shard else 0
                    yield out.close()
                    out = _File(folder, shard, part)
                elif out is None:
                    out = _File(folder, shard, 0)
                out.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), end]), width)
        if out is not None:
            yield out.close()

    manifest = placed.select("_shard", "_id", "_text").mapInArrow(write, MANIFEST)
    # The index files are published by the same manifest as further files.
    held = f"{folder}/_temporary/written"
    manifest.write.parquet(held)
    manifest = docs.sparkSession.read.schema(manifest.schema).parquet(held)
    both = manifest.withColumn("kind", F.lit("rec")).unionByName(
        manifest.withColumn("kind", F.lit("idx")).withColumn("temporary", F.col("temporary_index"))
        .withColumn("file", F.col("index")))
    return commit(both.drop("temporary_index"), folder)


def read_token_files(manifest: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every record of the published files;
    ``start`` counts the ids of all records before it in id order. With
    ``digest`` the ids' CRC-32 (as uint32) takes the place of the ids."""
    files = manifest.where("kind = 'rec'")
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, no document rows.
    files = files.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for name, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                with system.open_input_stream(f"{root}/{name}", buffer_size=1 << 20) as source:
                    held, size = [], 0
                    while (payload := read_frame(source)) is not None:
                        doc_id, ids = parse_payload(payload)
                        held.append((doc_id, base, len(ids), zlib.crc32(ids) if digest else ids.tobytes()))
                        base, size = base + len(ids), size + len(payload)
                        if size > 4 << 20:
                            yield batch_of(held)
                            held, size = [], 0
                    if held:
                        yield batch_of(held)

    return spread(files).mapInArrow(
        read, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"))


def read_record(folder: str, name: str, number: int) -> tuple[int | None, np.ndarray]:
    """Record ``number`` of a file, found through its index: a shuffled read."""
    system, root = file_system(folder)
    with system.open_input_file(f"{root}/{name[:-4]}.idx") as index:
        index.seek(number * ENTRY.size)
        offset = ENTRY.unpack(index.read(ENTRY.size))[0]
    with system.open_input_file(f"{root}/{name}") as data:
        data.seek(offset)
        return parse_payload(read_frame(data))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all whole ``documents`` texts as token-id files, read them back
    and return where each document lies and the checksum of its ids."""
    folder = shared_folder(spark, "token-files")
    manifest = write_token_files(read_table(spark, sf_dir, "documents"), folder,
                                 vocabulary_path("word_bpe_49k.json"))
    return read_token_files(manifest, folder, digest=True)


QUERIES = {"op8_token_files": op8_token_files}
