"""BPE encoding and decoding through a table of distinct words.

``encode`` splits the texts into white-space separated words in blocks of
documents. A block keeps each word occurrence as a number (its position in
the block's sorted list of distinct words), and sends each distinct word to
the word table, which is spread over buckets by hash. A bucket encodes each
of its distinct words once and sends the ids back to the blocks that asked,
where they are joined to the occurrences by position. So what is shuffled is
one entry per block and distinct word instead of one per occurrence.

``decode`` joins ids to the vocabulary's pieces: the pieces, one row per id,
are the small side (its size is that of the vocabulary file), each id of a
text is looked up, and the pieces are joined in order.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import id_and_text, read_table, shared_folder, small_arrow_batches
from ledgerlens.llm.shards import file_system
from ledgerlens.llm.tokens import library_tokenizer, vocabulary_path, word_ids

#: Text bytes of a block (a longer document is a block of its own).
BLOCK_BYTES = 4 << 20
#: Words of the table a worker holds at once; a bucket past this is encoded
#: in several goes.
BUCKET_WORDS = 100_000
#: Parts into which the word table is dealt.
WORD_BUCKETS = 128


def _squeeze(a: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, byte planes apart."""
    most = int(a.max()) if len(a) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    planes = a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zlib.compress(planes.tobytes(), 1)


def _expand(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel()


def _block(texts: list[bytes], buckets: int) -> tuple[list[tuple], list[bytes]]:
    """([(bucket, n, words)], [lengths, occurrences]): the distinct words of
    the block by bucket, and each document's words as their numbers in that
    order."""
    split = [t.split() for t in texts]
    dealt: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in set().union(*split):
        dealt[zlib.crc32(word) % buckets].append(word)
    place, rows = {}, []
    for bucket, words in enumerate(dealt):
        if words:
            words.sort()
            place.update(zip(words, range(len(place), len(place) + len(words))))
            rows.append((bucket, len(words), zlib.compress(b" ".join(words), 1)))
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    found = np.empty(int(lengths.sum()), np.int64)
    at = 0
    for words in split:
        found[at:at + len(words)] = list(map(place.__getitem__, words))
        at += len(words)
    return rows, [_squeeze(lengths), _squeeze(found)]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, buckets: int = WORD_BUCKETS) -> DataFrame:
    """One row per input row: (id, ids), ids as little-endian uint32 bytes.

    For a vocabulary file that drops white space. No special tokens are
    added; special strings inside a text become their special token. A null
    or empty text has no ids. Repeated rows are all returned; an empty table
    gives no rows; other columns are ignored.

    The occurrences of a block are a file in the shared folder, named by its
    place and content and written under a temporary name first; the block's
    word rows name it. A task that runs again after a loss writes the same file, or, if
    it got its rows in another order, another one with rows of its own; a
    block that does not get all its words back stops the job.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType.simpleString()
    folder = shared_folder(spark, "bpe-blocks")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        names = ["block", "bucket", "n", "total", "data"]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

        def close(number: int, ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
            found, parts = _block(texts, buckets)
            # The ids travel as Arrow bytes beside the occurrences.
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("_id", ids.type)])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([ids], names=["_id"]))
            parts.append(sink.getvalue().to_pybytes())
            digest = hashlib.sha1()
            for piece in (*parts, *(r[2] for r in found)):
                digest.update(piece)
            name = f"{TaskContext.get().partitionId()}-{number}-{digest.hexdigest()}"
            if files.get_file_info(f"{root}/{name}").type.name == "NotFound":
                held = f"{root}/_{uuid.uuid4().hex}"
                with files.open_output_stream(held) as out:
                    for piece in parts:
                        out.write(len(piece).to_bytes(8, "little") + piece)
                files.move(held, f"{root}/{name}")
            total = sum(r[1] for r in found)
            table = [(name, *r[:2], total, r[2]) for r in found] or [(name, 0, 0, 0, zlib.compress(b""))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*table), kinds)], names=names)

        number, held_ids, texts, size = 0, [], [], 0
        for batch in batches:
            column, first = batch["_id"], 0
            for k, text in enumerate(batch["_text"].cast(pa.binary()).to_pylist()):
                if texts and size + len(text) > block_bytes:
                    held_ids.append(column.slice(first, k - first))
                    yield close(number, pa.concat_arrays(held_ids), texts)
                    number, held_ids, texts, size, first = number + 1, [], [], 0, k
                texts.append(text)
                size += len(text)
            held_ids.append(column.slice(first))
        if texts:
            yield close(number, pa.concat_arrays(held_ids), texts)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket's words -> how many ids each has, and the ids."""
        table = word_ids(vocabulary)
        for batch in batches:
            lists = [zlib.decompress(d).split() for d in batch["data"].to_pylist()]
            table.learn(set().union(*lists))
            out = []
            for words in lists:
                found = list(map(table.__getitem__, words))
                counts = _squeeze(np.fromiter(map(len, found), np.int64, len(found)) // 4)
                out.append(len(counts).to_bytes(4, "little") + counts
                           + _squeeze(np.frombuffer(b"".join(found), "<u4")))
            table.trim(BUCKET_WORDS)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("block", "bucket", "n", "total")),
                                              pa.array(out, pa.binary())],
                                             names=["block", "bucket", "n", "total", "data"])

    shape = "block string, bucket int, n int, total int, data binary"
    table = (rows.mapInArrow(split, shape)
             .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(look_up, shape)
             .repartition("block").sortWithinPartitions("block", "bucket"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The word ids of a block in bucket order meet its occurrences."""
        files, root = file_system(folder)
        counts, ids, have = [], [], 0
        for batch in batches:
            for name, n, total, data in zip(*(batch[c].to_pylist() for c in ("block", "n", "total", "data"))):
                cut = 4 + int.from_bytes(data[:4], "little")
                counts.append(_expand(data[4:cut]).astype(np.int64))
                ids.append(_expand(data[cut:]).astype("<u4"))
                have += n
                if have < total:
                    continue
                with files.open_input_stream(f"{root}/{name}") as source:
                    parts = [source.read(int.from_bytes(source.read(8), "little")) for _ in range(3)]
                size, flat = np.concatenate(counts), np.concatenate(ids)
                lengths, at = _expand(parts[0]).astype(np.int64), _expand(parts[1])
                if have != total or len(size) != total or (len(at) and int(at.max()) >= total):
                    raise ValueError(f"the words of block {name} are not complete")
                counts, ids, have = [], [], 0
                first, own = np.cumsum(size) - size, size[at]
                ends = np.concatenate([[0], np.cumsum(own)])
                # Position of each id of the block in the list of word ids.
                spots = np.repeat(first[at] - ends[:-1], own) + np.arange(ends[-1])
                raw = memoryview(flat[spots].tobytes())
                stops = (4 * ends[np.concatenate([[0], np.cumsum(lengths)])]).tolist()
                found = pa.ipc.open_stream(parts[2]).read_all().combine_chunks()["_id"]
                found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
                out = pa.array([bytes(raw[a:b]) for a, b in zip(stops, stops[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([found, out], names=["_id", "ids"])

        if counts:
            raise ValueError("the words of a block are not complete")

    return table.mapInArrow(join, f"_id {id_type}, ids binary").withColumnRenamed("_id", id_col)


@lru_cache(maxsize=2)
def _pieces(path: str) -> pa.Array:
    tokenizer = library_tokenizer(path)
    return pa.array([tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())], pa.string())


def decode(coded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids: pieces joined by one space, as the
    library decodes with a file that names no decoder (special tokens are
    written out). Null ids give null; no ids give the empty text."""
    small_arrow_batches(coded.sparkSession)
    tokenizer = library_tokenizer(vocabulary)
    if tokenizer.decoder is not None:
        raise ValueError("a file without a decoder is expected")

    @F.arrow_udf("string")
    def joined(column: pa.Array) -> pa.Array:
        pieces, out = _pieces(vocabulary), []
        for value in column.to_pylist():
            if value is None:
                out.append(None)
                continue
            found = pieces.take(pa.array(np.frombuffer(value, "<u4")))
            row = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)
            out.append(pc.binary_join(row, " ")[0].as_py())
        return pa.array(out, pa.string())

    return coded.withColumn(text_col, joined(F.col(ids_col)))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all whole ``documents`` texts, decode the ids, return digests."""
    vocabulary = vocabulary_path("word_bpe_49k.json")
    coded = decode(encode(read_table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {"op9_bpe": op9_bpe}
