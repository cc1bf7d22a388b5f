"""JSON documents of any size, cut into small ones.

A reader of whole documents holds the text and the rows of one at the same
time. Here a task streams a document and cuts the arrays of its top-level
fields between elements: a part is a document of its own, with one field and
some of its elements, and Spark parses it with the schema of the whole. What is
left of the document, with those arrays empty, is one more part. A document is
damaged when one of its parts is, or when it ends too early.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.session import stored
from ledgerlens.sources.files import CORRUPT, DAMAGED, UNREADABLE, held_name
from ledgerlens.sources.objects import CHUNK, _dealt, file_system, list_files

#: A part is cut at the next element after so many bytes.
PART_BYTES = 1 << 16
#: An element, or all that is outside of arrays, longer than this is taken as
#: damage: a bracket or quote that is never closed runs to the end of the file.
MOST_BYTES = 1 << 27
#: Parts that travel together.
_BATCH_BYTES = 1 << 22

_STRING = rb'"(?:[^"\\]++|\\.)*+"|\'(?:[^\'\\]++|\\.)*+\''
_TO_BRACKET = re.compile(rb'(?:[^"\'{}\[\]]++|' + _STRING + rb')*+([{}\[\]])', re.S)
_TO_COMMA = re.compile(rb'(?:[^"\'{}\[\],]++|' + _STRING + rb')*+([{}\[\],])', re.S)
_NAME = re.compile(rb'(' + _STRING + rb')\s*:\s*\[\Z', re.S)


class Cut:
    """The parts of a document given in chunks; afterwards ``whole`` tells
    whether it was closed, ``n_chars`` its length and ``begins`` its start."""

    def __init__(self, chunks: Iterator[bytes], sample_chars: int, part_bytes: int = PART_BYTES, most_bytes: int = MOST_BYTES):
        self.whole, self.n_chars, self.begins, self.blank = False, 0, "", True
        self._sample, self._part, self._most = sample_chars, part_bytes, most_bytes
        self._valid, self._chunks = True, self._utf8(chunks)

    def _utf8(self, chunks: Iterator[bytes]) -> Iterator[bytes]:
        decoder = None
        for chunk in chunks:
            if decoder is None:
                encoding = json.detect_encoding(chunk[:4])
                decoder = codecs.getincrementaldecoder(encoding)("strict")
            try:
                text = decoder.decode(chunk)
            except UnicodeDecodeError:
                self._valid, text = False, chunk.decode("utf-8", "replace")
            self.n_chars += len(text)
            if len(self.begins) < self._sample:
                self.begins = (self.begins + text)[:self._sample]
            self.blank = self.blank and not text.strip()
            yield chunk if encoding == "utf-8" else text.encode("utf-8", "replace")
        # A character that the file ends in the middle of.
        self._valid = self._valid and (decoder is None or not decoder.getstate()[0])

    def __iter__(self) -> Iterator[str]:
        try:
            yield from (part.decode() for part in self._parts())
        except UnicodeDecodeError:
            self._valid = False
        for _ in self._chunks:
            pass
        self.whole = self.whole and self._valid

    def _parts(self) -> Iterator[bytes]:
        buf, pos, mark, depth, field, cut, rest = b"", 0, 0, 0, None, False, bytearray()
        while True:
            found = (_TO_COMMA if field and depth == 2 else _TO_BRACKET).match(buf, pos)
            if len(buf) - mark > self._most or len(rest) > self._most:
                return
            if not found:
                if not field:  # what is outside of arrays is kept apart
                    rest += buf[mark:pos]
                    mark = pos
                # As much again as was searched in vain, so that a long text is searched few times.
                more, size = [], 0
                while size <= len(buf) - pos and (chunk := next(self._chunks, None)) is not None:
                    more.append(chunk)
                    size += len(chunk)
                if not more:
                    return
                buf, pos, mark = b"".join([buf[mark:], *more]), pos - mark, 0
                continue
            end, token = found.end(), found[1]
            if depth == 0 and (token != b"{" or buf[pos:end - 1].strip()):
                return  # no object
            if token == b",":
                if end - 1 - mark >= self._part:
                    yield b"{" + field + b":[" + buf[mark:end - 1] + b"]}"
                    mark, cut = end, True
            elif token in b"{[":
                depth += 1
                if depth == 2 and token == b"[" and (name := _NAME.search(buf, pos, end)):
                    rest += buf[mark:end]
                    field, mark, cut = name[1], end, False
            else:
                depth -= 1
                if field and depth == 1:
                    if token != b"]":
                        return
                    body = buf[mark:end - 1]
                    if body.strip():
                        yield b"{" + field + b":[" + body + b"]}"
                    elif cut:
                        return  # a comma and no element
                    field, mark = None, end - 1
                if depth == 0:
                    rest += buf[mark:end]
                    yield bytes(rest)
                    self.whole = True
                    return
            pos = end


def _cut(sample_chars: int, part_bytes: int):
    """Tasks that stream (path, uri) into the rows of ``json_parts``: parts,
    and a last row for the document."""
    names = ["file_path", "text", "n_chars", "begins", "whole"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, uri in zip(batch["path"].to_pylist(), batch["uri"].to_pylist()):
                files, at = file_system(unquote(uri))
                with files.open_input_stream(at) as data:  # decompressed as its name tells
                    document, rows, size = Cut(iter(lambda: data.read(CHUNK), b""), sample_chars, part_bytes), [], 0
                    for text in document:
                        rows.append((path, text, None, None, None))
                        size += len(text)
                        if size >= _BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                if not document.blank:
                    rows.append((path, None, document.n_chars, document.begins, document.whole))
                if rows:
                    yield batch_of(rows)

    return run


def json_parts(spark: SparkSession, paths: str | Sequence[str], schema: StructType, glob: str | None = "*.json",
               sample_chars: int = 200, part_bytes: int = PART_BYTES) -> DataFrame:
    """(file_path, file_name, doc, damaged, begun, n_chars, begins, whole): the
    documents of files in parts, ``doc`` a struct of ``schema``, absent fields
    NULL; ``begun`` as in ``read_json_documents``. The last row of a document
    has no ``doc`` but the columns after ``begun``.

    A document is one JSON object in a file, which may be compressed (.gz);
    what follows it is not read. A task streams a file and holds no more of it
    than an element of a top-level array, or all that is outside of these
    arrays. Of a field that occurs twice the elements of both are given."""
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    cut = _dealt(list_files(spark, paths, glob).select("path", "uri")).mapInArrow(
        _cut(sample_chars, part_bytes), "file_path string, text string, n_chars bigint, begins string, whole boolean")
    read = cut.withColumn("_d", F.from_json("text", whole, {"columnNameOfCorruptRecord": CORRUPT}))
    begun = F.lit(False)
    for f in schema.fields:
        begun = begun | F.col(f"_d.`{f.name}`").isNotNull()
    damaged = F.col(f"_d.`{CORRUPT}`").isNotNull()
    return read.select(
        "file_path", held_name(F.element_at(F.split("file_path", "/"), -1)).alias("file_name"),
        F.when(F.col("text").isNotNull() & ~damaged, F.struct(*[F.col(f"_d.`{f.name}`") for f in schema.fields])).alias("doc"),
        damaged.alias("damaged"), begun.alias("begun"), "n_chars", "begins", "whole")


def json_documents(parts: DataFrame) -> DataFrame:
    """(file_path, file_name, n_chars, text, reason) of the documents of
    ``json_parts``: ``reason`` is NULL for a whole one, ``text`` its start."""
    unreadable = ~F.bool_and("whole") | F.bool_or(F.col("damaged") & ~F.col("begun"))
    return parts.groupBy("file_path", "file_name").agg(
        F.max("n_chars").alias("n_chars"), F.max("begins").alias("text"),
        F.when(unreadable, F.lit(UNREADABLE)).when(F.bool_or("damaged"), F.lit(DAMAGED)).alias("reason"))


def read_json_parts(spark: SparkSession, paths: str | Sequence[str], schema: StructType, glob: str | None = "*.json") -> tuple[DataFrame, DataFrame]:
    """((file_path, file_name, doc), rejects): the parts of whole documents,
    and (file_path, file_name, n_chars, text, reason) of the damaged ones. The
    documents are read and parsed once and stored."""
    parts = stored(json_parts(spark, paths, schema, glob), "document-parts")
    documents = json_documents(parts)
    sound = documents.where("reason IS NULL").select("file_path")
    docs = parts.where("doc IS NOT NULL").select("file_path", "file_name", "doc").join(F.broadcast(sound), "file_path", "left_semi")
    return docs, documents.where("reason IS NOT NULL")
