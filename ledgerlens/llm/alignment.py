"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the bytes of space+text; tokens that overlap belong
together, and offsets where tokens of both end separate the groups. Groups are
found by pointer jumping: every token points to its farthest-right overlapping
token of the other side, the token that ends at a common offset points to
itself, and doubling the successors leads every token to its group's last one.

Neither tokenizer joins anything across a boundary from a character that is
not white space to a space (checked on the vocabulary of B, a property of the
split pattern of A), so texts are cut there and each distinct chunk of a block
of documents is encoded and aligned once, all chunks of the block in the same
arrays. A document is then a list of chunk numbers.

Counts: a block sends one row per distinct id pair with the number of its
documents that hold it; the pairs are summed over the corpus, and each block's
pairs come back with their counts, where they meet the block's documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import id_and_text, read_table, small_arrow_batches, written
from ledgerlens.llm.tokens import byte_ids, vocabulary_path

#: Text bytes of a block (a longer document is a block of its own).
BLOCK_BYTES = 2 << 20
#: Characters of chunks, and their pairs, that a worker remembers from block
#: to block; a table beyond is emptied.
TABLE_CHARS = 3_000_000
TABLE_PAIRS = 2_000_000
#: Characters of chunks that are encoded as one text.
JOINED_CHARS = 1 << 16
#: Links of a group from which equal ids are brought together first.
LARGE_GROUP = 4096
#: Bits for an id of B in a pair's code.
B_BITS = 24

_SPACE_BEFORE_SPACE = re.compile(r"\s ").search
_CUT = re.compile(r"(?<=\S)(?= )").split


def chunks_of(text: str) -> list[str]:
    """space+text cut before every space that follows other than white space."""
    if _SPACE_BEFORE_SPACE(text) or text[0] == " ":
        return _CUT(" " + text)
    return [" " + w for w in text.split(" ")]


class Encoders:
    """The two encoders and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        a = byte_ids(path_a)
        if a.fast is None:
            raise ValueError("a byte-level vocabulary without normaliser is expected for A")
        self.a, self.size_a = a.fast, np.zeros(max(a.vocabulary.values()) + 1, np.int64)
        for piece, i in a.vocabulary.items():
            self.size_a[i] = len(piece)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names) or self.b.encode("a  b ", out_type=str)[-1] != "▁":
            raise ValueError("pieces of B may not hold a space after another character")
        self.pieces = [bytes([int(n[3:-1], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode("utf-8")
                       for i, n in enumerate(names)]
        self.size_b = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))

    def of_b(self, texts: list[str]) -> list[np.ndarray]:
        """B adds the first space itself; an empty text, though, gets no ids."""
        found = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [np.array(f or [self.b.piece_to_id("▁")], np.int64) for f in found]

    def both(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(chunks whose bytes B keeps, in another order; A's ids and their
        number a chunk; the same of B).

        Chunks that end in other than white space are joined: the next one
        starts with a space, which is where both tokenizers cut. A joined text
        that B changes is taken apart again."""
        joined: list[list[str]] = []
        size = JOINED_CHARS
        for c in chunks:
            if c[-1].isspace() or len(c) >= JOINED_CHARS:
                joined.append([c])
                size = JOINED_CHARS
            elif size + len(c) > JOINED_CHARS:
                joined.append([c])
                size = len(c)
            else:
                joined[-1].append(c)
                size += len(c)
        good: list[str] = []
        ids_a, ids_b, ends = [], [], []
        for part in range(0, len(joined), 16):
            todo = joined[part:part + 16]
            texts = ["".join(g) for g in todo]
            for group, text, b in zip(todo, texts, self.of_b(texts)):
                self._checked(group, text, b, good, ids_a, ids_b, ends)
        if not good:
            none = np.zeros(0, np.int64)
            return good, none, none, none, none
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends = np.cumsum(np.concatenate(ends))
        n_a, n_b = (np.diff(np.searchsorted(np.cumsum(size[ids]), ends, "right"), prepend=0)
                    for size, ids in ((self.size_a, a), (self.size_b, b)))
        return good, a, n_a, b, n_b

    def _checked(self, group, text, b, good, ids_a, ids_b, ends) -> None:
        raw = text.encode("utf-8")
        if b"".join(map(self.pieces.__getitem__, b.tolist())) == raw:
            good += group
            ids_a.append(np.array(self.a.encode_to_numpy(text, disallowed_special=()), np.int64))
            ids_b.append(b)
            ends.append(np.array([len(raw)]) if len(group) == 1 else
                        np.fromiter((len(c.encode("utf-8")) for c in group), np.int64, len(group)))
        elif len(group) > 1:
            for c, own in zip(group, self.of_b(group)):
                self._checked([c], c, own, good, ids_a, ids_b, ends)


@lru_cache(maxsize=1)
def encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


@lru_cache(maxsize=1)
def _numbers(size: int) -> pa.Array:
    """Ids below ``size`` as text before ',' then before '|' then before ';'."""
    return pa.array([f"{i}{end}" for end in ",|;" for i in range(size)], pa.large_string())


def last_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the number (in A) of its group's last token
    of A. Both cover the same bytes without gaps; ends rise strictly."""
    n = len(ends_a)
    start_a, start_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
    # The farthest-right token that begins before this one ends.
    of_a = np.searchsorted(start_b, ends_a, "left") - 1
    of_b = np.searchsorted(start_a, ends_b, "left") - 1
    # Common ends: the token of A stays, the token of B points to it.
    successor = np.concatenate([np.where(ends_b[of_a] > ends_a, n + of_a, np.arange(n)), of_b])
    while True:
        farther = successor[successor]
        if np.array_equal(farther, successor):
            return successor[:n], successor[n:]
        successor = farther


def _group_links(groups_a: np.ndarray, groups_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple:
    """(group, code, times): the id pairs of all links, for rising group
    numbers from 0 that both sides have. Pairs of small groups may repeat."""
    n_a, n_b = np.bincount(groups_a), np.bincount(groups_b)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    links = n_a * n_b
    small = np.flatnonzero(links <= LARGE_GROUP)
    group = np.repeat(small, links[small])
    at = np.arange(len(group)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
    a, b = ids_a[first_a[group] + at // n_b[group]], ids_b[first_b[group] + at % n_b[group]]
    out = [(group, a.astype(np.int64) << B_BITS | b, np.ones(len(group), np.int64))]
    for g in np.flatnonzero(links > LARGE_GROUP).tolist():
        a, times_a = np.unique(ids_a[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(ids_b[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
        code = (a.astype(np.int64)[:, None] << B_BITS | b).ravel()
        out.append((np.full(len(code), g), code, np.outer(times_a, times_b).ravel()))
    return tuple(map(np.concatenate, zip(*out)))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sum of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] numbers each, one after another."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


class ChunkTable:
    """Aligned chunks: numbers by chunk; per chunk counts, the groups as text
    and the id pairs of its links."""

    def __init__(self, path_a: str, path_b: str):
        self.paths = path_a, path_b
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.characters = 0
        self.text: list[bytes | None] = []  # None: bytes of B differ
        self.counts = np.zeros((0, 4), np.int64)  # A, B, groups, links
        self.first = np.zeros(0, np.int64)
        self.n_pairs = np.zeros(0, np.int64)
        self.codes = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)

    def trim(self) -> None:
        if self.characters > TABLE_CHARS or len(self.codes) > TABLE_PAIRS:
            self.clear()

    def learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.number]
        if not new:
            return
        use = encoders(*self.paths)
        good, a, n_a, b, n_b = use.both(new)
        bad = set(new).difference(good)
        base = len(self.text)
        self.number.update(zip([*good, *bad], range(base, base + len(new))))
        self.characters += sum(map(len, new))
        counts, n_pairs = np.zeros((len(new), 4), np.int64), np.zeros(len(new), np.int64)
        if good:
            n = len(good)
            label_a, label_b = last_tokens(np.cumsum(use.size_a[a]), np.cumsum(use.size_b[b]))
            lasts = np.flatnonzero(label_a == np.arange(len(label_a)))
            group_a, group_b = np.searchsorted(lasts, label_a), np.searchsorted(lasts, label_b)
            chunk_of_group = np.repeat(np.arange(n), n_a)[lasts]
            group, code, times = _group_links(group_a, group_b, a, b)
            codes, place = np.unique(code, return_inverse=True)
            keys, total = summed(chunk_of_group[group] * len(codes) + place, times)
            links = np.bincount(group_a) * np.bincount(group_b)
            counts[:n] = np.stack([n_a, n_b, np.bincount(chunk_of_group, minlength=n),
                                   np.bincount(chunk_of_group, weights=links, minlength=n).astype(np.int64)], 1)
            n_pairs[:n] = np.bincount(keys // len(codes), minlength=n)
            self.text += _as_text(group_a, group_b, a, b, chunk_of_group, n)
            self.codes = np.concatenate([self.codes, codes[keys % len(codes)]])
            self.times = np.concatenate([self.times, total])
        self.text += [None] * len(bad)
        self.counts = np.concatenate([self.counts, counts])
        self.n_pairs = np.concatenate([self.n_pairs, n_pairs])
        self.first = np.cumsum(self.n_pairs) - self.n_pairs


def _as_text(group_a, group_b, ids_a, ids_b, chunk_of_group, n_chunks: int) -> list[bytes]:
    """'a1,a2|b1;a3|b2,b3' of each chunk."""
    size = 1 + max(int(ids_a.max()), int(ids_b.max()))
    size = 1 << size.bit_length()
    n_a, n_b = np.bincount(group_a), np.bincount(group_b)
    both = n_a + n_b
    start = np.cumsum(both) - both
    rows = np.empty(len(ids_a) + len(ids_b), np.int64)
    at_a = spread(start, n_a)
    at_b = spread(start + n_a, n_b)
    rows[at_a], rows[at_b] = ids_a, ids_b
    rows[start + n_a - 1] += size
    rows[start + both - 1] += 2 * size
    found = _numbers(size).take(pa.array(rows))
    offsets = np.frombuffer(found.buffers()[1], np.int64, len(rows) + 1, found.offset * 8)
    data = memoryview(found.buffers()[2])
    stops = offsets[np.cumsum(np.bincount(chunk_of_group, weights=both, minlength=n_chunks).astype(np.int64))].tolist()
    # Without the ';' after the chunk's last group.
    return [bytes(data[i:j - 1]) for i, j in zip([int(offsets[0]), *stops], stops)]


@lru_cache(maxsize=1)
def chunk_table(path_a: str, path_b: str) -> ChunkTable:
    return ChunkTable(path_a, path_b)


def align_block(texts: list[str], table: ChunkTable) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Per text (n_a, n_b, n_groups, n_links, groups_sha256, pair places,
    times each), the block's pair codes, rising, and how many texts hold each."""
    cut = [chunks_of(t) if t else [] for t in texts]
    table.learn(set().union(*cut))
    number, text = table.number.__getitem__, table.text
    rows, doc, chunk = [], [], []
    for n, chunks in enumerate(cut):
        at = list(map(number, chunks))
        parts = [text[i] for i in at]
        # A's chunks always join to the text, B's only if each does: what B
        # changes (U+2581 to a space) only makes it shorter.
        if not at or None in parts:
            rows.append((0, 0, 0, 0, ""))
            continue
        at = np.array(at)
        rows.append((*table.counts[at].sum(0).tolist(), hashlib.sha256(b";".join(parts)).hexdigest()))
        doc.append(np.full(len(at), n))
        chunk.append(at)
    none = np.zeros(0, np.int64)
    doc, chunk = (np.concatenate(x) if x else none for x in (doc, chunk))
    size = max(1, len(text))
    keys, often = summed(doc * size + chunk, np.ones(len(doc), np.int64))
    doc, chunk = keys // size, keys % size
    at = spread(table.first[chunk], table.n_pairs[chunk])
    codes, place = np.unique(table.codes[at], return_inverse=True)
    size = max(1, len(codes))
    keys, times = summed(np.repeat(doc, table.n_pairs[chunk]) * size + place, table.times[at] * np.repeat(often, table.n_pairs[chunk]))
    doc, place = keys // size, keys % size
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    out = [(*row, place[i:j].astype("<u4").tobytes(), times[i:j].astype("<u4").tobytes())
           for row, i, j in zip(rows, cuts, cuts[1:])]
    table.trim()
    return out, codes, np.bincount(place, minlength=len(codes))


ROW = [("block", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
       ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
       ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())]
ROW_SQL = ("block bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "places binary, times binary, a int, b int, docs bigint")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: (id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256).

    ``path_a`` is a byte-level BPE file, ``path_b`` a sentencepiece model that
    puts a space before the text. Special strings are plain text. Texts that
    are null, empty or whose tokens do not join to space+text have zeros and
    the empty string. An id pair's count is the number of rows that hold it
    linked, so repeated rows count each; a pair is best if no other pair with
    its A id has a higher count. Null ids are kept, other columns ignored; an
    empty table gives no rows.

    Encoded blocks are written to the shared folder once; a block's documents
    and its pairs meet again by the block's number.
    """
    small_arrow_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(path_a, path_b)
        part = TaskContext.get().partitionId()

        def close(number: int, ids: pa.Array, texts: list[str]) -> Iterator[pa.RecordBatch]:
            found, codes, n_docs = align_block(texts, table)
            block = part << 32 | number
            columns = [pa.array(c, t) for c, (_, t) in zip(zip(*[(block, *f) for f in found]), ROW)]
            columns += [pa.nulls(len(found), t) for _, t in ROW[len(columns):]]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["_id", *(c for c, _ in ROW)])
            pairs = {"block": np.full(len(codes), block), "a": codes >> B_BITS, "b": codes & (1 << B_BITS) - 1, "docs": n_docs}
            columns = [pa.array(pairs[c], t) if c in pairs else pa.nulls(len(codes), t) for c, t in ROW]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(codes), ids.type), *columns], names=["_id", *(c for c, _ in ROW)])

        number, ids, texts, size = 0, [], [], 0
        for batch in batches:
            column, first = batch["_id"], 0
            for k, text in enumerate(batch["_text"].to_pylist()):
                if texts and size + len(text) > block_bytes:
                    ids.append(column.slice(first, k - first))
                    yield from close(number, pa.concat_arrays(ids), texts)
                    number, ids, texts, size, first = number + 1, [], [], 0, k
                texts.append(text)
                size += len(text)
            ids.append(column.slice(first))
        if texts:
            yield from close(number, pa.concat_arrays(ids), texts)

    coded = written(rows.mapInArrow(blocks, f"_id {id_type.simpleString()}, {ROW_SQL}"), "alignment-blocks")
    pairs = coded.where("a IS NOT NULL").select(F.col("block").alias("of_block"), "a", "b", "docs")
    by_a = Window.partitionBy("a")
    counts = (pairs.groupBy("a", "b").agg(F.sum("docs").alias("total"))
              .withColumn("best", F.col("total") == F.max("total").over(by_a)))
    counted = pairs.join(counts, ["a", "b"]).select("of_block", "a", "b", "total", "best")
    held = coded.where("a IS NULL").select("block", "_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.lexsort((right["b"].to_numpy(), right["a"].to_numpy()))
        total = right["total"].to_numpy()[order]
        best = right["best"].to_numpy(zero_copy_only=False)[order]
        sums = []
        for places, times in zip(left["places"].to_pylist(), left["times"].to_pylist()):
            at, often = np.frombuffer(places, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
            sums.append((int(often[best[at]].sum()), int((often * total[at]).sum())))
        n_best, count_sum = zip(*sums) if sums else ((), ())
        return pa.table({"_id": left["_id"], **{c: left[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                         "groups_sha256": left["groups_sha256"]})

    return (held.groupBy("block").cogroup(counted.groupBy("of_block"))
            .applyInArrow(meet, f"_id {id_type.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                "n_best bigint, count_sum bigint, groups_sha256 string")
            .withColumnRenamed("_id", id_col))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the two vocabularies over every whole ``documents`` text."""
    return align(read_table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long")),
                 vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


QUERIES = {"op12_token_alignment": op12_token_alignment}
