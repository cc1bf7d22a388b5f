"""Order-preserving packing of documents into token sequences.

The documents of an id range form one token stream. A dynamic program
chooses where to cut it into windows of at most ``max_len`` tokens: the cost
of a window is its padding plus a penalty for where it ends (none at a
document's end, little at a sentence's end, much inside a sentence). With
the window's cost being

    best[j] = penalty[j] + max_len - pos[j] + min(best[i] + pos[i])

over cuts i with pos[j] - pos[i] <= max_len, the minimum is held in a
monotone queue, so the program is linear in the number of possible cuts.
Sequences shorter than ``max_len`` are meant to be padded to it (padding
that a loader may spare at powers of two is counted all the same).
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import id_and_text, read_table
from ledgerlens.llm.shards import range_sorted
from ledgerlens.llm.tokens import byte_ids, vocabulary_path

SENTENCE_PENALTY = 2
INSIDE_PENALTY = 12
#: Inside a long sentence a cut is allowed at each multiple of this.
INSIDE_STEP = 16
#: Tokens in one run of the dynamic program; its last window goes to the next run.
BLOCK_TOKENS = 1 << 18
#: Text bytes of a shard. Each shard ends one sequence early.
SHARD_BYTES = 12 << 20

PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@lru_cache(maxsize=2)
def _sentence_ends(path: str, end_id: int) -> np.ndarray:
    """For each id, whether a sentence may end after it."""
    vocabulary = byte_ids(path).vocabulary
    ends = np.zeros(max(max(vocabulary.values()), end_id) + 1 + 64, bool)
    mark = re.compile(rb"[.!?]+[\"')\]]*\s*$|\n\s*$")
    for piece, i in vocabulary.items():
        ends[i] = bool(mark.search(piece))
    return ends


def choose_cuts(pos: list[int], penalty: list[int], max_len: int) -> list[int]:
    """Positions of the cheapest cuts of a stream: ``pos`` ascends from 0 to
    the stream's end in steps of at most ``max_len``; the first and last are
    always cuts. Ties go to the earlier cut."""
    best, back = [0] * len(pos), [0] * len(pos)
    queue = deque([0])
    low = deque([pos[0]])  # best[i] + pos[i] of the queue's members, ascending
    for j in range(1, len(pos)):
        p = pos[j]
        while pos[queue[0]] < p - max_len:
            queue.popleft()
            low.popleft()
        back[j] = queue[0]
        best[j] = cost = penalty[j] + max_len - p + low[0]
        cost += p
        while low and low[-1] > cost:
            low.pop()
            queue.pop()
        low.append(cost)
        queue.append(j)
    cuts, j = [], len(pos) - 1
    while j > 0:
        cuts.append(pos[j])
        j = back[j]
    return [pos[0], *reversed(cuts)]


def possible_cuts(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray,
                  max_len: int) -> tuple[list[int], list[int]]:
    """(positions, penalties): document ends, sentence ends, and steps inside
    longer gaps."""
    step = min(INSIDE_STEP, max_len)
    at_sentence = np.flatnonzero(sentence_end[np.minimum(ids, len(sentence_end) - 1)]) + 1
    known = np.unique(np.concatenate([[0], at_sentence, doc_ends, [len(ids)]]))
    gaps = np.diff(known)
    wide = np.flatnonzero(gaps > step)
    inside = [np.arange(known[w] + step, known[w + 1], step) for w in wide]
    pos = np.unique(np.concatenate([known, *inside])) if inside else known
    penalty = np.full(len(pos), INSIDE_PENALTY)
    penalty[np.searchsorted(pos, at_sentence)] = SENTENCE_PENALTY
    penalty[np.searchsorted(pos, doc_ends)] = 0
    return pos.tolist(), penalty.tolist()


class _Packer:
    """Packs one shard's stream of segments (id, start, tokens of the
    document, ids) into windows and their pieces."""

    def __init__(self, shard: int, max_len: int, sentence_end: np.ndarray):
        self.next, self.max_len, self.sentence_end = shard << 32, max_len, sentence_end
        self.held, self.size = [], 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        self.held.append((doc_id, 0, len(ids), ids))
        self.size += len(ids)
        return self.run(False) if self.size >= BLOCK_TOKENS else []

    def run(self, last: bool) -> list[tuple]:
        if not self.held:
            return []
        ids = np.concatenate([s[3] for s in self.held])
        ends = np.cumsum([len(s[3]) for s in self.held])
        closed = ends[[s[1] + len(s[3]) == s[2] for s in self.held]]
        cuts = choose_cuts(*possible_cuts(ids, closed, self.sentence_end, self.max_len), self.max_len)
        if not last and len(cuts) > 2:
            cuts.pop()
        pieces, at, k = [], 0, 0
        for a, b in zip(cuts, cuts[1:]):
            while at < b:
                doc_id, start, total, own = self.held[k]
                first = int(ends[k]) - len(own)
                stop = min(b, int(ends[k]))
                part = own[at - first:stop - first]
                pieces.append((doc_id, start + at - first, len(part), zlib.crc32(part.astype("<u4").tobytes()),
                               total, self.next, at - a))
                at = stop
                k += stop == ends[k]
            self.next += 1
        rest = []
        for i in range(k, len(self.held)):
            doc_id, start, total, own = self.held[i]
            skip = max(0, at - (int(ends[i]) - len(own)))
            rest.append((doc_id, start + skip, total, own[skip:]))
        self.held, self.size = rest, len(ids) - at
        return pieces


def pack(docs: DataFrame, vocabulary: str, max_len: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents follow one another in id order (null ids first, repeated ids
    by text); each is its ids and ``end_id``, so a null or empty text is one
    token. Every id lies in exactly one piece; offsets in a sequence have no
    gap. sequence_id is the shard times 2**32 plus a running number. An empty
    table gives no rows; other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col).select(
        "_id", "_text", (F.octet_length("_text") + 16).alias("_weight"))
    placed = range_sorted(rows, "_id", "_weight", shard_bytes, ["_id", "_text"]).select("_shard", "_id", "_text")
    id_type = placed.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ends = byte_ids(vocabulary), _sentence_ends(vocabulary, end_id)
        packer, shard = None, None
        for batch in batches:
            schema = pa.schema([("_id", batch.schema.field("_id").type)]
                               + [(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
            found = []
            for number, doc_id, text in zip(*(batch[c].to_pylist() for c in ("_shard", "_id", "_text"))):
                if number != shard:
                    if packer is not None:
                        found += packer.run(True)
                    packer, shard = _Packer(number, max_len, ends), number
                found += packer.add(doc_id, np.append(encoder.encode(text), np.uint32(end_id)))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
        if packer is not None and (found := packer.run(True)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return placed.mapInArrow(run, f"_id {id_type}, {PIECES}").withColumnRenamed("_id", id_col)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all whole ``documents`` in sequences of up to 2048 tokens."""
    return pack(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


QUERIES = {"op2_packing": op2_packing}
