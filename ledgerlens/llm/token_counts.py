"""Token counts by a compiled finite-state tokenizer.

Byte-level BPE is run as a deterministic transducer over bytes whose
transitions carry the change of the token count. It rests on a property of
such vocabularies (every token encodes to itself, checked when compiling): a
sequence of tokens is the encoding of its bytes exactly when each adjacent
pair encodes to itself, so the last token of a prefix is the one suffix that
is compatible with the last token before it. A state therefore holds the
longest suffix that a token can start with, and for each position in it the
last token and the relative count. States are determinised on first use and
the table is emptied when it grows past a bound.

A position between a non-space and a white-space character always separates
the pre-tokenizer's pieces, whatever stands before. A chunk's state map is thus
(head, count, tail): the text before its first such position, which needs the
state it is entered with, the tokens of what is closed inside, and the text
after the last one, which is the state it is left with. The maps compose
associatively; long texts are cut into chunks that different tasks count, and
the maps of one text are combined pairwise in one task. A chunk without white
space is its own map, so a text without any meets whole in that task.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.common import id_and_text, read_table, small_arrow_batches
from ledgerlens.llm.tokens import BYTE_LEVEL_PATTERN, byte_letters, vocabulary_path

#: White space as the pre-tokenizer's pattern has it (Unicode White_Space).
WHITE = r"\t-\r \x85\xa0  -     　"
UNITS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Unit counts kept before they are forgotten.
CACHE_UNITS = 300_000
#: States kept before the table is built anew.
MAX_STATES = 200_000
#: Code points of a chunk.
CHUNK_CHARS = 1 << 16


class Transducer:
    """Byte-level BPE vocabulary -> lazily determinised counting transducer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel"
                or not pre.get("use_regex") or pre.get("add_prefix_space")):
            raise ValueError("not a plain byte-level BPE file")

        def raw(piece: str) -> bytes:
            return bytes(letters[c] for c in piece)

        self.tokens = {raw(p): i for p, i in model["vocab"].items() if all(c in letters for c in p)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {}
        for n, (a, b) in enumerate(merges):
            self.rank.setdefault((raw(a), raw(b)), n)
        self.starts = {t[:n] for t in self.tokens for n in range(len(t))}
        for token in self.tokens:
            if self.merge(token) != [token]:
                raise ValueError(f"token {token!r} does not encode to itself")
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.pieces = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.fits: dict = {}
        self.known: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.states: dict = {}
        self.start = self.state(b"", (None,), (0,))

    def merge(self, data: bytes) -> list[bytes]:
        """Tokens of a byte string by its merge ranks, lowest first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def compatible(self, a: bytes | None, b: bytes) -> bool:
        if a is None:
            return True
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) > 4 * MAX_STATES:
                self.fits.clear()
            found = self.fits[a, b] = self.merge(a + b) == [a, b]
        return found

    def state(self, suffix: bytes, last: tuple, counts: tuple) -> dict:
        """A state is its own transition table; its meaning lies under -1."""
        key = (suffix, last, counts)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = {-1: key}
        return found

    def grow(self, state: dict, byte: int) -> tuple[dict, int]:
        """Determinise one transition: (next state, change of the count)."""
        suffix, last, counts = state[-1]
        text = suffix + bytes([byte])
        for at in range(len(text)):
            token = text[at:]
            if token in self.tokens and self.compatible(last[at], token):
                break
        else:
            raise ValueError(f"byte {byte} is not in the vocabulary")
        change = counts[at] + 1
        # A later token can only start where the rest is the start of a token;
        # what is known of other positions is dropped, so more states are one.
        starts, kept = self.starts, None
        then, relative = [], []
        for k in range(len(text)):
            if text[k:] in starts:
                kept = k if kept is None else kept
                then.append(last[k])
                relative.append(counts[k] - change)
            elif kept is not None:
                then.append(None)
                relative.append(0)
        then.append(token)
        relative.append(0)
        suffix = b"" if kept is None else text[kept:]
        edge = state[byte] = (self.state(suffix, tuple(then), tuple(relative)), change)
        return edge

    def count_piece(self, piece: bytes) -> int:
        state, total = self.start, 0
        for byte in piece:
            state, change = state.get(byte) or self.grow(state, byte)
            total += change
        if len(self.states) > MAX_STATES:
            self.forget()
        return total

    def count_unit(self, unit: str) -> int:
        """Tokens of a text between two certain boundaries."""
        if self.special and self.special.search(unit):
            plain = [p for p in self.special.split(unit) if p]
            return len(self.special.findall(unit)) + sum(map(self.count_unit, plain))
        return sum(self.count_piece(p.encode("utf-8")) for p in self.pieces(unit))

    def count_units(self, units: list[str]) -> int:
        known = self.known
        for unit in set(units):
            if unit not in known:
                known[unit] = self.count_unit(unit)
        total = sum(map(known.__getitem__, units))
        if len(known) > CACHE_UNITS:
            known.clear()
        return total

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, count, tail); tail is None when no boundary lies inside."""
        units = UNITS.findall(chunk)
        if len(units) < 2:
            return chunk, 0, None
        return units[0], self.count_units(units[1:-1]), units[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The state map of two neighbouring chunks."""
        if a[2] is None:
            if b[2] is None:
                return self.chunk_map(a[0] + b[0])
            inner = self.chunk_map(a[0] + b[0])
            if inner[2] is None:
                return inner[0], b[1], b[2]
            return inner[0], inner[1] + self.count_units([inner[2]]) + b[1], b[2]
        middle = self.chunk_map(a[2] + b[0])
        if b[2] is None:
            if middle[2] is None:
                return a[0], a[1], middle[0]
            return a[0], a[1] + self.count_units([middle[0]]) + middle[1], middle[2]
        return a[0], a[1] + self.count_units(UNITS.findall(a[2] + b[0])) + b[1], b[2]

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Inclusive prefix scan: entry i is the map of chunks 0 to i. In each
        of the log2(n) rounds all compositions are independent."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(maps[i - step], maps[i]) for i in range(step, len(maps))]
            step *= 2
        return maps

    def reduce(self, maps: list[tuple]) -> tuple:
        """The map of all chunks, neighbours composed pairwise; no prefix is
        kept, so the texts held stay about as long as the chunks together."""
        while len(maps) > 1:
            pairs = [self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[2 * len(pairs):]
        return maps[0]

    def total(self, found: tuple) -> int:
        """Tokens of a whole text, given its map."""
        head, count, tail = found
        return count + self.count_units(UNITS.findall(head)) + self.count_units([tail] if tail else [])


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per input row: (id, n_bytes, n_tokens, over_limit).

    A null or empty text has no bytes and no tokens. Special strings inside a
    text count as their special token. Texts longer than ``chunk_chars`` are
    counted in chunks by several tasks. Repeated rows are all returned; an
    empty table gives no rows; other columns are ignored.
    """
    small_arrow_batches(docs.sparkSession)

    @pandas_udf("long")
    def whole(texts: pd.Series) -> pd.Series:
        t = transducer(vocabulary)
        return pd.Series([t.count_units(UNITS.findall(x)) for x in texts], dtype="int64")

    @pandas_udf("head string, count long, tail string")
    def parts(chunks: pd.Series) -> pd.DataFrame:
        t = transducer(vocabulary)
        return pd.DataFrame([t.chunk_map(x) for x in chunks], columns=["head", "count", "tail"])

    rows = id_and_text(docs, id_col, text_col)
    short = rows.where(F.length("_text") <= chunk_chars).select(
        "_id", F.octet_length("_text").cast("long").alias("n_bytes"), whole("_text").alias("n_tokens"))
    # Chunks of equal (id, text) rows have equal maps: one of each is composed.
    cut = rows.where(F.length("_text") > chunk_chars).select(
        "_id", F.md5("_text").alias("_hash"), F.octet_length("_text").cast("long").alias("n_bytes"),
        F.expr(f"posexplode(transform(sequence(0, (length(_text) - 1) div {chunk_chars}), "
               f"i -> substring(_text, cast(i * {chunk_chars} + 1 AS int), {chunk_chars})))").alias("_no", "_chunk"))
    mapped = (cut.groupBy("_id", "_hash", "n_bytes", "_no")
              .agg(F.first("_chunk").alias("_chunk"), F.count(F.lit(1)).alias("_copies"))
              .withColumn("_map", parts("_chunk"))
              .select("_id", "_hash", "n_bytes", "_no", "_copies", "_map.head", "_map.count", "_map.tail"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def composed(found: pd.DataFrame) -> pd.DataFrame:
        t = transducer(vocabulary)
        found = found.sort_values("_no")
        maps = [(h, int(c), None if x is None or x != x else x)
                for h, c, x in zip(found["head"], found["count"], found["tail"])]
        first = found.iloc[[0]]
        return first[["_id", "n_bytes", "_copies"]].assign(n_tokens=t.total(t.reduce(maps)))

    long = (mapped.groupBy("_id", "_hash", "n_bytes")
            .applyInPandas(composed, f"_id {id_type}, n_bytes long, _copies long, n_tokens long")
            .select("_id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("col"))
    return short.unionByName(long).select(
        F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text of ``documents``."""
    return token_counts(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


QUERIES = {"op10_token_counts": op10_token_counts}
