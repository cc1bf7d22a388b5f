"""Operators on token ids against the tokenizers library."""

from __future__ import annotations

import hashlib
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, packing, token_counts, token_files
from ledgerlens.llm.common import shared_folder
from ledgerlens.llm.shards import file_system
from ledgerlens.llm.tokens import byte_ids, word_ids
from tests.llm.data import LONG, ROWS, VOCABULARY, documents, fuzzed

BYTE, WORDS = (public_tokenizers.path(VOCABULARY[k]) for k in ("byte", "word"))


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORDS)}


def ids_of(library, path: str, text: str | None) -> list[int]:
    return library[path].encode(text or "", add_special_tokens=False).ids


def some_rows() -> list[tuple]:
    return [*ROWS, *((100 + n, t, "en") for n, t in enumerate(fuzzed(500, 4)))]


def test_encoders_match_the_library(library):
    texts = [t or "" for _, t, _ in ROWS] + fuzzed(3000, 1) + ["<|ENDOFTEXT|>. a", "x'S. Y!!, Z_. É́", "ΑΣ. ΑΣ"]
    assert [np.frombuffer(x, "<u4").tolist() for x in word_ids(WORDS).encode([t.encode() for t in texts])] == [
        ids_of(library, WORDS, t) for t in texts]
    assert [byte_ids(BYTE).encode(t).tolist() for t in texts] == [ids_of(library, BYTE, t) for t in texts]


def test_latin_words_match_the_library(library):
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100))]
    texts = [a + b + e for a, b in product(letters, letters[::7]) for e in ("", ".", "?!")]
    assert [np.frombuffer(x, "<u4").tolist() for x in word_ids(WORDS).encode([t.encode() for t in texts])] == [
        c.ids for c in library[WORDS].encode_batch(texts, add_special_tokens=False)]


def test_bpe_round_trip(spark, library):
    rows = some_rows()
    coded = bpe.encode(documents(spark, rows), WORDS, block_bytes=1500, buckets=7)
    got = Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in bpe.decode(coded, WORDS).collect())
    want = Counter()
    for i, t, _ in rows:
        ids = ids_of(library, WORDS, t)
        want[i, np.array(ids, "<u4").tobytes(), library[WORDS].decode(ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.encode(documents(spark, []), WORDS).collect() == []


def test_bpe_equal_blocks(spark, library):
    coded = bpe.encode(documents(spark, [(1, "same words", "en")] * 40 + [(2, " ", "en")] * 5, parts=4), WORDS, block_bytes=30)
    ids = np.array(ids_of(library, WORDS, "same words"), "<u4").tobytes()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in coded.collect()) == {(1, ids): 40, (2, b""): 5}


def test_token_files(spark, library):
    folder = shared_folder(spark, "test-files")
    rows = some_rows()
    manifest = token_files.write_token_files(documents(spark, rows), folder, WORDS, shard_bytes=5000, file_bytes=2000)
    assert manifest.where("kind = 'rec'").count() > 10
    got = token_files.read_token_files(manifest, folder).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    at, want = 0, Counter()
    for i, t, _ in ordered:
        ids = np.array([*ids_of(library, WORDS, t), 1], "<u4")
        want[i, at, len(ids), ids.tobytes()] += 1
        at += len(ids)
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in got) == want
    # Every record is found through the index, and a changed byte is noticed.
    first = manifest.where("kind = 'rec'").orderBy("shard", "part").first()
    read = [token_files.read_record(folder, first["file"], k)[0] for k in range(first["n_records"])]
    assert read == [r[0] for r in ordered[:len(read)]]
    system, root = file_system(folder)
    data = bytearray(open(f"{root}/{first['file']}", "rb").read())
    data[30] ^= 1
    with open(f"{root}/{first['file']}", "wb") as f:
        f.write(data)
    with pytest.raises(ValueError):
        token_files.read_record(folder, first["file"], 0)
    none = token_files.write_token_files(documents(spark, []), shared_folder(spark, "none"), WORDS)
    assert none.count() == 0


def test_token_files_are_deterministic(spark):
    def sums(parts: int) -> list:
        folder = shared_folder(spark, "test-files")
        manifest = token_files.write_token_files(documents(spark, some_rows(), parts), folder, WORDS, shard_bytes=4000, file_bytes=1500)
        _, root = file_system(folder)
        return sorted((r["file"], hashlib.sha1(open(f"{root}/{r['file']}", "rb").read()).hexdigest()) for r in manifest.collect())
    assert sums(2) == sums(5)


@pytest.mark.parametrize("max_len", [16, 2048])
def test_packing(spark, library, monkeypatch, max_len):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 300)
    rows = some_rows()
    pieces = packing.pack(documents(spark, rows), BYTE, max_len=max_len, shard_bytes=6000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for i in {r[0] for r in rows} - {4}:
        (text,) = [r[1] for r in rows if r[0] == i]
        ids, at = np.array([*ids_of(library, BYTE, text), 1], "<u4"), 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    assert sum(p["length"] for p in by_doc[4]) == 2 * (len(ids_of(library, BYTE, LONG)) + 1)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= max_len
    assert packing.pack(documents(spark, []), BYTE).collect() == []


def test_cuts_are_the_cheapest():
    r = np.random.default_rng(1)
    for _ in range(200):
        limit = int(r.integers(3, 12))
        pos = [0, *np.cumsum(r.integers(1, limit + 1, r.integers(1, 9))).tolist()]
        penalty = r.integers(0, 9, len(pos)).tolist()
        cost = {0: 0}
        for j in range(1, len(pos)):
            cost[j] = min(cost[i] + limit - (pos[j] - pos[i]) + penalty[j] for i in range(j) if pos[j] - pos[i] <= limit)
        cuts = packing.choose_cuts(pos, penalty, limit)
        found = sum(limit - (b - a) + penalty[pos.index(b)] for a, b in zip(cuts, cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == pos[-1] and found == cost[len(pos) - 1]


def test_token_counts(spark, library):
    rows = some_rows()
    got = Counter(tuple(r) for r in token_counts.token_counts(documents(spark, rows), BYTE, chunk_chars=37).collect())
    want = Counter()
    for i, t, _ in rows:
        n = len(ids_of(library, BYTE, t))
        want[i, len((t or "").encode()), n, n > 512] += 1
    assert got == want
    assert token_counts.token_counts(documents(spark, []), BYTE).collect() == []


def test_transducer_forgets_and_scans(library, monkeypatch):
    t = token_counts.transducer(BYTE)
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "CACHE_UNITS", 5)
    for text in fuzzed(300, 9):
        n = len(ids_of(library, BYTE, text))
        assert t.count_units(token_counts.UNITS.findall(text)) == n
        for size in (1, 4, 11):
            maps = [t.chunk_map(text[k:k + size]) for k in range(0, len(text), size)]
            if maps:
                scanned = t.scan(maps)
                assert t.total(scanned[-1]) == n
                half = len(scanned) // 2
                assert t.total(scanned[half]) == len(ids_of(library, BYTE, text[:size * (half + 1)]))


def test_decode_nulls(spark):
    df = spark.range(2).select(F.when(F.col("id") == 0, F.lit(None).cast("binary")).otherwise(F.lit(b"")).alias("ids"))
    assert {r["decoded"] for r in bpe.decode(df, WORDS).collect()} == {None, ""}


def test_composing_an_unbroken_text_keeps_no_prefixes(library):
    t = token_counts.transducer(BYTE)
    text = "".join(chr(0x4E00 + n % 500) for n in range(200_000))
    maps = [t.chunk_map(text[k:k + 1000]) for k in range(0, len(text), 1000)]
    tracemalloc.start()
    found = t.reduce(maps)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000  # the prefixes together are 40 MB
    assert t.total(found) == len(ids_of(library, BYTE, text))
    for n in (1, 2, 3, 5):
        cut = "a b" * n
        assert t.total(t.reduce([t.chunk_map(c) for c in [cut, *["x yz "] * n]])) == len(ids_of(library, BYTE, cut + "x yz " * n))
