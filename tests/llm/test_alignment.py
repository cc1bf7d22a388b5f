"""Token alignment against a two-pointer merge over the libraries' ids."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlens.llm import alignment
from ledgerlens.llm.tokens import byte_letters
from tests.llm.data import ROWS, documents, fuzzed

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["▁x y", "a  b   c ", "   ", " ", "\n \n x", "a \t b\x1c c\x85 d\xa0 e", "<s> </s> <unk> <0x41>", "﻿a", "\x00 b",
       "日本語 テキスト" * 50, "ab" * 30_000, "<|endoftext|> x", "é́ 😀😀 ﬁ", "'s 're don't", "x" + " " * 5000 + "y", "　 z  q"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = byte_letters()
    return (a, {i: bytes(letters[c] for c in p) for p, i in a.get_vocab().items() if all(c in letters for c in p)},
            sentencepiece.SentencePieceProcessor(model_file=B))


def brute(rows, libraries) -> Counter:
    a, bytes_a, b = libraries

    def piece(i: int) -> bytes:
        name = b.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    found, holders = [], Counter()
    for i, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b, groups = b.encode(text) if text else [], []
        whole = (" " + (text or "")).encode()
        if text and b"".join(map(piece, ids_b)) == whole == b"".join(bytes_a[x] for x in ids_a):
            end_a = end_b = k = 0
            left, right = [], []
            for x in ids_a:
                left.append(x)
                end_a += len(bytes_a[x])
                while end_b < end_a:
                    right.append(ids_b[k])
                    end_b += len(piece(ids_b[k]))
                    k += 1
                if end_a == end_b:
                    groups.append((left, right))
                    left, right = [], []
        found.append((i, groups))
        holders.update({(x, y) for g, h in groups for x in g for y in h})
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = Counter()
    for i, groups in found:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out[i, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
            sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""] += 1
    return out


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_alignment(spark, libraries, block_bytes):
    rows = [*ROWS, *((200 + n, t, "en") for n, t in enumerate(ODD)), *((300 + n, t, "en") for n, t in enumerate(fuzzed(300, 8)))]
    got = alignment.align(documents(spark, rows), A, B, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == brute([r[:2] for r in rows], libraries)


def test_nothing_to_align(spark):
    assert alignment.align(documents(spark, []), A, B).collect() == []
    got = alignment.align(documents(spark, [(1, None, "en"), (2, "", "en")]), A, B).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_forgetting_chunks_changes_nothing(monkeypatch):
    texts = [t for _, t, _ in ROWS] + fuzzed(200, 5)
    kept = alignment.align_block(texts, alignment.ChunkTable(A, B))
    monkeypatch.setattr(alignment, "TABLE_CHARS", 10)
    table = alignment.ChunkTable(A, B)
    for part in (texts[:50], texts[:3], texts):
        found = alignment.align_block(part, table)
        assert not table.number
    assert found[0] == kept[0] and all(np.array_equal(x, y) for x, y in zip(found[1:], kept[1:]))


def test_pointer_jumping():
    r = random.Random(1)
    for n in (1, 2, 50, 3000):
        common = sorted(r.sample(range(1, 8 * n), max(1, n // 40)))
        length = common[-1]
        a, b = (np.array(sorted({*common, *r.sample(range(1, length + 1), min(n, length))})) for _ in range(2))
        label_a, label_b = alignment.last_tokens(a, b)
        both = np.intersect1d(a, b)
        assert a[label_a].tolist() == [int(both[np.searchsorted(both, e)]) for e in a]
        assert a[label_b].tolist() == [int(both[np.searchsorted(both, e)]) for e in b]
    # A chain that alternates to the end: one group, whatever its length.
    n = 100_001
    a, b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert {*alignment.last_tokens(a, b)[0].tolist()} == {n - 1}


def test_large_groups(monkeypatch):
    group_a, group_b = np.array([0, 0, 0, 1, 1]), np.array([0, 0, 1, 1, 1])
    ids_a, ids_b = np.array([5, 5, 6, 7, 8]), np.array([1, 1, 2, 3, 3])

    def links() -> Counter:
        out: Counter = Counter()
        for g, c, t in zip(*alignment._group_links(group_a, group_b, ids_a, ids_b)):
            out[int(g), int(c)] += int(t)
        return out

    plain = links()
    monkeypatch.setattr(alignment, "LARGE_GROUP", 2)
    assert links() == plain and sum(plain.values()) == 12
