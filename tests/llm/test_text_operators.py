"""Operators on texts: dedup, quality, SimHash, secrets."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import exact_dedup, quality, secrets, simhash
from ledgerlens.llm.common import shared_folder
from tests.llm.data import LONG, ROWS, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_exact_groups(spark):
    got = Counter(tuple(r) for r in exact_dedup.exact_groups(documents(spark), keep="max").collect())
    want = Counter()
    for i, t, _ in ROWS:
        same = [j for j, u, _ in ROWS if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        want[i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    assert exact_dedup.exact_groups(documents(spark, [])).collect() == []


def test_exact_keep_one(spark):
    docs = documents(spark)
    kept = exact_dedup.keep_one(docs, keep="max")
    assert kept.columns == docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, _ in ROWS})
    assert {r["doc_id"] for r in kept.collect()} == {None, 1, 3, 4, 5, 6, 7, 8, 9} - {1}


def measured(text: str) -> dict:
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def test_quality_measures_and_verdict(spark):
    good = " ".join(f"the word{n} of house{n}" for n in range(40))
    rows = [*ROWS, (20, good, "en"), (21, "# " * 90 + good, "en"), (22, "a b c " * 60, "en"), (23, "x\ny\nx\n \nx", "en")]
    got = {r["doc_id"]: r for r in quality.quality_rules(documents(spark, rows)).collect()}
    for i, t, _ in rows:
        for k, v in measured(t or "").items():
            assert got[i][k] == v, (i, k)
        m = measured(t or "")
        assert got[i]["base_failed"] == (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"])
    assert got[20]["kept"] and not got[21]["kept"] and not got[22]["kept"] and not got[2]["kept"]
    docs = documents(spark, rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {20}
    assert quality.quality_rules(documents(spark, [])).filter("kept").collect() == []


def fingerprint(text: str) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(fps: dict) -> dict:
    """Smallest key reachable over links of at most two bits."""
    low = dict.fromkeys(fps)
    for start in sorted(fps):
        if low[start] is None:
            todo, low[start] = [start], start
            while todo:
                a = todo.pop()
                for b in fps:
                    if low[b] is None and (fps[a] ^ fps[b]).bit_count() <= 2:
                        low[b] = start
                        todo.append(b)
    return low


def test_simhash_whole(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter(
        (i, f"{fingerprint(t or ''):016x}") for i, t, _ in ROWS)
    low = closed({i: fingerprint(t or "") for i, t, _ in ROWS if i is not None})
    assert all(r["component_id"] == low[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == set(low.values())


def test_simhash_keep_one_of_null_and_repeated_ids(spark):
    one, two, three, four = (" ".join(f"{name}{n}" for n in range(40)) for name in ("river", "stone", "cloud", "ember"))
    rows = [(None, one, "en"), (None, one, "en"), (None, one.upper(), "en"),  # no id at all
            (None, two, "en"), (5, two, "en"), (5, two, "en"), (7, two.upper(), "en"),
            (5, three, "en"), (3, three.upper(), "en"), (3, three.replace(" ", "  "), "en"),  # 5 stays only above
            (None, four, "en"), (None, four, "de"), (9, "", "en"), (None, None, "en")]
    docs = documents(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], " ".join((r["text"] or "").lower().split())) for r in kept.collect()]
    assert Counter(got) == Counter([(None, one), (5, two), (3, three), (None, four), (9, "")])
    again = simhash.keep_one(documents(spark, rows[::-1], 5))
    assert {(r["doc_id"], r["text"]) for r in again.collect()} == {(r["doc_id"], r["text"]) for r in kept.collect()}
    assert simhash.keep_one(documents(spark, [])).collect() == []


@pytest.mark.parametrize("busy", [1000, 3])
def test_links_and_components(spark, monkeypatch, busy):
    monkeypatch.setattr(simhash, "BUSY_KEY", busy)
    r = random.Random(5)
    values = [0, (1 << 64) - 1]
    for _ in range(60):  # chains of one or two flips, and lone values
        v = r.getrandbits(64)
        for _ in range(r.randint(1, 6)):
            values.append(v)
            v ^= 1 << r.randrange(64) | (1 << r.randrange(64) if r.random() < 0.5 else 0)
    values = sorted(set(values))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "_fp long"))
    got = {tuple(sorted(x)) for x in links.collect()}
    assert len(got) == links.count()
    assert got == {tuple(sorted((a, b))) for a, u in zip(signed, values) for b, v in zip(signed, values)
                   if a < b and (u ^ v).bit_count() <= 2}
    roots = {x["node"]: x["root"] for x in simhash.components(links).collect()}
    low = closed(dict(zip(signed, values)))
    assert roots == {k: v for k, v in low.items() if list(low.values()).count(v) > 1}


def test_golay_keys_meet():
    r = np.random.default_rng(3)
    a = r.integers(0, 2 ** 63, 4000, dtype=np.uint64)
    flips = [(np.uint64(1) << r.integers(0, 64, 4000).astype(np.uint64)) for _ in range(2)]
    for b in (a, a ^ flips[0], a ^ flips[0] ^ flips[1]):
        assert all(set(x) & set(y) for x, y in zip(simhash.keys_of(a), simhash.keys_of(b)))


def base_spans(text: str) -> list[tuple]:
    word = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    kinds = [("assign", rf"""(?:{word}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
             ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]
    found = [(m.start(), n, m.end(), k) for n, (k, p, g, least) in enumerate(kinds)
             for m in re.finditer(p, text) if len(m[g]) >= least]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def test_secrets_spans_and_ledger(spark, monkeypatch):
    r = random.Random(2)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ": ", " ", "'", "abcd", "12345678", "AKIA", "ABCDEFGH1234",
             "deadbeef" * 4, "0123", "é", "\n", "ſecret=12345678", "passwd:", "xoxb-1234567890ab"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(400)]
    docs = documents(spark, [*ROWS, *((100 + n, t, "en") for n, t in enumerate(texts))])
    folder = shared_folder(spark, "test-ledger")
    text = {i: t or "" for i, t, _ in ROWS} | {100 + n: t for n, t in enumerate(texts)}
    some = secrets.scan(docs.where("doc_id < 300"), folder).collect()
    whole = secrets.scan(docs, folder).collect()
    assert len(whole) == docs.count()
    for row in [*some, *whole]:
        spans = [(s["kind"], s["start"], s["stop"]) for s in row["spans"]]
        assert [s for s in spans if s[0] in secrets.BASE_KINDS] == base_spans(text[row["doc_id"]])
    stored = spark.read.schema(secrets.LEDGER).parquet(folder + "/*")
    assert stored.count() == stored.select("blob").distinct().count() == len(set(text.values()))
    # A new rule version scans every blob again, by that rule only.
    newer = [secrets.Rule("hex", 2, "[0-9a-f]{40,}") if x.kind == "hex" else x for x in secrets.RULES]
    again = secrets.scan(docs, folder, rules=newer).collect()
    assert {x for row in spark.read.schema(secrets.LEDGER).parquet(folder + "/*").where("array_contains(rules, 'hex@2')")
            .collect() for x in row["rules"]} == {"hex@2"}
    assert all(s["stop"] - s["start"] >= 40 for row in again for s in row["spans"] if s["kind"] == "hex")
    assert secrets.scan(documents(spark, []), shared_folder(spark, "none")).collect() == []


def test_redact(spark):
    docs = documents(spark).withColumn("n_chars", F.length("text"))
    out = secrets.redact(docs, shared_folder(spark, "test-ledger"))
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[8]["text"] == '[SECRET]" [SECRET] [SECRET]' and rows[8]["n_chars"] == 27
    same = Counter((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] != 8)
    assert same == Counter((i, t) for i, t, _ in ROWS if i != 8)
    assert rows[4]["text"] == LONG


def pem(r: random.Random, size: int = 1200) -> list[str]:
    body = base64.b64encode(r.randbytes(size)).decode()
    return [body[k:k + 64] for k in range(0, len(body), 64)]


def test_private_keys_are_covered_whole(spark):
    r = random.Random(9)
    begin, end, name = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n"
    texts, bodies = [], []
    for break_ in ("\n", "\r\n", "\\n", " ", "\n> ", '\\n" +\n    "', "\n\t"):
        for head in ("", name.replace("\n", break_) + break_):
            for tail in (end, "", "-----END RSA PRI", "-----END CERTIFICATE-----"):
                bodies.append(pem(r, r.choice([1191, 1192, 1193, 607, 40])))
                texts.append("before it " + begin + break_ + head + break_.join(bodies[-1]) + break_ + tail
                             + ("\nafter it all, more." if tail == end else ""))
    bodies.append(["MIIEpA"])
    texts.append(begin + "\nMIIEpA\n")
    bodies.append([])
    texts.append(f"A file with {begin} in its first line, no key")
    docs = documents(spark, [(n, t, "en") for n, t in enumerate(texts)])
    out = {x["doc_id"]: x["text"] for x in secrets.redact(docs, shared_folder(spark, "test-ledger")).collect()}
    for n, (text, lines) in enumerate(zip(texts, bodies)):
        assert "BEGIN" not in out[n] and not [x for x in lines if x in out[n]], (text, out[n])
        assert not text.startswith("before") or out[n].startswith("before it [SECRET]"), out[n]
        assert "after it" not in text or out[n] == "before it [SECRET]\nafter it all, more."
    assert out[len(texts) - 1] == "A file with [SECRET] in its first line, no key"
    twice = f"{begin}\n{bodies[0][0]}\n{end} and {begin}\n{bodies[1][0]}\n{end}."
    assert [s[0] for s in secrets.find(twice)] == ["key", "key"]
    assert "key@2" in {x.key for x in secrets.RULES}


def test_searches_match_their_patterns():
    rules = {r.kind: r for r in secrets.RULES if r.search}
    assert set(rules) == {"jwt", "login"}
    r = random.Random(5)
    pieces = ["eyJ", "eyJabcdefgh", ".", "a", "://", "x:y@", "-", "_", "B9", " ", "9", "+", "https", "u:p@", "é", "ABCDEFGHIJ", "/", ":", "@"]
    for _ in range(20_000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 14)))
        for rule in rules.values():
            assert rule.search(text) == [m.span() for m in rule.pattern.finditer(text)], text


@pytest.mark.parametrize("unit", ["a", "eyJ", "eyJabcdefghi.", "://", "a://b:", "ab://c:d@", "secret", "token   ", "AKIA", "0", "-----BEGIN PRIVATE KEY-----"])
def test_long_texts_take_linear_time(unit):
    text = unit * (1_000_000 // len(unit)) + "://"
    began = time.process_time()
    secrets.find(text)
    assert time.process_time() - began < 10


def test_scans_at_once_count_once(spark):
    folder = shared_folder(spark, "ledger")
    docs = documents(spark, [(1, 'password = "abcdefgh1234"', "en")])
    first = secrets.scan(docs, folder).select("doc_id", "spans").collect()
    # Another scan had seen the same pairs as unseen and appends them too.
    import os
    held = folder.removeprefix("file:")
    batch = os.listdir(held)[0]
    spark.read.parquet(f"{folder}/{batch}").write.parquet(f"{folder}/batch-again")
    assert secrets.scan(docs, folder).select("doc_id", "spans").collect() == first
    assert secrets.read_ledger(spark, folder).where("size(spans) > 0").select(F.size("spans")).first()[0] == 1
