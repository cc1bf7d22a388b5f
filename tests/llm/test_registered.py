"""The registered queries on the smallest tables, and the pipeline against a
brute-force version."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlens.llm import quality, registry, secrets
from tests.llm.test_text_operators import WORD, closed, fingerprint, measured
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, name, registry.queries()[name], registry.oracle_sql()[name], duck(SF))
    assert res["cols_match"] and res["match"], res


COLUMNS = {
    "op1_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op3_html_extract": ["page_id", "url", "text", "n_chars"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_secret_scans": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_its_table(spark, name):
    got = registry.queries()[name](spark, SF)
    assert got.columns == COLUMNS[name]
    table = "pages" if "page_id" in got.columns else "documents"
    key = got.columns[0]
    want = spark.read.parquet(f"{SF}/{table}.parquet")
    assert {r[0] for r in got.select(key).collect()} == {r[0] for r in want.select(key).collect()}
    if name != "op2_packing":
        assert got.count() == want.count()


def test_vector_queries_cover_their_table(spark):
    ids = {r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id").collect()}
    white = registry.queries()["op11_embedding_whitening"](spark, SF)
    assert white.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(white.dtypes)["deviation"] == "bigint"
    assert sorted((r[0], r[1]) for r in white.collect()) == sorted((i, k) for i in ids for k in range(1, 5))
    top = registry.queries()["op13_topk_search"](spark, SF)
    assert top.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((r[0], r[1]) for r in top.collect()) == sorted((i, k) for i in ids if i % 50 == 0 for k in range(1, 6))


def passes(text: str) -> bool:
    m = measured(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    m["n_stop_words"] = sum(w.lower() in quality.STOP_WORDS for w in WORD.findall(text))
    m["n_short_lines"] = sum(len(x) < quality.SHORT_LINE for x in lines)
    if m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]:
        return False
    return all((low is None or m[a] >= low * m[b]) and (high is None or m[a] <= high * m[b])
               for _, a, b, low, high in quality.RULES)


def masked(text: str) -> str:
    covered, out, at = secrets.find(text), [], 0
    for _, _, start, stop in covered:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.where("n_chars > 2000").limit(1).first()["text"]
    extra = [(9001, base, "en", "x", len(base)), (9002, base + " end", "en", "x", 0), (9003, None, "en", "x", 0),
             (9004, base + "\npassword = hunter2hunter2", "en", "x", 0), (9005, "", "en", "x", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    text = {i: t for i, t in text.items() if passes(t)}
    largest = {}
    for i, t in text.items():
        largest[t] = max(largest.get(t, i), i)
    text = {i: t for t, i in largest.items()}
    low = closed({i: fingerprint(t) for i, t in text.items()})
    text = {i: masked(t) for i, t in text.items() if low[i] == i}

    pieces = defaultdict(list)
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[p["doc_id"]].append(p)
    assert set(pieces) == set(text)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t in text.items():
        ids, at = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    assert len({re.sub(r"\W", "", n) for n, _ in corpus_pipeline.STAGES}) == 5
