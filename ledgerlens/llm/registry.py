"""Queries and SQL oracles of the training-data operators."""

from __future__ import annotations

import importlib

_MODULES = [
    # in the order of their numbers
    "ledgerlens.llm.warc",
    "ledgerlens.llm.packing",
    "ledgerlens.llm.html_extract",
    "ledgerlens.llm.simhash",
    "ledgerlens.llm.quality",
    "ledgerlens.llm.secrets",
    "ledgerlens.llm.exact_dedup",
    "ledgerlens.llm.token_files",
    "ledgerlens.llm.bpe",
    "ledgerlens.llm.token_counts",
    "ledgerlens.llm.whitening",
    "ledgerlens.llm.alignment",
    "ledgerlens.llm.topk_search",
    "corpus_pipeline",
]


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(getattr(importlib.import_module(m), attr, {}))
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return {k: v.strip() for k, v in _collect("ORACLE").items() if v}
