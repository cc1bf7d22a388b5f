"""All registered queries and their SQL oracles, collected from the plans."""

from __future__ import annotations

import importlib

_MODULES = [
    "ledgerlens.plans.listings",
    "ledgerlens.plans.transactions",
    "ledgerlens.plans.settlement",
    "ledgerlens.plans.scalars",
    "ledgerlens.plans.reports",
    "ledgerlens.plans.catalogue",
    "ledgerlens.plans.health",
    "ledgerlens.plans.metrics",
    "ledgerlens.plans.publish",
    "ledgerlens.plans.streams",
]


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        out.update(getattr(mod, attr, {}))
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return {k: v.strip() for k, v in _collect("ORACLE").items()}
