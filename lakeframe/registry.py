"""All registered queries and their SQL oracles, collected from the plan modules."""

from __future__ import annotations

import importlib

PLAN_MODULES = ("lakeframe.plans.media", "lakeframe.plans.streams", "lakeframe.plans.catalog",
                "lakeframe.plans.objects")


def _collect(attr: str) -> dict:
    out: dict = {}
    for name in PLAN_MODULES:
        mod = importlib.import_module(name)
        for k, v in getattr(mod, attr, {}).items():
            if k in out:
                raise ValueError(f"query {k} registered twice")
            out[k] = v
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return {k: v.strip() for k, v in _collect("ORACLES").items()}
