"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import importlib

MODULES = ["bpe", "media", "substring", "tokenfiles", "html", "topk", "simhash", "lm", "packing", "quality"]


def _all(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(importlib.import_module(f"fathomleaf.llm.{m}"), name)
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("ORACLE_SQL")
