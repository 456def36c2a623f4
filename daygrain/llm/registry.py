"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from daygrain.llm.queries import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
