"""All registered queries."""

from __future__ import annotations

from checks import (  # noqa: F401  (modules register their queries when imported)
    cleaning, evaluation, features, sources, statistics, training, windows,
)
from checks.common import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
