"""The queries of the engine and their SQL counterparts."""

from __future__ import annotations

from millrace.plans import analytics, features, modelling, preparation, storage
from millrace.plans.registry import Query

MODULES = (preparation, features, analytics, modelling, storage)


def queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.R.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in m.R.oracles.items()}
