"""The query catalogue: each module registers queries with the SQL they must agree with."""

from __future__ import annotations

from driftwell.queries import (  # noqa: F401
    aggregates,
    audit,
    joins,
    reports,
    scalars,
    sets_and_samples,
    sources_and_sinks,
    window_functions,
)
from driftwell.queries.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
