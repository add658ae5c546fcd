"""All registered queries."""

from __future__ import annotations

from tidewatch.plans import checks, retention, returns, service, streams  # noqa: F401
from tidewatch.plans.registry import QUERIES, SQL, full_sql, runner

__all__ = ["QUERIES", "SQL", "full_sql", "runner"]
