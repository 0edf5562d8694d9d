"""Relational operators that Spark has no single call for."""

from convoy.operators.asof import asof_join
from convoy.operators.latest import latest_by
from convoy.operators.previous import with_previous

__all__ = ["asof_join", "latest_by", "with_previous"]
