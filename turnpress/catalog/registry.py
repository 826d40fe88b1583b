"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``check`` is the SQL for the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check.strip()
        return fn

    return register
