from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, and its SQL."""

    def put(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return put
