"""Where the check queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.frames import with_frames

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` may use ``{frame}`` names."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_frames(sql)
        return run

    return register


def intervals_sql(source: str, keys: list[str], gap_days: int, date: str = "d") -> str:
    """Start-end runs of the dates in ``source``, per key columns."""
    k = ", ".join(keys)
    return f"""
        SELECT {k}, min({date}) AS dt_s, max({date}) AS dt_e FROM (
          SELECT *, sum(CASE WHEN {date} - prev <= {gap_days} THEN 0 ELSE 1 END)
            OVER (PARTITION BY {k} ORDER BY {date}) AS island
          FROM (SELECT *, lag({date}) OVER (PARTITION BY {k} ORDER BY {date}) AS prev
                FROM (SELECT DISTINCT {k}, {date} FROM ({source}) AS src) AS once) AS steps
        ) AS runs GROUP BY {k}, island"""
