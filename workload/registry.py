"""Where queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.tables import CTES, NEEDS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_tables(body: str, *needs: str) -> str:
    """`body` with the common table expressions it needs, each after those it builds on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, ()):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f"{name} AS (\n{CTES[name].strip()}\n)" for name in ordered)
    text = body.strip()
    if not parts:
        return text
    if text.upper().startswith("WITH "):
        return f"WITH {parts},\n{text[5:]}"
    return f"WITH {parts}\n{text}"


def query(sql: str | None = None, needs: str = ""):
    """Register a function of `Tables` under its own name, with its SQL if there is one."""

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = run.__name__
        QUERIES[name] = lambda spark, sf_dir: run(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_tables(sql, *needs.split())
        return run

    return register
