"""All registered queries of the legal-corpus part, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexicord.plans import build_queries, document_queries, table_queries, text_queries

ALL = text_queries.QUERIES | table_queries.QUERIES | build_queries.QUERIES | document_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
