"""The catalogue of queries over the operators, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import joins_and_merges, messages, more, outputs, reports, scalars, scans


def _all() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    out: dict = {}
    for module in (scans, scalars, reports, joins_and_merges, messages, more, outputs):
        out.update(module.QUERIES)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
