"""How the modules of this package name their queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import tables, working
from ..sources import readers


class Queries(dict):
    """name -> (query, SQL twin or None)."""

    def add(self, sql: str | None = None, name: str | None = None):
        def register(f):
            self[name or f.__name__] = (f, sql)
            return f

        return register


def table(spark: SparkSession, sf_dir: str, name: str):
    return readers.parquet_table(spark, sf_dir, name)


def new_table(spark: SparkSession, **layout) -> tables.Folder:
    """An empty table in the shared folder, which goes when the session's JVM ends."""
    return tables.Folder(spark, working.new_path(spark, "table"), **layout)
