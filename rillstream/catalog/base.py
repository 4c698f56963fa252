"""A registry entry: how to run a query, and its oracle text when SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    sql: str | None = None


class Catalog(dict):
    """name -> Entry, filled by the ``query`` decorator."""

    def query(self, name: str, sql: str | None = None):
        def register(fn: Run) -> Run:
            if name in self:
                raise ValueError(f"query {name!r} registered twice")

            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return fn(configure(spark), sf_dir)

            self[name] = Entry(run, sql)
            return fn

        return register
