"""Named queries: a DataFrame function, the operators it covers, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from forumlens.runtime import ship_package

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    covers: tuple[str, ...]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its name."""

    def register(run: Query) -> Query:
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf)

        ENTRIES[run.__name__] = Entry(shipped, tuple(covers.split()), sql)
        return run

    return register
