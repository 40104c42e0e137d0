"""How a query is registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """The given tables, read as parquet on access: ``tables.orders``."""

    spark: SparkSession
    folder: str
    opened: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]


@dataclass(frozen=True)
class Entry:
    """A query and, where SQL can state it, the equivalent SQL."""

    run: Callable[[Tables], DataFrame]
    sql: str | None


@dataclass
class Entries:
    """Collects the queries of one module."""

    all: dict[str, Entry] = field(default_factory=dict)

    def query(self, sql: str | None = None) -> Callable:
        """Register the decorated function under its own name."""

        def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            self.all[run.__name__] = Entry(run, sql)
            return run

        return register
