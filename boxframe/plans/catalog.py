"""Registered queries: each is a Spark DataFrame built by the library over the
fixture views of one scale-factor folder, plus (where SQL can say it) an
independent DuckDB query over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.fixtures import Fixtures, duckdb_ctes


@dataclass
class Query:
    name: str
    build: Callable[[Fixtures], DataFrame]
    sql: str | None = None  # body after the fixture CTEs
    views: list[str] = field(default_factory=list)
    extra_ctes: str = ""  # further CTEs appended after the fixture ones
    recursive: bool = False  # whether one of them is recursive

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        head = duckdb_ctes(self.views)
        if self.extra_ctes:
            head = (head + ",\n" if head else "with ") + self.extra_ctes.strip()
        if self.recursive:
            head = head.replace("with ", "with recursive ", 1)
        return f"{head}\n{self.sql.strip()}"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, views: list[str] | None = None, extra_ctes: str = "",
             recursive: bool = False):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, views or [], extra_ctes, recursive)
        return fn

    return deco


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _load()
    return REGISTRY[name].build(Fixtures(spark, sf_dir))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, _n=name: run(spark, sf_dir, _n)) for name in REGISTRY}


def oracle_queries() -> dict[str, str]:
    _load()
    out = {}
    for name, q in REGISTRY.items():
        s = q.oracle()
        if s is not None:
            out[name] = s
    return out


def _load() -> None:
    # Importing the modules fills REGISTRY.
    from boxframe.plans import queries_data, queries_eval, queries_images  # noqa: F401
