"""Registry of named queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from headwater.plans.bindings import CTES, Tables
from headwater.session import ship


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(ship(spark), sf_dir))


REGISTRY: dict[str, Query] = {}


def _closure(names: list[str]) -> list[str]:
    """The named views and everything they are built from, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0].split():
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_views(uses: str, body: str) -> str:
    views = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in _closure(uses.split()))
    if not views:
        return body
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {views},\n{stripped[15:]}"
    if stripped[:5].upper() == "WITH ":
        return f"WITH {views},\n{stripped[5:]}"
    return f"WITH {views}\n{body}"


def query(name: str, uses: str = "", sql: str | None = None):
    """Register the decorated ``Tables -> DataFrame`` function under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, with_views(uses, sql) if sql else None)
        return build

    return register
