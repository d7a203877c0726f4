"""Query registry: name -> (Spark builder, oracle SQL, survey ids)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...] = field(default_factory=tuple)
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = (), headline: bool = False):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ids), headline)
        return fn
    return deco
