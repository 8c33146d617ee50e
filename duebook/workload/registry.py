"""Registry of queries: a Spark callable, the columns it returns, and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.session import use_runtime_settings, use_small_parts


@dataclass(frozen=True)
class Columns:
    """Result columns by kind; each kind has one type on either side of the comparison."""

    ints: str = ""
    nums: str = ""
    days: str = ""
    flags: str = ""
    texts: str = ""

    def _typed(self) -> list[tuple[str, str, str]]:
        kinds = [
            (self.ints, "bigint", "BIGINT"),
            (self.nums, "double", "DOUBLE"),
            (self.days, "string", "VARCHAR"),
            (self.flags, "boolean", "BOOLEAN"),
            (self.texts, "string", "VARCHAR"),
        ]
        return [(name, s, d) for names, s, d in kinds for name in names.split()]

    def of(self, df: DataFrame) -> DataFrame:
        return df.select(*(F.col(n).cast(dtype).alias(n) for n, dtype, _ in self._typed()))

    def sql(self) -> str:
        casts = ", ".join(f"CAST({n} AS {dtype}) AS {n}" for n, _, dtype in self._typed())
        return f"SELECT {casts} FROM result"


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    columns: Columns | None
    oracle: str | None


QUERIES: dict[str, Query] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    """Name a piece of oracle SQL and the pieces it reads from."""
    CTES[name] = (needs, sql)


def with_ctes(result: str, *needs: str) -> str:
    """``WITH`` clause holding ``needs``, all they need in turn, and ``result``."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name not in ordered:
            for other in CTES[name][0]:
                visit(other)
            ordered[name] = CTES[name][1]

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({sql})" for name, sql in [*ordered.items(), ("result", result)]]
    return "WITH " + ",\n".join(parts)


def query(name: str, columns: Columns | None = None, sql: str | None = None, needs: str = ""):
    """Register a query. ``sql`` defines ``result``; ``needs`` names the pieces it reads."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        oracle = None
        if sql is not None:
            oracle = f"{with_ctes(sql, *needs.split())}\n{columns.sql()}"
        QUERIES[name] = Query(build, columns, oracle)
        return build

    return register


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    entry = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_runtime_settings(spark)
        use_small_parts(spark)
        df = entry.build(spark, sf_dir)
        return entry.columns.of(df) if entry.columns else df

    return run
