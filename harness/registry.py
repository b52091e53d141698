"""Registered queries: a Spark job beside the SQL it must agree with.

Stand-ins map the given tables onto the shapes the jobs read. Each is one
SELECT that Spark and the SQL engine both run, so the two sides start from the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from harness.standins import STANDINS, TABLES
from rosterlake.session import configure

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Given tables and stand-ins by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        made = self.__dict__["_made"]
        if name not in made:
            if name in TABLES:
                made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in STANDINS:
                text = STANDINS[name]
                used = [n for n in [*TABLES, *STANDINS] if "{" + n + "}" in text]
                made[name] = self.spark.sql(text, **{n: getattr(self, n) for n in used})
            else:
                raise AttributeError(name)
        return made[name]


def _closure(names: Sequence[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for m in STANDINS:
            if "{" + m + "}" in STANDINS[n]:
                visit(m)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_standins(names: Sequence[str], body: str) -> str:
    """The SQL with its stand-ins as leading CTEs."""
    ctes = []
    for n in _closure(names):
        text = STANDINS[n]
        for m in [*TABLES, *STANDINS]:
            text = text.replace("{" + m + "}", m)
        ctes.append(f"{n} AS ({text.strip()})")
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def query(name: str, uses: Sequence[str] = (), sql: str | None = None):
    """Register a job; ``uses`` are the stand-ins its SQL refers to."""
    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        SPARK[name] = run
        if sql is not None:
            SQL[name] = with_standins(uses, sql)
        return fn
    return add
