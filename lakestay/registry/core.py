"""Registering queries and giving them their tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestay.registry.derived import DERIVED
from lakestay.session import configure, work_folder


class Tables:
    """The supplied tables of one folder and the frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self._derived: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._schemas: dict[str, StructType] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in DERIVED:
            return self._supplied(name)
        if name not in self._derived:
            text = DERIVED[name]
            self._derived[name] = self.spark.sql(text, **{n: self(n) for n in _inputs(text)})
        return self._derived[name]


    def _supplied(self, name: str) -> DataFrame:
        """A supplied table; its schema is looked up once."""
        reader, path = self.spark.read, f"{self.folder}/{name}.parquet"
        if name in self._schemas:
            return reader.schema(self._schemas[name]).parquet(path)
        df = reader.parquet(path)
        self._schemas[name] = df.schema
        return df

    def once(self, label: str, build: Callable[[Tables], DataFrame]) -> DataFrame:
        """A frame stored at its first use, for queries that need it more than once."""
        if label not in self._stored:
            self._stored[label] = self.stored(build(self), label)
        return self._stored[label]

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """A frame as a written table, the way a later step of the day finds it."""
        table = work_folder(self.spark, label)
        df.write.parquet(table)
        return self.spark.read.parquet(table)


def _inputs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def _with(names: list[str]) -> str:
    """Common table expressions for derived frames and what they are derived from."""
    order: list[str] = []

    def visit(name):
        if name in DERIVED and name not in order:
            for n in _inputs(DERIVED[name]):
                visit(n)
            order.append(name)

    for name in names:
        visit(name)
    plain = {n: re.sub(r"\{(\w+)\}", r"\1", DERIVED[n]) for n in order}
    return ",\n".join(f"{n} AS ({text})" for n, text in plain.items())


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, derived: tuple[str, ...] = ()):
    """Register a function of Tables with the SQL that gives the same rows.

    derived names the derived frames the SQL uses; they are put in front of it.
    """

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        text = sql
        if sql is not None and derived:
            body = sql.strip()
            rest = body[len("WITH"):] if body.upper().startswith("WITH ") else None
            head = f"WITH {_with(list(derived))}"
            text = f"{head},{rest}" if rest is not None else f"{head}\n{body}"
        REGISTRY[name] = Query(run, text)
        return build

    return register


def flat(df: DataFrame) -> DataFrame:
    """Times and arrays as text, for comparison with another engine."""
    def text(name, kind):
        if kind.startswith("timestamp"):
            return F.col(name).cast("string").alias(name)
        if kind.startswith("array<string>"):
            return F.array_join(name, ",").alias(name)
        return F.col(name)

    return df.select(*[text(n, k) for n, k in df.dtypes])
