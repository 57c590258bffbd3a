"""Tables and external stores: DDL, append, replace, connectors, and the models."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallymill.sources.versions import VersionedTable


def create_table_sql(name: str, schema: T.StructType, using: str = "parquet") -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}"


def create_table(spark: SparkSession, name: str, schema: T.StructType, using: str = "parquet") -> None:
    spark.sql(create_table_sql(name, schema, using))


def save(df: DataFrame, fmt: str, mode: str, options: Mapping[str, str] | None = None) -> None:
    """Write through any connector by its format name (a warehouse, a document store, a table format)."""
    df.write.format(fmt).options(**dict(options or {})).mode(mode).save()


def load(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.format(fmt).options(**dict(options or {})).load()


def fetch(df: DataFrame, where=None, columns=None) -> DataFrame:
    """Rows that satisfy `where`, projected to `columns`; both reach the store where it can take them."""
    found = df if where is None else df.where(where)
    return found if columns is None else found.select(*columns)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int = 10_000) -> None:
    """Append over JDBC, `batch_size` rows per insert batch, one connection per partition."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=dict(properties))


def overwrite_and_read(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace what is stored at `path`, then read it back. With a table format this is one commit."""
    df.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Overwrite only the partitions that `df` holds; writing the same batch twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


class Models:
    """Named models: each is a function of what it reads, kept as a view or stored as a table.

    The function gets a reader in place of the session. A name it asks the reader for, by `table` or
    in the text of `sql`, is built first if it is a model, so the order of building follows from
    what the models read; a model that comes to read itself is an error. With `root`, tables are
    versioned folders below it, replaced in one commit each and seen under their names; without,
    they are tables of the session's catalog.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root
        self.built: list[str] = []  # in the order of building
        self.reads: dict[str, list[str]] = {}
        self._models: dict[str, tuple[Callable[[Reader], DataFrame], str]] = {}
        self._open: list[str] = []

    def add(self, name: str, build: Callable[[Reader], DataFrame], materialised: str = "view") -> None:
        if materialised not in ("view", "table"):
            raise ValueError(f"materialised must be 'view' or 'table', not {materialised!r}")
        self._models[name] = (build, materialised)

    def __contains__(self, name: str) -> bool:
        return name in self._models

    def materialise(self, name: str) -> DataFrame:
        """Create the view or replace the table, and return it by name; what it reads is built unless it is there."""
        if name in self._open:
            raise ValueError("models read each other: " + " -> ".join([*self._open[self._open.index(name) :], name]))
        build, kind = self._models[name]
        self._open.append(name)
        self.reads[name] = []
        try:
            made = build(Reader(self, name))
        finally:
            self._open.pop()
        if kind == "view":
            made.createOrReplaceTempView(name)
        elif self.root:
            VersionedTable(self.spark, f"{self.root}/{name}").replace(made).createOrReplaceTempView(name)
        else:
            replace_table(made, name)
            self.spark.catalog.dropTempView(name)  # one that other models left would be read in its place
        self.built = [n for n in self.built if n != name] + [name]
        return self.spark.table(name)

    def build_all(self) -> list[str]:
        """Build every model once, each after what it reads, and return the order."""
        self.built = []
        for name in self._models:
            if name not in self.built:
                self.materialise(name)
        return self.built


class Reader:
    """The session as one model sees it; remembers which other models it reads."""

    def __init__(self, models: Models, name: str):
        self._models, self._name = models, name

    def __getattr__(self, attribute: str):
        return getattr(self._models.spark, attribute)

    def table(self, name: str) -> DataFrame:
        self._need(name)
        return self._models.spark.table(name)

    def sql(self, text: str, *args, **kwargs) -> DataFrame:
        plan = self._models.spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
        for name in re.findall(r"'UnresolvedRelation \[([^\]]+)\]", plan):
            self._need(name.strip("`"))
        return self._models.spark.sql(text, *args, **kwargs)

    def _need(self, name: str) -> None:
        if name in self._models:
            if name not in self._models.reads[self._name]:
                self._models.reads[self._name].append(name)
            if name not in self._models.built or name in self._models._open:
                self._models.materialise(name)
