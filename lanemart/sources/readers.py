"""Where frames come from."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class JdbcConnection:
    """Warehouse connection. Login values are read from the environment when a read is built."""

    url: str
    driver: str
    user_env: str = "WAREHOUSE_USER"
    password_env: str = "WAREHOUSE_PASSWORD"


@dataclass(frozen=True)
class Sources:
    spark: SparkSession
    parquet_root: str | None = None
    tables: Mapping[str, str] = field(default_factory=dict)
    _schemas: dict[str, T.StructType] = field(default_factory=dict, repr=False, compare=False)

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Scan of a catalog table, or of ``<parquet_root>/<name>.parquet`` when a root is set."""
        if self.parquet_root is not None:
            path = f"{self.parquet_root}/{name}.parquet"
            if path not in self._schemas:
                self._schemas[path] = self.spark.read.parquet(path).schema
            # Every scan is its own relation, and the file schema is looked up once.
            df = self.spark.read.schema(self._schemas[path]).parquet(path)
        else:
            df = self.spark.table(self.tables.get(name, name))
        return df.select(*columns) if columns else df

    def jdbc(self, query: str, connection: JdbcConnection, **split: object) -> DataFrame:
        """Relation given as a subquery that runs in the warehouse; see :func:`jdbc_options`."""
        return self.spark.read.format("jdbc").options(**jdbc_options(query, connection, **split)).load()

    def jdbc_parts(self, query: str, connection: JdbcConnection, predicates: Sequence[str]) -> DataFrame:
        """The relation read by one task per condition, of which every row meets one; see ``splits.split_predicates``."""
        options = jdbc_options(query, connection)
        url, relation = options.pop("url"), options.pop("dbtable")
        return self.spark.read.jdbc(url, relation, predicates=list(predicates), properties=options)

    def sheet(self, path: str, schema: T.StructType) -> DataFrame:
        """Keyed override sheet exported as CSV with a header row."""
        return self.spark.read.schema(schema).option("header", True).csv(path)


def jdbc_options(
    query: str,
    connection: JdbcConnection,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a partition column the relation is read by several tasks in parallel."""
    options = {
        "url": connection.url,
        "driver": connection.driver,
        "dbtable": f"({query.strip().rstrip(';')}) AS relation",
        "fetchsize": str(fetch_size),
    }
    for option, variable in (("user", connection.user_env), ("password", connection.password_env)):
        if variable in os.environ:
            options[option] = os.environ[variable]
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def literal_dim(spark: SparkSession, mapping: Mapping[str, Sequence[str]], key: str, value: str) -> DataFrame:
    """Dimension written in code, ``value`` -> ``key`` group. Its size is fixed, so it is always broadcast."""
    rows = [(group, member) for group, members in mapping.items() for member in members]
    # An Arrow table becomes a local relation; a list would be read by Python workers in every executor.
    names, text = (key, value), pa.string()
    table = pa.table([pa.array([row[i] for row in rows], text) for i in range(2)], names=names)
    return F.broadcast(spark.createDataFrame(table))
