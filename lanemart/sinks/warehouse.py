"""Warehouse append through staged compressed CSV."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from lanemart.sinks.lake import arrays_to_text


@dataclass(frozen=True)
class WarehouseTarget:
    """Where to append. ``provider`` is the connector's data source name, supplied by the deployer."""

    provider: str
    url: str
    table: str
    staging: str
    user: str | None = None


def warehouse_options(target: WarehouseTarget) -> dict[str, str]:
    options = {
        "url": target.url,
        "dbtable": target.table,
        "tempdir": target.staging,
        "tempformat": "CSV GZIP",
        "forward_spark_s3_credentials": "true",
    }
    if target.user:
        options["user"] = target.user
    return options


def write_warehouse(df: DataFrame, target: WarehouseTarget) -> None:
    """Append; CSV staging takes no arrays, so they are joined to text first."""
    arrays_to_text(df).write.format(target.provider).options(**warehouse_options(target)).mode("append").save()
