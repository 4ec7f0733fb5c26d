"""What the registered queries share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanemart.sources.readers import Sources
from lanemart.standin import StandIn


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    return Sources(spark, parquet_root=root).table(name, columns or None)


def r4(value: Column) -> Column:
    """Four decimals: the order of additions differs between engines."""
    return F.round(value.cast("double"), 4)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r4(F.col(c)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (``spark.checkpoint.dir``), or on one machine in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="lanemart-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


class Frames(Mapping):
    """Source frames by name, built when asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self._stand_in = StandIn(spark, root)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        from lanemart.standin import FRAMES

        if name not in FRAMES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self._stand_in, name)()
        return self._built[name]

    def __iter__(self):
        from lanemart.standin import FRAMES

        return iter(FRAMES)

    def __len__(self) -> int:
        from lanemart.standin import FRAMES

        return len(FRAMES)
