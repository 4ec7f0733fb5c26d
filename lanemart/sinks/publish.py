"""Two-step publish of a parquet target: staged files, gates, then one rename that readers see.

A target is a folder with ``data`` and ``pointers``. A pointer is a small file that names, per range of ids, the
directory that holds it; readers take the pointer of the largest number. A run

1. writes its rows to a new directory below ``data``, and observes figures while it writes;
2. compares the figures with its gates; if one fails it removes what it staged and raises, with all figures;
3. writes the next pointer under a temporary name and renames it. The rename is the commit: before it readers have the
   old rows, after it the new ones. If another run took the number meanwhile the rename fails, and so does this run.

Ranges that a run does not touch are named again, not copied. A run that is repeated gives the same rows. Data that no
pointer names is removed by :func:`clean`. This is no table format: one writer at a time, a schema that stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanemart.sinks.replace import BUCKET


class GateError(ValueError):
    """A run whose figures are outside its gates. ``figures`` holds all of them."""

    def __init__(self, failed: list[str], figures: Mapping):
        super().__init__(f"{'; '.join(failed)}; figures: {dict(figures)}")
        self.figures = dict(figures)


@dataclass(frozen=True)
class Gates:
    """Least rows, most rows without a key, most repeated keys, and the largest share of nulls by column.

    A left lookup that finds nothing leaves nulls, so the last one bounds lookups without a match.
    """

    least_rows: int = 0
    null_keys: int = 0
    repeated_keys: int = 0
    unmatched: Mapping[str, float] = field(default_factory=dict)

    def check(self, figures: Mapping) -> None:
        failed = []
        if figures["rows"] < self.least_rows:
            failed.append(f"{figures['rows']} rows, at least {self.least_rows} are expected")
        for name, most in (("null_keys", self.null_keys), ("repeated_keys", self.repeated_keys)):
            if figures[name] > most:
                failed.append(f"{figures[name]} {name.replace('_', ' ')}, at most {most} are allowed")
        for column, share in self.unmatched.items():
            if figures[f"null:{column}"] > share * figures["rows"]:
                failed.append(f"{column} is null in {figures[f'null:{column}']} rows of {figures['rows']}, a share of {share} is allowed")
        if failed:
            raise GateError(failed, figures)


def observed(df: DataFrame, key: str, gates: Gates) -> tuple[DataFrame, Observation]:
    """The frame, and the figures that its one action will leave; they are of the rows with ``__new``.

    Repeats are numbered in a window over the key: rows that come out of a join by the key are dealt and sorted for it.
    """
    seen = Observation(f"gates-{uuid.uuid4().hex}")
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    count = lambda c: F.count(F.when(F.col("__new") & c, F.lit(1)))
    numbered = df.withColumn("__nth", nth).observe(
        seen,
        count(F.lit(True)).alias("rows"),
        count(F.col(key).isNull()).alias("null_keys"),
        count(F.col(key).isNotNull() & (F.col("__nth") > 1)).alias("repeated_keys"),
        *[count(F.col(c).isNull()).alias(f"null:{c}") for c in gates.unmatched],
    )
    return numbered.drop("__nth", "__new"), seen


def read_published(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest pointer."""
    named = _newest(spark, root)[1]
    return _rows(spark, root, list(named.values()), schema)


def replace_since_published(
    spark: SparkSession, root: str, batch: DataFrame, id_col: str, start: int, gates: Gates = Gates(), width: int = 1 << 20
) -> dict:
    """Replace all rows from ``start`` on by those of the batch, in one commit; the batch's figures are returned.

    Ranges of ``width`` ids lie in directories of their own; the watermark's range is written anew with its older rows.
    Rows with a null id have a directory too, which a batch that has such rows (its gates permitting) replaces.
    """
    number, named = _newest(spark, root)
    first = start // width
    rows = batch.filter(F.col(id_col).isNull() | (F.col(id_col) >= start)).withColumn("__new", F.lit(True))
    before = named.get(str(first))
    if before:
        older = _rows(spark, root, [before], batch.schema).filter(F.col(id_col) < start)
        rows = rows.unionByName(older.withColumn("__new", F.lit(False)))
    rows, seen = observed(rows, id_col, gates)
    staged = f"data/{uuid.uuid4().hex}"
    bucket = F.floor(F.col(id_col) / F.lit(width)).cast("bigint")
    dealt = rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
    try:
        dealt.write.partitionBy(BUCKET).option("compression", "zstd").parquet(f"{root}/{staged}")
        fresh = {name.split("=", 1)[1]: f"{staged}/{name}" for name in _names(spark, f"{root}/{staged}") if name.startswith(f"{BUCKET}=")}
        # A plan that is known to be empty is not run, and leaves no figures.
        figures = seen.get if fresh else {c: 0 for c in ("rows", "null_keys", "repeated_keys", *(f"null:{c}" for c in gates.unmatched))}
        gates.check(figures)
        kept = {b: d for b, d in named.items() if not b.lstrip("-").isdigit() or int(b) < first}
        _commit(spark, root, number + 1, kept | fresh)
    except BaseException:
        _delete(spark, f"{root}/{staged}")
        raise
    return figures


def clean(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` pointers, and the data that none of those names; the number of directories removed."""
    numbers = _numbers(spark, root)
    for n in numbers[:-keep]:
        _delete(spark, _pointer(root, n))
    used = {d.split("/")[1] for n in numbers[-keep:] for d in _read_pointer(spark, root, n).values()}
    gone = [name for name in _names(spark, f"{root}/data") if name not in used]
    for name in gone:
        _delete(spark, f"{root}/data/{name}")
    return len(gone)


def _rows(spark: SparkSession, root: str, directories: list[str], schema: T.StructType) -> DataFrame:
    if not directories:
        return spark.createDataFrame([], schema)
    # A directory's own name is no column here: the id says which range a row belongs to.
    return spark.read.schema(schema).parquet(*[f"{root}/{d}" for d in directories])


def _pointer(root: str, number: int) -> str:
    return f"{root}/pointers/{number:012d}"


def _commit(spark: SparkSession, root: str, number: int, named: Mapping[str, str]) -> None:
    fs, final = _at(spark, _pointer(root, number))
    _, draft = _at(spark, f"{root}/pointers/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(dict(named)).encode()))
    finally:
        out.close()
    # A rename onto a file that exists is refused by some file systems and replaces it in others.
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another run has published number {number} of {root}")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, f"{root}/pointers") if n.isdigit())


def _newest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    numbers = _numbers(spark, root)
    return (numbers[-1], _read_pointer(spark, root, numbers[-1])) if numbers else (0, {})


def _read_pointer(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    text = spark.read.option("wholetext", True).text(_pointer(root, number)).first()
    return json.loads(text[0])


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _at(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(at)] if fs.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)
