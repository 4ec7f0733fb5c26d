"""Exact de-duplication with a split for heavy hitters, in DataFrame operations only.

Two texts are equal when they are identical after deleting ASCII white space. The digest is the SHA-256 of
what is left. Of equal texts the one with the most code points stays, then the smallest id.

1. A frequent-items sketch (Misra-Gries counters, ``approx_top_k``) names at most ``HEAVY`` digests that hold
   more than 1/``HEAVY`` of the rows each. The sketch guarantees to name all of those.
2. Their winners are found exactly, by an aggregate whose map side leaves one row per digest and task, and
   broadcast: at most ``HEAVY`` rows, whatever the table's size.
3. All rows of heavy digests are settled on the map side. The others are aggregated per digest, combined before
   the shuffle, and looked up among the digests that more than one row has. No group of them holds more than
   1/``HEAVY`` of the rows, and as none has to be gathered, adaptive execution can split those that are long.

Defined cases: null text counts as empty, and all empty or blank texts are equal. A null id comes after all
others. Repeated rows count as copies, of which one is kept. An empty table gives an empty result. Further
columns do not matter; ``deduplicate`` returns them as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import cut

#: Most digests that are settled on the map side.
HEAVY = 1024
#: Counters of the sketch. Its error is at most 3.5 / TRACKED of the rows, well below 1 / HEAVY.
TRACKED = 8192
BLANKS = " \t\n\x0b\f\r"


def stripped(text: Column) -> Column:
    """The text without ASCII white space; null as empty."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def _heavy(rows: DataFrame) -> DataFrame:
    found = rows.agg(F.expr(f"approx_top_k(__digest, {HEAVY}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    item = found.select(F.explode("top").alias("t"), "n")
    return item.filter(F.col("t.count") * HEAVY >= F.col("n")).select(F.col("t.item").alias("__digest"))


def _better(id_column: str) -> Column:
    """Sorts the row that stays first."""
    return F.struct(-F.col("__n"), F.col(id_column).isNull(), F.col(id_column), F.col("__row"))


def _winners(rows: DataFrame, id_column: str) -> DataFrame:
    chosen = rows.join(F.broadcast(_heavy(rows)), "__digest", "left_semi").groupBy("__digest")
    return chosen.agg(F.count(F.lit(1)).alias("__size"), F.min(_better(id_column)).alias("__best"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("__id"), F.length(text).alias("__n"), F.sha2(stripped(text), 256).alias("__digest")
    )
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    winners = cut(_winners(rows, "__id"))
    settled = rows.join(F.broadcast(winners), "__digest")
    others = rows.join(F.broadcast(winners.select("__digest")), "__digest", "left_anti")
    several = others.groupBy("__digest").agg(F.count(F.lit(1)).alias("__size"), F.min(_better("__id")).alias("__best"))
    # Cut, so that the lookup below has a shuffle on either side and a long one can be split.
    others = others.join(cut(several.filter("__size > 1")), "__digest", "left").withColumns(
        {"__size": F.coalesce("__size", F.lit(1).cast("long")), "__best": F.coalesce("__best", _better("__id"))}
    )
    return settled.unionByName(others).select(
        F.col("__id").alias(id_column),
        F.col("__best.__id").alias("keep_id"),
        F.col("__size").alias("group_size"),
        (F.col("__best.__row") == F.col("__row")).alias("kept"),
        F.col("__digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Copies of heavy digests go on the map side. The rest meets by digest in an aggregate that leaves one row
    per digest and map task before the shuffle.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
        F.col(id_column).alias("__id"), F.length(text).alias("__n"), F.sha2(stripped(text), 256).alias("__digest"),
        F.lit(0).alias("__row"),
    )
    winners = cut(_winners(keyed.drop("__doc"), "__id"))
    left = keyed.join(F.broadcast(winners), "__digest", "left")
    left = left.filter(F.col("__best").isNull() | (F.col("__best") == _better("__id")))
    best = left.groupBy("__digest").agg(F.min_by("__doc", _better("__id")).alias("__doc"))
    return best.select("__doc.*")
