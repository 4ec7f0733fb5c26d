"""Consigner history kept as state, and advanced by what is new.

The history of a consigner (first demand, first fulfilled demand, number of fulfilled ones) and the rank of each demand
look at every demand ever made. Here a run reads the state saved at a watermark (the largest id it has seen) and the
rows that came since:

* states of disjoint sets of rows are merged by minima and sums;
* ranks of new rows start from the number in the state;
* a row that comes late (its id is at or below the watermark) changes the ranks of rows that were published before, so
  its consigner is done again, from all its rows. Other consigners are not read.

State plus new rows equal the full computation. A null consigner is one group, as in the full one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.fixed import MartParams
from lanemart.functions.time import to_local
from lanemart.operators.windows import prior_running_sum
from lanemart.sources.bounds import not_deleted

KEY = "consigner_user_code"


def state_of(demands: DataFrame, params: MartParams) -> DataFrame:
    """State of a set of demands: one row per consigner."""
    local, done = to_local(F.col("created"), params.shift), F.col("status") == "FULFILLED"
    return not_deleted(demands).groupBy(KEY).agg(
        F.min(local).alias("consigner_onboarding_date"),
        F.min(F.when(done, local)).alias("consigner_fulfilled_demand_date"),
        F.min(F.when(done, F.col("id"))).alias("consigner_fulfilled_demand_id"),
        F.count(F.when(done, F.lit(1))).alias("fulfilled"),
    )


def merge_states(one: DataFrame, other: DataFrame) -> DataFrame:
    """State of both sets of demands, which must have no row in common."""
    least = ("consigner_onboarding_date", "consigner_fulfilled_demand_date", "consigner_fulfilled_demand_id")
    both = one.unionByName(other)
    return both.groupBy(KEY).agg(*[F.min(c).alias(c) for c in least], F.sum("fulfilled").alias("fulfilled"))


def late_keys(fresh: DataFrame, watermark: int) -> DataFrame:
    """Consigners that have a live new row at or below the watermark."""
    return not_deleted(fresh).filter(F.col("id") <= watermark).select(F.col(KEY).alias("__late")).distinct()


def of_keys(df: DataFrame, keys: DataFrame, wanted: bool = True) -> DataFrame:
    """Rows whose consigner is among ``keys`` (or is not). Null equals null."""
    return df.join(keys, df[KEY].eqNullSafe(keys["__late"]), "left_semi" if wanted else "left_anti")


def advance(
    state: DataFrame, fresh: DataFrame, history: DataFrame, watermark: int, params: MartParams
) -> tuple[DataFrame, DataFrame]:
    """The state after ``fresh`` rows, and the ranks ``(demand_id, fulfilled_rank)`` that are new or have changed.

    ``history`` is the whole table, ``fresh`` rows included; only rows of consigners with late rows are used of it.
    """
    late = late_keys(fresh, watermark)
    on_time, again = of_keys(fresh, late, wanted=False), of_keys(history, late)
    merged = merge_states(of_keys(state, late, wanted=False), state_of(on_time, params))
    return merged.unionByName(state_of(again, params)), _ranks_after(state, on_time, params).unionByName(_ranks(again, params))


def _ranks(demands: DataFrame, params: MartParams) -> DataFrame:
    done = F.when(F.col("status") == "FULFILLED", F.lit(1)).otherwise(F.lit(0))
    live = not_deleted(demands).withColumn("demand_id", F.col("id"))
    return prior_running_sum(live, KEY, "id", done, "demand_id", "fulfilled_rank", bucket_width=params.id_bucket)


def _ranks_after(state: DataFrame, on_time: DataFrame, params: MartParams) -> DataFrame:
    """Ranks of rows above the watermark: what the state counts, and what came before them since."""
    counted = state.select(F.col(KEY).alias("__of"), F.col("fulfilled").alias("__before"))
    live = not_deleted(on_time).select(F.col("id").alias("demand_id"), KEY)
    before = live.join(counted, live[KEY].eqNullSafe(counted["__of"]), "left").select("demand_id", "__before")
    rank = F.col("fulfilled_rank") + F.coalesce("__before", F.lit(0))
    return _ranks(on_time, params).join(before, on="demand_id").select("demand_id", rank.alias("fulfilled_rank"))


def replace_ranks(ranks: DataFrame, changed: DataFrame) -> DataFrame:
    """Saved ranks with those of a run put in."""
    return ranks.join(changed.select("demand_id"), on="demand_id", how="left_anti").unionByName(changed)
