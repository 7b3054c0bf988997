"""What each finding is worth in money.  All rates are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.functions.numeric import dbl, ratio
from bizops.operators.downtime import UNPLANNED, pareto

# Fixed values of the estimates.
RECOVERY_RATE = 0.30
OPPORTUNITY_RATE = 0.08
PREVENTIVE_REDUCTION = 0.65
CAUSE_REDUCTION = 0.40
PLANT_HOURLY_COST = 12000


def impact_negative_margin(negative_products: DataFrame, months: int | Column) -> DataFrame:
    """Negative margin per year; ``months`` is the length of the period it was summed over."""
    lost = negative_products.agg(F.coalesce(F.sum("recoverable"), F.lit(0)).alias("_lost"))
    return lost.withColumn("_months", F.lit(months)).select(
        dbl("_lost").alias("recoverable"),
        F.round(dbl("_lost") / F.col("_months") * 12, 2).alias("impact"),
    )


def impact_slow_movers(slow: DataFrame, rate: float = OPPORTUNITY_RATE) -> DataFrame:
    """Capital freed once, and its opportunity cost per year."""
    capital = slow.agg(F.coalesce(F.sum("tied_capital"), F.lit(0.0)).alias("impact"))
    return capital.withColumn("impact_per_year", F.round(F.col("impact") * rate, 2))


def impact_churn(churn: DataFrame, recovery: float = RECOVERY_RATE) -> DataFrame:
    return churn.select(
        dbl("margin_lost").alias("margin_lost"), F.round(dbl("margin_lost") * recovery, 2).alias("impact")
    )


def impact_store_gap(gaps: DataFrame) -> DataFrame:
    """Yearly gain at the store with the weakest ticket."""
    return gaps.orderBy("gap", "store_id").limit(1).select(F.col("gain_per_year").alias("impact"))


def findings_ranked(findings: dict[str, DataFrame]) -> DataFrame:
    """One row per finding by impact, with its share, the cumulative share and the total.

    Each value is a one-row table with an ``impact`` column, so the windows see a handful of rows.
    """
    rows = [df.select(F.lit(name).alias("finding"), dbl("impact").alias("impact"))
            for name, df in findings.items()]
    table = reduce(DataFrame.unionByName, rows)
    largest = W.orderBy(F.desc("impact"), "finding")
    total = F.sum("impact").over(W.partitionBy())
    running = F.sum("impact").over(largest.rowsBetween(W.unboundedPreceding, W.currentRow))
    return table.select(
        F.row_number().over(largest).alias("rank"),
        "finding",
        "impact",
        ratio("impact", total).alias("share"),
        ratio(running, total).alias("cumulative_share"),
        total.alias("total"),
    ).orderBy("rank")


def preventive_saving(
    stoppages: DataFrame,
    machines: DataFrame,
    k: int = 3,
    reduction: float = PREVENTIVE_REDUCTION,
    label: str = UNPLANNED,
) -> DataFrame:
    """Saving from preventing part of the downtime of the ``k`` worst machines."""
    worst = pareto(stoppages, "machine_id", label).where(F.col("rank") <= k)
    priced = worst.join(machines.select("machine_id", "hourly_cost"), "machine_id")
    sums = priced.agg(
        F.sum("hours").alias("hours"), F.sum(F.col("hours") * F.col("hourly_cost")).alias("_cost")
    )
    return sums.select(
        "hours",
        (F.col("hours") * reduction).alias("hours_saved"),
        ratio("_cost", "hours").alias("weighted_hourly_cost"),
        (F.col("_cost") * reduction).alias("saving"),
    )


def cause_reduction_saving(
    stoppages: DataFrame,
    cause: str,
    reduction: float = CAUSE_REDUCTION,
    hourly_cost: float = PLANT_HOURLY_COST,
    label: str = UNPLANNED,
) -> DataFrame:
    """Saving from cutting the hours lost to one cause."""
    lost = stoppages.where((F.col("stop_type") == label) & (F.col("cause") == cause)).agg(
        F.coalesce(dbl(F.sum("minutes")) / 60, F.lit(0.0)).alias("hours")
    )
    return lost.select(
        F.lit(cause).alias("cause"),
        "hours",
        (F.col("hours") * reduction).alias("hours_saved"),
        (F.col("hours") * reduction * hourly_cost).alias("saving"),
    )
