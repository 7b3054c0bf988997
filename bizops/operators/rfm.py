"""Recency, frequency and money scores per customer, and their segments."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.functions import rules
from bizops.functions.numeric import dbl, ratio
from bizops.operators.grouped import total
from bizops.operators.ordered import at_ranks
from bizops.session import cut_lineage

# Fixed values of the impact estimate.
MANUAL_HOURS_PER_MONTH = 5
ANALYST_HOURLY_COST = 4500
RECOVERY_RATE = 0.30


def rfm_base(sales: DataFrame, scales: Mapping[str, int] = {}) -> DataFrame:
    """Last purchase, distinct tickets, money and margin per customer.

    ``scales`` names columns that hold whole units (see ``grouped.total``).
    """
    known = sales.where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(
        F.max("sale_date").alias("last_date"),
        F.count_distinct("ticket_id").alias("frequency"),
        total("revenue", scales.get("revenue")).alias("monetary"),
        total("margin", scales.get("margin")).alias("margin"),
    )


def quintile_ends(n: int) -> list[int]:
    """The last rank of each of the first four quintiles of ``n`` rows."""
    return [max(1, q * (n - 1) // 5 + 1) for q in range(1, 5)]


def rfm_scores(sales: DataFrame, scales: Mapping[str, int] = {}) -> DataFrame:
    """Quintile scores and segment of every customer.

    Equal values are ranked by customer id.  The customers are made once; their four quintile ends
    of each measure are selected without sorting the customers, and place all of them in one
    projection.
    """
    return scores_of(cut_lineage(rfm_base(sales, scales)))


def scores_of(base: DataFrame) -> DataFrame:
    """Scores from one row per customer: last_date, frequency, monetary, margin."""
    measures = {"r": -F.unix_date("last_date"), "f": F.col("frequency"), "m": F.col("monetary")}
    ends = at_ranks(base, measures, "customer_id", quintile_ends)
    kinds = {f.name: f.dataType for f in base.select("customer_id", *[c.alias(k) for k, c in measures.items()]).schema}
    scored = base
    for score, measure in measures.items():
        place = F.struct(measure.alias("v"), F.col("customer_id"))
        above = [
            (place > F.struct(F.lit(e.value).cast(kinds[score]).alias("v"), F.lit(e.key).cast(kinds["customer_id"]).alias("customer_id"))).cast("int")
            for e in ends[score]
        ]
        bin_ = reduce(Column.__add__, above, F.lit(1))
        scored = scored.withColumn(score, (6 - bin_ if score == "r" else bin_).cast("int"))

    reference = F.date_add(base.agg(F.max("last_date").alias("d")).scalar(), 1)
    return scored.select(
        "customer_id",
        F.datediff(reference, F.col("last_date")).alias("recency"),
        "frequency",
        "monetary",
        "margin",
        "r",
        "f",
        "m",
        F.bround((F.col("f") + F.col("m")) / 2, 0).cast("int").alias("fm"),
    ).withColumn("segment", rules.rfm_segment(F.col("r"), F.col("fm"))).withColumn(
        "action", rules.lookup(F.col("segment"), rules.SEGMENT_ACTIONS)
    )


def best_first(scores: DataFrame) -> DataFrame:
    """The order of the published list: best recency, then best frequency-money score."""
    return scores.orderBy(F.desc("r"), F.desc("fm"), "customer_id")


def rfm_segment_summary(scores: DataFrame) -> DataFrame:
    """Customers, margin, mean money and share of customers per segment."""
    per_segment = scores.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("margin").alias("_margin"),
        F.sum("monetary").alias("_monetary"),
    )
    # Six segments at most, so the total needs no partitioning.
    everyone = F.sum("customers").over(W.partitionBy())
    return per_segment.select(
        "segment",
        "customers",
        F.bround(dbl("_margin"), 0).alias("margin_total"),
        F.bround(ratio("_monetary", "customers"), 0).alias("monetary_mean"),
        F.bround(ratio("customers", everyone) * 100, 1).alias("pct_customers"),
    ).orderBy(F.desc("margin_total"), "segment")


def rfm_impact(
    summary: DataFrame,
    months: DataFrame,
    hours_per_month: float = MANUAL_HOURS_PER_MONTH,
    hourly_cost: float = ANALYST_HOURLY_COST,
    recovery: float = RECOVERY_RATE,
) -> DataFrame:
    """Yearly value of the automated report and of winning back part of the at-risk segment."""
    at_risk = F.col("segment") == rules.AT_RISK
    totals = summary.agg(
        F.coalesce(F.sum(F.when(at_risk, F.col("customers"))), F.lit(0)).alias("customers_at_risk"),
        F.coalesce(F.sum(F.when(at_risk, F.col("margin_total"))), F.lit(0.0)).alias("_margin"),
    ).withColumn("_months", months.scalar())
    hours = hours_per_month * 12
    recoverable = F.col("_margin") / (F.col("_months") / F.lit(12.0)) * recovery
    return totals.select(
        F.lit(hours).alias("hours_saved"),
        F.bround(F.lit(float(hours * hourly_cost)), 0).alias("hours_value"),
        "customers_at_risk",
        F.bround(recoverable, 0).alias("recoverable"),
        F.bround(F.lit(float(hours * hourly_cost)) + recoverable, 0).alias("total_impact"),
    )
