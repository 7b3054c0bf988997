"""Machine stoppages, service dates and overall equipment effectiveness.

``stoppages``: stoppage_id, stop_date, machine_id, stop_type, cause, minutes.
``machines``: machine_id, hourly_cost, last_service, service_interval_days, performance, quality.
Durations are exact minutes and become hours after they are summed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.functions import rules
from bizops.functions.numeric import dbl, ratio, sum_where
from bizops.operators.ordered import with_order

UNPLANNED, PLANNED = "unplanned", "planned"


def hours(minutes: Column | str) -> Column:
    return dbl(minutes) / 60


def unplanned(stoppages: DataFrame, label: str = UNPLANNED) -> DataFrame:
    return stoppages.where(F.col("stop_type") == label)


def with_rates(machines: DataFrame, rates: DataFrame, key: str = "machine_name") -> DataFrame:
    """Machines with their performance and quality rate; null where the rate table has none.

    The lowest rates count where a machine is listed twice.
    """
    once = rates.groupBy(key).agg(F.min(F.struct("performance", "quality")).alias("_rate"))
    return machines.join(once, key, "left").select(
        *[machines[c] for c in machines.columns], F.col("_rate.performance").alias("performance"), F.col("_rate.quality").alias("quality")
    )


def next_service(machines: DataFrame, as_of: str) -> DataFrame:
    """Next service date and the days left to it."""
    due = F.date_add("last_service", F.col("service_interval_days").cast("int"))
    return machines.withColumn("next_service", due).withColumn(
        "days_left", F.datediff("next_service", F.lit(as_of).cast("date"))
    )


def service_light(machines: DataFrame, as_of: str, urgent: int = 30, soon: int = 60) -> DataFrame:
    return next_service(machines, as_of).withColumn(
        "light", rules.service_light(F.col("days_left"), urgent, soon)
    )


def stoppage_cost(stoppages: DataFrame, machines: DataFrame) -> DataFrame:
    """Cost of each stoppage at its machine's hourly rate, in whole units.

    The rate join is not hinted: machines are broadcast when small, otherwise a machine that owns
    a large part of the log is split at run time.
    """
    rates = machines.select("machine_id", "hourly_cost")
    cost = F.bround(dbl(F.col("minutes") * F.col("hourly_cost")) / 60, 0)
    return stoppages.join(rates, "machine_id", "left").withColumn("cost", cost)


def _minutes_by(stoppages: DataFrame, key: str, label: str = UNPLANNED) -> DataFrame:
    return unplanned(stoppages, label).groupBy(key).agg(F.sum("minutes").alias("_minutes"))


def downtime_by_machine(stoppages: DataFrame, machines: DataFrame, label: str = UNPLANNED) -> DataFrame:
    """Unplanned hours of every machine, zero where nothing was logged."""
    per_machine = _minutes_by(stoppages, "machine_id", label)
    return machines.join(per_machine, "machine_id", "left").withColumn(
        "hours", F.coalesce(hours("_minutes"), F.lit(0.0))
    ).drop("_minutes")


def _availability(stopped: Column, available_hours: float) -> Column:
    share = (F.lit(float(available_hours)) - stopped) / F.lit(float(available_hours))
    return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))


def oee(
    stoppages: DataFrame, machines: DataFrame, available_hours: float, label: str = UNPLANNED
) -> DataFrame:
    """Availability, effectiveness (availability x performance x quality) and rating, worst first."""
    stopped = downtime_by_machine(stoppages, machines, label)
    return (
        stopped.withColumn("availability", _availability(F.col("hours"), available_hours))
        .withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))
        .withColumn("rating", rules.oee_rating(F.col("oee")))
        .orderBy("oee", "machine_id")
    )


def downtime_kpis(
    costed: DataFrame, machines: DataFrame, available_hours: float, label: str = UNPLANNED
) -> DataFrame:
    """One row: unplanned hours of known machines, cost, events, mean effectiveness.

    The log is reduced to one row per machine; the full join keeps machines without stoppages in
    the mean and stoppages of unlisted machines in cost and events.
    """
    per_machine = unplanned(costed, label).groupBy("machine_id").agg(
        F.sum("minutes").alias("_minutes"), F.sum("cost").alias("_cost"), F.count(F.lit(1)).alias("_events")
    )
    listed = machines.select("machine_id", "performance", "quality", F.lit(True).alias("_listed"))
    both = listed.join(per_machine, "machine_id", "full")
    minutes = F.coalesce("_minutes", F.lit(0))
    effect = _availability(hours(minutes), available_hours) * F.col("performance") * F.col("quality")
    return both.agg(
        hours(F.sum(F.when(F.col("_listed"), minutes))).alias("hours"),
        F.coalesce(F.sum("_cost"), F.lit(0.0)).alias("cost"),
        F.coalesce(F.sum("_events"), F.lit(0)).alias("events"),
        F.avg(F.when(F.col("_listed"), effect)).alias("mean_oee"),
    )


def critical_share(stoppages: DataFrame, machine_ids: Sequence, label: str = UNPLANNED) -> DataFrame:
    """Share of unplanned time that belongs to a given set of machines."""
    sums = unplanned(stoppages, label).agg(
        sum_where(F.col("machine_id").isin(list(machine_ids)), "minutes").alias("_set"),
        F.sum("minutes").alias("_all"),
    )
    return sums.select(
        hours("_set").alias("critical_hours"),
        hours("_all").alias("total_hours"),
        ratio("_set", "_all").alias("share"),
    )


def pareto(stoppages: DataFrame, key: str, label: str = UNPLANNED) -> DataFrame:
    """Unplanned hours by ``key``, largest first, with rank, share and cumulative share."""
    ordered = with_order(_minutes_by(stoppages, key, label), [F.desc("_minutes"), key], value="_minutes")
    return ordered.select(
        key,
        "rank",
        hours("_minutes").alias("hours"),
        ratio("_minutes", "grand_total").alias("share"),
        ratio("running", "grand_total").alias("cumulative_share"),
    )


def critical_share_top(stoppages: DataFrame, k: int = 3, label: str = UNPLANNED) -> DataFrame:
    """Share of unplanned time of the ``k`` worst machines."""
    worst = pareto(stoppages, "machine_id", label).where(F.col("rank") <= k)
    return worst.agg(
        F.sum("hours").alias("critical_hours"), F.max("cumulative_share").alias("share")
    )


def downtime_pareto_machine(stoppages: DataFrame, label: str = UNPLANNED) -> DataFrame:
    ranked = pareto(stoppages, "machine_id", label)
    return ranked.withColumn("plan", rules.machine_plan(F.col("rank"))).orderBy("rank")


def downtime_pareto_cause(stoppages: DataFrame, label: str = UNPLANNED) -> DataFrame:
    ranked = pareto(stoppages, "cause", label)
    return ranked.withColumn(
        "label", rules.cause_label(F.col("rank"), F.col("cumulative_share"))
    ).orderBy("rank")


def monthly_stoppages(stoppages: DataFrame, *dims: str) -> DataFrame:
    """Events and hours per month and any further columns."""
    month = F.date_format("stop_date", "yyyy-MM").alias("month")
    sums = stoppages.groupBy(month, *dims).agg(
        F.count(F.lit(1)).alias("events"), F.sum("minutes").alias("_minutes")
    )
    return sums.select("month", *dims, "events", hours("_minutes").alias("hours")).orderBy("month", *dims)
