"""Stock coverage of a wide stock sheet: product_id, category, stock, unit_cost, m1..m6, last_movement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.functions import rules
from bizops.functions.numeric import count_where, dbl, ratio, sum_where
from bizops.operators.ordered import percentiles
from bizops.session import cut_lineage

MONTH_COLUMNS = ("m1", "m2", "m3", "m4", "m5", "m6")
NEVER_RUNS_OUT = 9999.0  # cover of a product that does not sell


def _sold(months: Sequence[str] = MONTH_COLUMNS) -> Column:
    total = F.col(months[0])
    for m in months[1:]:
        total = total + F.col(m)
    return total


def stock_coverage(sheet: DataFrame, months: Sequence[str] = MONTH_COLUMNS) -> DataFrame:
    """Mean monthly sales, days of cover, state and recommended action."""
    return (
        sheet.withColumn("mean_monthly", dbl(_sold(months)) / len(months))
        .withColumn(
            "cover_days",
            F.coalesce(F.try_divide(dbl("stock"), F.col("mean_monthly") / 30), F.lit(NEVER_RUNS_OUT)),
        )
        .withColumn("state", rules.coverage_state(F.col("cover_days")))
        .withColumn("action", rules.lookup(F.col("state"), rules.COVERAGE_ACTIONS))
        .withColumn("capital", F.col("stock") * F.col("unit_cost"))
    )


def stock_kpis(sheet: DataFrame, as_of: str, months: Sequence[str] = MONTH_COLUMNS) -> DataFrame:
    """The per-product indicators of the analysis sheet."""
    return stock_coverage(sheet, months).withColumns(
        {
            "turnover": ratio(_sold(months), "stock"),
            "stockout_alert": F.col("cover_days") < 7,
            "days_without_movement": F.datediff(F.lit(as_of).cast("date"), F.col("last_movement")),
        }
    )


def pct_of_total(sheet: DataFrame, months: Sequence[str] = MONTH_COLUMNS) -> DataFrame:
    """Each product's share of all sales."""
    sold = cut_lineage(sheet.select("product_id", _sold(months).alias("sales")))
    total = sold.agg(F.sum("sales").alias("t")).scalar()
    return sold.select("product_id", "sales", ratio("sales", total).alias("share"))


def coverage_abc(
    sheet: DataFrame, a: float = 0.8, b: float = 0.5, months: Sequence[str] = MONTH_COLUMNS
) -> DataFrame:
    """Class by percentile of mean monthly sales: A from ``a`` up, B from ``b`` up, else C."""
    means = cut_lineage(sheet.select("product_id", (dbl(_sold(months)) / len(months)).alias("mean_monthly")))
    cut = percentiles(means, "mean_monthly", {"a": a, "b": b}).select(F.struct("a", "b").alias("cut"))
    placed = means.withColumn("_cut", cut.scalar())
    mean = F.col("mean_monthly")
    return placed.select(
        "product_id",
        "mean_monthly",
        F.when(mean >= F.col("_cut.a"), "A").when(mean >= F.col("_cut.b"), "B").otherwise("C").alias("abc"),
    )


def coverage_state_counts(covered: DataFrame) -> DataFrame:
    """Products and capital per state; states without products stay, at zero."""
    states = rules.value_rows(covered.sparkSession, "state", rules.COVERAGE_STATES)
    sums = covered.groupBy("state").agg(
        F.count(F.lit(1)).alias("_products"), F.sum("capital").alias("_capital")
    )
    return states.join(sums, "state", "left").orderBy("_order").select(
        "state",
        F.coalesce("_products", F.lit(0)).alias("products"),
        F.coalesce(dbl("_capital"), F.lit(0.0)).alias("capital"),
    )


def capital_by_category(covered: DataFrame) -> DataFrame:
    return covered.groupBy("category").agg(F.sum("capital").alias("capital")).orderBy("category")


def dead_stock_capital(covered: DataFrame) -> DataFrame:
    """Capital in dead stock and its share of all capital."""
    dead = F.col("state") == rules.COVERAGE_STATES[-1]
    sums = covered.agg(
        count_where(dead).alias("dead_products"),
        sum_where(dead, "capital").alias("dead_capital"),
        F.sum("capital").alias("total_capital"),
    )
    return sums.withColumn("dead_pct", F.round(ratio("dead_capital", "total_capital") * 100, 1))


def monthly_sales_trend(sheet: DataFrame, months: dict[str, str]) -> DataFrame:
    """Total sales per month from the sheet's month columns; ``months`` maps column to month label.

    The columns are summed before they become rows, so six rows are unpivoted, not six per product.
    """
    totals = sheet.agg(*[F.sum(c).alias(label) for c, label in months.items()])
    return totals.unpivot([], list(months.values()), "month", "sales").orderBy("month")


def top_capital(covered: DataFrame, k: int = 10) -> DataFrame:
    return covered.select("product_id", "category", "capital", "state").orderBy(
        F.desc("capital"), "product_id"
    ).limit(k)


def stock_alerts(covered: DataFrame) -> DataFrame:
    """The four alert lists as one table: every product that is not in its normal range."""
    return covered.withColumn("priority", rules.lookup(F.col("state"), rules.ALERT_PRIORITY)).where(
        F.col("priority").isNotNull()
    ).select("priority", F.col("state").alias("alert"), "product_id", "category", "cover_days",
             "mean_monthly", "stock", "capital", "action")
