"""ABC-XYZ classes, safety stock, reorder point, order quantity and what they are worth.

Inputs: ``demand`` (sku, month_start, units), ``products`` (sku, name, category, unit_price,
unit_cost, lead_time_days, order_cost) and ``stock`` (sku, stock_on_hand).  Demand is reduced to one
row per SKU once; everything after that is SKU-sized.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from bizops.functions import rules
from bizops.functions.numeric import count_where, dbl, not_below_zero, ratio, zero_to_one
from bizops.operators.ordered import with_order

# Fixed values of the stock policy.
Z_SCORE = 1.645
HOLDING_RATE = 0.25
ABC_A, ABC_B = "0.80", "0.95"
XYZ_X, XYZ_Y = 0.30, 0.60
ORDERS_PER_YEAR_NOW = 12
MAX_ORDERS_PER_YEAR = 52
ANALYST_HOURLY_COST = 3000
HOURS_SAVED_PER_MONTH = 7.5
# Service levels by class: 98 % for the steady best sellers, 90 % for the erratic tail, else 95 %.
Z_BY_CLASS = {"AX": 2.054, "CZ": 1.282}

# The columns of the two published tables, in their order.
CLASSIFICATION_COLUMNS = [
    "sku", "name", "category", "abc", "xyz", "class", "cv", "revenue_total", "revenue_share",
    "cumulative_share",
]
POLICY_COLUMNS = [
    "sku", "name", "category", "class", "demand_avg", "demand_std", "cv", "lead_time_days",
    "safety_stock", "reorder_point", "order_quantity", "stock_on_hand", "optimal_stock",
    "excess_units", "tied_capital", "deficit_units", "sales_at_risk", "below_reorder_point",
]


def demand_stats(demand: DataFrame) -> DataFrame:
    """Mean, sample deviation, sum and coefficient of variation of monthly demand per SKU.

    Whole units are summed, with their squares, as exact whole numbers and divided once, so the results
    are the same to the last bit however the rows are dealt out.  Fractional units use doubles.
    """
    if not isinstance(demand.schema["units"].dataType, IntegralType):
        units = dbl("units")
        moments = demand.groupBy("sku").agg(
            F.avg(units).alias("demand_avg"), F.stddev_samp(units).alias("demand_std"), F.sum("units").alias("demand_sum"))
    else:
        wide = F.col("units").cast("decimal(19,0)")
        sums = demand.groupBy("sku").agg(
            F.count("units").alias("_n"), F.sum("units").alias("demand_sum"), F.sum(wide * wide).alias("_squares"))
        n, total = F.col("_n").cast("decimal(10,0)"), F.col("demand_sum").cast("decimal(19,0)")
        # n times the sum of squared deviations, still a whole number
        spread = n * F.col("_squares") - total * total
        moments = sums.select(
            "sku", ratio("demand_sum", "_n").alias("demand_avg"),
            F.sqrt(ratio(spread, F.col("_n") * (F.col("_n") - 1))).alias("demand_std"), "demand_sum")
    return moments.withColumn("cv", F.col("demand_std") / zero_to_one("demand_avg"))


def xyz_classes(stats: DataFrame, x: float = XYZ_X, y: float = XYZ_Y) -> DataFrame:
    return stats.withColumn("xyz", rules.xyz_class(F.col("cv"), x, y))


def sku_revenue(demand: DataFrame, products: DataFrame) -> DataFrame:
    """Units times price per SKU; units are summed before the price is looked up."""
    sold = demand.groupBy("sku").agg(F.sum("units").alias("_units"))
    priced = sold.join(products.select("sku", "unit_price"), "sku")
    return priced.select("sku", (F.col("_units") * F.col("unit_price")).alias("revenue_total"))


def abc_classes(revenue: DataFrame, a: str = ABC_A, b: str = ABC_B) -> DataFrame:
    """Share, cumulative share and class of each SKU; further columns are carried along."""
    ordered = with_order(revenue, [F.desc("revenue_total"), "sku"], value="revenue_total")
    return ordered.select(
        *revenue.columns,
        ratio("revenue_total", "grand_total").alias("revenue_share"),
        ratio("running", "grand_total").alias("cumulative_share"),
        rules.abc_class(F.col("running"), F.col("grand_total"), a, b).alias("abc"),
    )


def abc_xyz(demand: DataFrame, products: DataFrame, stock: DataFrame) -> DataFrame:
    """Both classes of every SKU, with the product and stock columns the policy needs."""
    per_sku = demand_stats(demand).join(products, "sku")
    priced = per_sku.withColumn("revenue_total", F.col("demand_sum") * F.col("unit_price"))
    classed = xyz_classes(abc_classes(priced))
    return classed.withColumn("class", F.concat("abc", "xyz")).join(
        stock.select("sku", "stock_on_hand"), "sku"
    )


def inventory_policy(
    classed: DataFrame, z: float | Column = Z_SCORE, holding_rate: float = HOLDING_RATE
) -> DataFrame:
    """Safety stock, reorder point, order quantity, and the excess or deficit against them.

    A SKU with a single month has no deviation and gets no safety stock.
    """
    deviation = F.coalesce("demand_std", F.lit(0.0))
    months = F.col("lead_time_days") / F.lit(30.0)
    safety = not_below_zero(F.lit(z) * deviation * F.sqrt(months))
    reorder = F.col("demand_avg") * months + safety
    holding = zero_to_one(dbl("unit_cost") * holding_rate)
    quantity = F.sqrt(F.lit(2.0) * (F.col("demand_avg") * 12) * dbl("order_cost") / holding)

    def whole(c: Column) -> Column:
        return F.bround(not_below_zero(c), 0).cast("bigint")

    sized = classed.withColumns(
        {
            "safety_stock": whole(safety),
            "reorder_point": whole(reorder),
            "order_quantity": whole(quantity),
            "optimal_stock": whole(reorder + quantity / 2),
        }
    )
    # The comparison with the stock uses the rounded policy.
    stock, rop = F.col("stock_on_hand"), F.col("reorder_point")
    gap = sized.withColumns(
        {
            "excess_units": F.greatest(stock - (rop + F.col("order_quantity")), F.lit(0)).cast("bigint"),
            "deficit_units": F.greatest(rop - stock, F.lit(0)).cast("bigint"),
            "below_reorder_point": stock < rop,
        }
    )
    return gap.withColumns(
        {
            "tied_capital": F.col("excess_units") * F.col("unit_cost"),
            "sales_at_risk": F.col("deficit_units") * F.col("unit_price"),
        }
    )


def policy_by_service_level(
    classed: DataFrame, z_by_class: dict[str, float] | None = None, default_z: float = Z_SCORE
) -> DataFrame:
    """The policy with a service level per class."""
    z = rules.lookup(F.col("class"), z_by_class or Z_BY_CLASS, default_z)
    return inventory_policy(classed.withColumn("z_score", z), z=F.col("z_score"))


def abc_xyz_matrix(classed: DataFrame) -> DataFrame:
    return classed.groupBy("abc", "xyz").agg(
        F.count(F.lit(1)).alias("skus"), F.sum("revenue_total").alias("revenue")
    ).orderBy("abc", "xyz")


def abc_share(classed: DataFrame) -> DataFrame:
    """Share of products against share of revenue per class; empty classes stay."""
    classes = rules.value_rows(classed.sparkSession, "abc", ["A", "B", "C"])
    sums = classed.groupBy("abc").agg(
        F.count(F.lit(1)).alias("_skus"), F.sum("revenue_total").alias("_revenue")
    )
    # Three rows, so the totals need no partitioning.
    total = W.partitionBy()
    skus, revenue = F.coalesce("_skus", F.lit(0)), F.coalesce(dbl("_revenue"), F.lit(0.0))
    return classes.join(sums, "abc", "left").select(
        "abc",
        skus.alias("skus"),
        revenue.alias("revenue"),
        (ratio(skus, F.sum(skus).over(total)) * 100).alias("pct_skus"),
        (ratio(revenue, F.sum(revenue).over(total)) * 100).alias("pct_revenue"),
    ).orderBy("abc")


def stock_health(policy: DataFrame) -> DataFrame:
    counts = policy.agg(
        F.count(F.lit(1)).alias("skus"),
        count_where(F.col("excess_units") > 0).alias("overstock"),
        count_where(F.col("below_reorder_point")).alias("below_reorder_point"),
    )
    healthy = F.col("skus") - F.col("overstock") - F.col("below_reorder_point")
    return counts.withColumn("healthy", healthy).withColumn(
        "healthy_pct", F.bround(ratio("healthy", "skus") * 100, 1)
    )


def eoq_frequency(
    policy: DataFrame,
    orders_now: int = ORDERS_PER_YEAR_NOW,
    max_orders: int = MAX_ORDERS_PER_YEAR,
) -> DataFrame:
    """Orders per year now and at the best order quantity, and the saving per SKU."""
    annual = F.col("demand_avg") * 12
    best = F.least(annual / zero_to_one("order_quantity"), F.lit(float(max_orders)))
    saving = not_below_zero(dbl("order_cost") * (F.lit(orders_now) - best))
    return policy.withColumns(
        {"orders_now": F.lit(orders_now), "orders_optimal": best, "order_saving": saving}
    )


def eoq_saving_by_class(policy: DataFrame) -> DataFrame:
    """Optimal orders per year and saving per class."""
    return eoq_frequency(policy).groupBy("class").agg(
        F.count(F.lit(1)).alias("skus"),
        F.avg("orders_optimal").alias("orders_optimal_mean"),
        F.sum("order_saving").alias("order_saving"),
    ).orderBy("class")


def inventory_impact(
    policy: DataFrame,
    hours_per_month: float = HOURS_SAVED_PER_MONTH,
    hourly_cost: float = ANALYST_HOURLY_COST,
) -> DataFrame:
    """One row: tied capital, sales at risk, order saving, time saving, total and counts."""
    sums = eoq_frequency(policy).agg(
        F.coalesce(dbl(F.sum("tied_capital")), F.lit(0.0)).alias("tied_capital"),
        F.coalesce(dbl(F.sum("sales_at_risk")), F.lit(0.0)).alias("sales_at_risk"),
        F.coalesce(F.sum("order_saving"), F.lit(0.0)).alias("order_saving"),
        count_where(F.col("below_reorder_point")).alias("skus_below_reorder_point"),
        count_where(F.col("excess_units") > 0).alias("skus_overstock"),
    )
    time_saving = F.lit(float(hours_per_month * 12 * hourly_cost))
    total = F.col("tied_capital") + F.col("sales_at_risk") + F.col("order_saving") + time_saving
    return sums.withColumn("time_saving", time_saving).withColumn("total", total)


def class_with_policy(classification: DataFrame, policy: DataFrame) -> DataFrame:
    """Classification joined to the policy's flags by SKU."""
    return classification.join(policy.select("sku", "below_reorder_point", "excess_units"), "sku")


def top_overstock(policy: DataFrame, k: int = 10) -> DataFrame:
    return _top(policy, "tied_capital", k)


def top_stockout_risk(policy: DataFrame, k: int = 10) -> DataFrame:
    return _top(policy, "sales_at_risk", k)


def _top(policy: DataFrame, amount: str, k: int) -> DataFrame:
    return policy.where(F.col(amount) > 0).select("sku", amount).orderBy(F.desc(amount), "sku").limit(k)
