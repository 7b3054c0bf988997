"""Profitability of sale lines: products, customers and stores.

Sale lines carry ``ticket_id, sale_date, customer_id, product_id, store_id, qty, discount, revenue,
cost, margin``; each operator reads only the columns it needs.  Facts are aggregated by key first
(map-side partial sums absorb hot keys) and only the aggregated rows are joined to names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.functions.numeric import count_where, dbl, percent, ratio, sum_where
from bizops.operators.grouped import count_bits, grouped_once, id_word, total, visits
from bizops.operators.ordered import percentiles_by
from bizops.session import cut_lineage

# The middle of two averages in cents has a third decimal, so the gap to it is exact at three.
GAP_DECIMALS = 3


def discounted_price(lines: DataFrame) -> DataFrame:
    """Unit price after discount, rounded to cents."""
    return lines.withColumn("unit_price", F.round(F.col("list_price") * (1 - F.col("discount")), 2))


def line_margin(lines: DataFrame) -> DataFrame:
    """Revenue, cost and margin of each line at two decimals."""
    return lines.withColumns(
        {
            "revenue": F.round(F.col("unit_price") * F.col("qty"), 2),
            "cost": F.round(F.col("unit_cost") * F.col("qty"), 2),
        }
    ).withColumn("margin", F.round(F.col("revenue") - F.col("cost"), 2))


def negative_margin_lines(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("lines"), count_where(F.col("margin") < 0).alias("negative_lines")
    )


def in_period(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Half-open date slice ``[start, end)``; plain comparisons, so the filter reaches the scan.

    A table stored by month (a ``sale_month`` column, ``yyyy-MM``) is sliced by month as well, so
    folders outside the period are never listed for reading.
    """
    by_month = "sale_month" in df.columns
    if start:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
        if by_month:
            df = df.where(F.col("sale_month") >= start[:7])
    if end:
        df = df.where(F.col(col) < F.lit(end).cast("date"))
        if by_month:
            df = df.where(F.col("sale_month") <= end[:7])
    return df


def profile(sales: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """One row of control totals: table sizes, date range, revenue, margin, margin %.

    Lines without a margin are summed by product and priced after that, from its unit cost; those
    of an unknown product then have no margin.
    """

    def size(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    first = [
        F.count(F.lit(1)).alias("_lines"),
        F.min("sale_date").alias("_first"),
        F.max("sale_date").alias("_last"),
        F.sum("revenue").alias("_revenue"),
    ]
    if "margin" in sales.columns:
        sums = sales.agg(*first, F.sum("margin").alias("_margin"))
    else:
        per_product = sales.groupBy("product_id").agg(*first, F.sum("qty").alias("_units"))
        costs = products.select("product_id", "unit_cost")
        sums = per_product.join(costs, "product_id", "left").withColumn(
            "_margin", F.col("_revenue") - F.col("_units") * F.col("unit_cost")
        )
    totals = sums.agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("sale_lines"),
        F.min("_first").alias("first_date"),
        F.max("_last").alias("last_date"),
        F.sum("_revenue").alias("_revenue"),
        F.sum("_margin").alias("_margin"),
    )
    return totals.select(
        "sale_lines",
        "first_date",
        "last_date",
        size(customers).alias("customers"),
        size(products).alias("products"),
        size(stores).alias("stores"),
        F.round("_revenue", 0).alias("revenue"),
        F.round("_margin", 0).alias("margin"),
        percent("_margin", "_revenue").alias("margin_pct"),
    )


def margin_pct(sales: DataFrame, dim: str) -> DataFrame:
    """Margin as a percentage of revenue, under both rounding rules."""
    sums = sales.groupBy(dim).agg(F.sum("revenue").alias("_r"), F.sum("margin").alias("_m"))
    return sums.select(
        dim,
        percent("_m", "_r").alias("margin_pct"),
        F.bround(ratio("_m", "_r") * 100, 1).alias("margin_pct_half_even"),
    )


def _by_product(sales: DataFrame, products: DataFrame, *aggs) -> DataFrame:
    """Per-product sums joined to the product, with ``_margin`` filled in.

    Lines that carry a margin are summed.  Lines without cost are priced after the sum, from the
    product's unit cost: the same exact total, without a line-level join on a skewed product key.
    """
    on_line = "margin" in sales.columns
    sums = [F.sum("qty").alias("_units"), F.sum("revenue").alias("_revenue")]
    if on_line:
        sums.append(F.sum("margin").alias("_margin"))
    joined = sales.groupBy("product_id").agg(*sums, *aggs).join(products, "product_id")
    if on_line:
        return joined
    return joined.withColumn("_margin", F.col("_revenue") - F.col("_units") * F.col("unit_cost"))


def negative_margin_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Products whose total margin is negative and what fixing them would recover."""
    lines = F.sum("discounted_lines") if "discounted_lines" in sales.columns else F.count("discount")
    totals = _by_product(sales, products, F.sum("discount").alias("_discount"), lines.alias("_lines"))
    return (
        totals.select(
            "product_id",
            "product_name",
            "category",
            F.col("_units").alias("units"),
            F.round("_revenue", 2).alias("revenue"),
            F.round("_margin", 2).alias("margin"),
            # divided as decimals: an average of exactly half a thousandth rounds up
            F.round(F.try_divide(F.col("_discount"), F.col("_lines")), 3).alias("avg_discount"),
        )
        .where(F.col("margin") < 0)
        .withColumn("recoverable", F.abs("margin"))
        .orderBy("margin", "product_id")
    )


def slow_movers(
    sales: DataFrame,
    products: DataFrame,
    recent_from: str,
    recent_until: str | None = None,
    months: int = 6,
    cover_months: int = 3,
    limit: int = 8,
) -> DataFrame:
    """The ``limit`` products with the fewest units in the recent months and the capital they tie up."""
    recent = F.col("sale_date") >= F.lit(recent_from).cast("date")
    if recent_until:
        recent = recent & (F.col("sale_date") < F.lit(recent_until).cast("date"))
    rhythm = sales.groupBy("product_id").agg(
        F.sum("qty").alias("units_total"),
        sum_where(recent, "qty").alias("units_recent"),
        F.count_distinct(F.trunc("sale_date", "month")).alias("months_sold"),
    )
    return slowest(rhythm, products, months, cover_months, limit)


def slowest(rhythm: DataFrame, products: DataFrame, months: int = 6, cover_months: int = 3, limit: int = 8) -> DataFrame:
    """The products with the fewest units of ``rhythm``: units_total, units_recent and months_sold
    per product."""
    monthly = dbl("units_recent") / float(months)
    return (
        products.join(rhythm, "product_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "unit_cost",
            "units_total",
            "units_recent",
            "months_sold",
            F.round(monthly, 1).alias("units_per_month"),
            F.round(dbl("unit_cost") * monthly * cover_months, 0).alias("tied_capital"),
        )
        .orderBy("units_recent", "product_id")
        .limit(limit)
    )


def customer_activity(sales: DataFrame, base: tuple[str, str], following: tuple[str, str]) -> DataFrame:
    """Per customer: bought in the base period, bought in the following one, base-period margin."""
    known = sales.where(F.col("customer_id").isNotNull() & (within(base) | within(following)))
    return known.groupBy("customer_id").agg(*_activity(base, following, {}))


def within(period: tuple[str, str]) -> Column:
    """Sold in the half-open period."""
    d = F.col("sale_date")
    return (d >= F.lit(period[0]).cast("date")) & (d < F.lit(period[1]).cast("date"))


def _activity(base: tuple[str, str], following: tuple[str, str], scales: Mapping[str, int]) -> list[Column]:
    return [
        F.max(within(base)).alias("in_base"),
        F.max(within(following)).alias("in_following"),
        F.coalesce(total(F.when(within(base), F.col("margin")), scales.get("margin")), F.lit(0)).alias("margin_base"),
    ]


def customer_churn(sales: DataFrame, base: tuple[str, str], following: tuple[str, str]) -> DataFrame:
    """Customers active in the base period and absent in the following one, in one pass."""
    return churn_of(customer_activity(sales, base, following))


def churn_of(seen: DataFrame) -> DataFrame:
    """Churn from the activity of each customer."""
    lost = F.col("in_base") & ~F.col("in_following")
    totals = seen.agg(
        count_where(lost).alias("lost_customers"),
        count_where(F.col("in_base")).alias("base_customers"),
        F.sum(F.when(lost, F.col("margin_base"))).alias("_margin"),
    )
    return totals.select(
        "lost_customers",
        "base_customers",
        percent("lost_customers", "base_customers").alias("churn_pct"),
        F.round("_margin", 2).alias("margin_lost"),
    )


def churned_customer_list(
    sales: DataFrame, customers: DataFrame, base: tuple[str, str], following: tuple[str, str]
) -> DataFrame:
    """The lost customers with their details, most valuable first.

    "In the base set and not in the following one" is read off the per-customer flags: one pass
    over the fact instead of an anti join of the fact with itself, and null ids cannot interfere.
    """
    lost = customer_activity(sales, base, following).where(F.col("in_base") & ~F.col("in_following"))
    return (
        lost.select("customer_id", F.round("margin_base", 2).alias("margin_base"))
        .join(customers, "customer_id", "left")
        .orderBy(F.desc("margin_base"), "customer_id")
    )


def retained_customers(sales: DataFrame, base: tuple[str, str], following: tuple[str, str]) -> DataFrame:
    """Base-period margin of the customers that came back."""
    kept = customer_activity(sales, base, following).where(F.col("in_base") & F.col("in_following"))
    return kept.select("customer_id", F.round("margin_base", 2).alias("margin_base"))


def sales_of_members(sales: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """The sale lines of the given keys (semi join; each line once, whatever the list repeats)."""
    return sales.join(members.select(key), key, "left_semi")


def _store_sums(sales: DataFrame, *keys: str, scales: Mapping[str, int] = {}) -> DataFrame:
    """Tickets, revenue and margin by ``keys``; tickets are counted as mergeable words of bits."""
    block, bit = id_word(sales, "ticket_id")
    words = sales.groupBy(*keys, block.alias("_block")).agg(
        F.bit_or(bit).alias("_tickets"), *[total(c, scales.get(c)).alias(f"_{c}") for c in ("revenue", "margin")]
    )
    return _ticket_average(words, *keys)


def _ticket_average(words: DataFrame, *keys: str) -> DataFrame:
    return words.groupBy(*keys).agg(
        count_bits("_tickets").alias("tickets"), F.sum("_revenue").alias("_revenue"), F.sum("_margin").alias("_margin")
    ).withColumn("avg_ticket", F.round(ratio("_revenue", "tickets"), 2))


def store_ticket(sales: DataFrame, stores: DataFrame, scales: Mapping[str, int] = {}) -> DataFrame:
    """Customers, tickets, revenue, margin and average ticket per store, weakest first.

    ``scales`` names columns that hold whole units (see ``grouped.total``).
    """
    sums = visits(sales, "store_id", scales)
    return (
        sums.join(stores, "store_id")
        .select(
            "store_id",
            "store_name",
            "region",
            "customers",
            "tickets",
            F.round("_revenue", 0).alias("revenue"),
            F.round("_margin", 0).alias("margin"),
            F.round(ratio("_revenue", "tickets"), 2).alias("avg_ticket"),
        )
        .orderBy("avg_ticket", "store_id")
    )


def store_gap(sales: DataFrame, stores: DataFrame, months: int | Column, capture: float = 0.5,
              scales: Mapping[str, int] = {}) -> DataFrame:
    """Gap of each store's average ticket to the network median and the gain from closing part of it.

    ``gain`` covers the whole period of ``sales`` (``months`` long), ``gain_per_year`` a year of it.
    ``scales`` names columns that hold whole units (see ``grouped.total``).
    """
    return gaps_of(cut_lineage(_store_sums(sales, "store_id", scales=scales)), stores, months, capture)


def gaps_of(per_store: DataFrame, stores: DataFrame, months: int | Column, capture: float = 0.5) -> DataFrame:
    """Gaps from the sums of each store.  The network's median is one number per store to one task."""
    middle = per_store.agg(F.median("avg_ticket").alias("median"))
    share = per_store.agg(ratio(F.sum("_margin"), F.sum("_revenue")).alias("share"))
    placed = per_store.join(stores, "store_id").withColumns({"_median": middle.scalar(), "_share": share.scalar()})
    median = F.col("_median")
    shortfall = F.greatest(median - F.col("avg_ticket"), F.lit(0.0))
    gain = shortfall * F.col("tickets") * F.col("_share") * capture
    return placed.select(
        "store_id",
        "store_name",
        "tickets",
        "avg_ticket",
        median.alias("median_ticket"),
        F.round(F.col("avg_ticket") - median, GAP_DECIMALS).alias("gap"),
        percent(F.col("avg_ticket") - median, median).alias("gap_pct"),
        F.round(gain, 2).alias("gain"),
        F.round(gain * 12 / months, 2).alias("gain_per_year"),
    ).orderBy("gap", "store_id")


def store_gap_trend(sales: DataFrame, scales: Mapping[str, int] = {}) -> DataFrame:
    """Each store's gap to the median ticket of its month."""
    per_month = cut_lineage(
        _store_sums(sales.withColumn("month", F.trunc("sale_date", "month")), "month", "store_id", scales=scales)
    )
    medians = percentiles_by(per_month, "month", "avg_ticket", {"median_ticket": 0.5})
    gap = F.col("avg_ticket") - F.col("median_ticket")
    return per_month.join(medians, "month").select(
        "month",
        "store_id",
        "avg_ticket",
        "median_ticket",
        F.round(gap, GAP_DECIMALS).alias("gap"),
        percent(gap, "median_ticket").alias("gap_pct"),
    ).orderBy("month", "store_id")


def finding_sums(
    sales: DataFrame, base: tuple[str, str], following: tuple[str, str], recent: tuple[str, str],
    scales: Mapping[str, int] = {},
) -> dict[str, DataFrame]:
    """What the findings need, from one pass over the lines: ``products`` (sums, units of the recent
    months), ``customers`` (activity), ``stores`` (tickets and sums) and ``months`` (one row each).

    Lines are grouped by product, by customer, by store and block of tickets, and by month at once.
    ``scales`` names columns that hold whole units (see ``grouped.total``).
    """
    block, bit = id_word(sales, "ticket_id")
    rows = sales.withColumns({"_block": block, "_bit": bit, "_month": F.trunc("sale_date", "month")})
    sums = grouped_once(
        rows,
        {"products": ["product_id"], "customers": ["customer_id"], "stores": ["store_id", "_block"], "months": ["_month"]},
        F.sum("qty").alias("qty"), sum_where(within(recent), "qty").alias("units_recent"),
        *[total(c, scales.get(c)).alias(c) for c in ("revenue", "margin", "discount")], F.count("discount").alias("discounted_lines"),
        F.bit_or("_bit").alias("_tickets"), *_activity(base, following, scales),
    )
    renamed = sums["stores"].withColumnsRenamed({"revenue": "_revenue", "margin": "_margin"})
    active = sums["customers"].where(F.col("customer_id").isNotNull() & (F.col("in_base") | F.col("in_following")))
    return {
        "products": sums["products"].select("product_id", "qty", "units_recent", "revenue", "margin", "discount", "discounted_lines"),
        "customers": active.select("customer_id", "in_base", "in_following", "margin_base"),
        "stores": _ticket_average(renamed, "store_id"),
        "months": sums["months"].where("_month IS NOT NULL").select(F.col("_month").alias("month")),
    }
