"""Commercial KPIs over the enriched sales table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.functions.numeric import dbl, percent_even, ratio
from bizops.operators.grouped import count_bits, grouped_once, id_word, total, visits
from bizops.session import cut_lineage


def period(col: str = "sale_date") -> Column:
    return F.date_format(col, "yyyy-MM")


def sales_enriched(
    sales: DataFrame, customers: DataFrame, stores: DataFrame, products: DataFrame
) -> DataFrame:
    """Sale lines with customer, store, category and month; lines without a match are kept.

    No join is hinted: Spark broadcasts a dimension only when its size statistics allow it, and
    otherwise shuffles and splits hot keys at run time.
    """
    places = stores.select("store_id", "store_name", F.col("region").alias("region_store"))
    named = sales.join(customers, "customer_id", "left").join(places, "store_id", "left")
    if "category" not in sales.columns:  # lines that were priced from their product already have it
        named = named.join(products.select("product_id", "category"), "product_id", "left")
    return named.withColumn("period", period())


def months_covered(sales: DataFrame) -> DataFrame:
    """One row: number of distinct months with sales."""
    return sales.agg(F.count_distinct(F.trunc("sale_date", "month")).alias("months"))


def monthly_kpis(sales: DataFrame, pct_decimals: int = 1, scales: Mapping[str, int] = {}) -> DataFrame:
    """Revenue, margin, tickets, customers, margin %, average ticket and change on the month before.

    ``pct_decimals=0`` rounds the percentages a second time, to whole numbers.  ``scales`` names
    columns that hold whole units (see ``grouped.total``).
    """
    return monthly_of(visits(sales.withColumn("_month", F.trunc("sale_date", "month")), "_month", scales), pct_decimals)


def monthly_of(per_month: DataFrame, pct_decimals: int = 1) -> DataFrame:
    """The monthly table from each month's _revenue, _margin, tickets and customers."""
    return (
        with_change(per_month, "_month", "_revenue")
        .select(
            F.date_format("_month", "yyyy-MM").alias("period"),
            F.bround(dbl("_revenue"), 0).alias("revenue"),
            F.bround(dbl("_margin"), 0).alias("margin"),
            "tickets",
            "customers",
            F.bround(percent_even("_margin", "_revenue"), pct_decimals).alias("margin_pct"),
            F.bround(ratio("_revenue", "tickets"), 0).alias("avg_ticket"),
            F.bround(F.bround("_change", 1), pct_decimals).alias("revenue_change_pct"),
        )
        .orderBy("period")
    )


def with_change(per_month: DataFrame, month: str, value: str) -> DataFrame:
    """Adds ``_previous`` and ``_change`` (% on the row before).

    The window has one row per calendar month, so it needs no partitioning.
    """
    previous = F.lag(dbl(value)).over(W.orderBy(month))
    return per_month.withColumn("_previous", previous).withColumn(
        "_change", (ratio(value, "_previous") - 1) * 100
    )


def mom_change(sales: DataFrame) -> DataFrame:
    """Month-over-month revenue change in percent; the first month has none."""
    per_month = sales.groupBy(F.trunc("sale_date", "month").alias("_month")).agg(
        F.sum("revenue").alias("_revenue")
    )
    return (
        with_change(per_month, "_month", "_revenue")
        .select(
            F.date_format("_month", "yyyy-MM").alias("period"),
            dbl("_revenue").alias("revenue"),
            F.col("_previous").alias("previous_revenue"),
            F.bround("_change", 1).alias("change_pct"),
        )
        .orderBy("period")
    )


def kpis_by(df: DataFrame, dim: str, pct_decimals: int = 1) -> DataFrame:
    """Revenue, margin, tickets and margin % for any dimension column, largest revenue first.

    Tickets are counted as words of bits, so lines are combined on the map side.
    """
    block, bit = id_word(df, "ticket_id")
    words = df.groupBy(dim, block.alias("_block")).agg(
        F.sum("revenue").alias("_revenue"), F.sum("margin").alias("_margin"), F.bit_or(bit).alias("_tickets")
    )
    return kpis_of(words, dim, pct_decimals)


def kpis_of(words: DataFrame, dim: str, pct_decimals: int = 1) -> DataFrame:
    """The table of a dimension from sums by its values, or finer ones, and blocks of tickets."""
    merged = words.groupBy(dim, "_block").agg(
        F.sum("_revenue").alias("_revenue"), F.sum("_margin").alias("_margin"), F.bit_or("_tickets").alias("_tickets")
    )
    sums = merged.groupBy(dim).agg(
        F.sum("_revenue").alias("_revenue"), F.sum("_margin").alias("_margin"), count_bits("_tickets").alias("tickets")
    )
    return sums.orderBy(F.desc("_revenue"), dim).select(
        dim,
        F.bround(dbl("_revenue"), 0).alias("revenue"),
        F.bround(dbl("_margin"), 0).alias("margin"),
        "tickets",
        F.bround(percent_even("_margin", "_revenue"), pct_decimals).alias("margin_pct"),
    )


def report_sums(sales: DataFrame, dims: list[str], scales: Mapping[str, int] = {}) -> dict[str, DataFrame]:
    """What the commercial report needs, from one pass over the lines: ``months`` (_month, _revenue,
    _margin, tickets, customers), ``customers`` (last_date, frequency, monetary, margin) and, for each
    of ``dims``, sums by its values and blocks of tickets."""
    ticket, ticket_bit = id_word(sales, "ticket_id")
    buyer, buyer_bit = id_word(sales, "customer_id")
    rows = sales.withColumns({
        "_month": F.trunc("sale_date", "month"), "_block": ticket, "_ticket": ticket_bit, "_buyers": buyer, "_buyer": buyer_bit,
    })
    sums = grouped_once(
        rows,
        {"tickets": ["_month", "_block"], "buyers": ["_month", "_buyers"], "customers": ["customer_id", "_block"]}
        | {d: [d, "_block"] for d in dims},
        *[total(c, scales.get(c)).alias(f"_{c}") for c in ("revenue", "margin")], F.max("sale_date").alias("_last"),
        F.bit_or("_ticket").alias("_tickets"), F.bit_or("_buyer").alias("_buyer_bits"),
    )
    buyers = sums["buyers"].groupBy(F.col("_month").alias("_of")).agg(count_bits("_buyer_bits").alias("customers"))
    months = sums["tickets"].groupBy("_month").agg(
        F.sum("_revenue").alias("_revenue"), F.sum("_margin").alias("_margin"), count_bits("_tickets").alias("tickets"))
    customers = sums["customers"].where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        F.max("_last").alias("last_date"), count_bits("_tickets").alias("frequency"),
        F.sum("_revenue").alias("monetary"), F.sum("_margin").alias("margin"))
    return {d: sums[d] for d in dims} | {
        "months": months.join(buyers, F.col("_month").eqNullSafe(F.col("_of"))).drop("_of"), "customers": cut_lineage(customers),
    }


def month_states(sales: DataFrame, scales: Mapping[str, int] = {}) -> DataFrame:
    """What the KPIs of a period are made of, by month: month, kind, block, bits, revenue, margin.

    Rows of the kind ``ticket`` hold the sums and the tickets of a block of ids as bits, those of the
    kind ``customer`` the customers.  States of different lines merge (``kpis_of_states``), so a new
    month is read once and a year is made of its months' states.
    """
    ticket, ticket_bit = id_word(sales, "ticket_id")
    buyer, buyer_bit = id_word(sales, "customer_id")
    rows = sales.withColumns({
        "month": F.date_format("sale_date", "yyyy-MM"), "_t": ticket, "_tb": ticket_bit, "_c": buyer, "_cb": buyer_bit,
    })
    sums = grouped_once(
        rows, {"ticket": ["month", "_t"], "customer": ["month", "_c"]},
        *[total(c, scales.get(c)).alias(c) for c in ("revenue", "margin")], F.bit_or("_tb").alias("_tb"), F.bit_or("_cb").alias("_cb"),
    )
    money = lambda c, own: (F.col(c) if own else F.lit(None)).cast("decimal(38,4)").alias(c)
    kinds = [("ticket", "_t", "_tb"), ("customer", "_c", "_cb")]
    parts = [
        sums[kind].select("month", F.lit(kind).alias("kind"), F.col(block).cast("string").alias("block"), F.col(bits).alias("bits"),
                          money("revenue", kind == "ticket"), money("margin", kind == "ticket"))
        for kind, block, bits in kinds
    ]
    return parts[0].unionByName(parts[1])


def kpis_of_states(states: DataFrame, period: Column, pct_decimals: int = 1) -> DataFrame:
    """Revenue, margin, tickets, customers, margin % and average ticket of any period of whole months.

    The states may come from several runs: equal blocks of a period are merged, so a ticket or a
    customer of two months counts once.
    """
    merged = states.groupBy(period.alias("period"), "kind", "block").agg(
        F.bit_or("bits").alias("bits"), F.sum("revenue").alias("_revenue"), F.sum("margin").alias("_margin"))
    ids = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("bits"))), F.lit(0))
    sums = merged.groupBy("period").agg(
        F.sum("_revenue").alias("_revenue"), F.sum("_margin").alias("_margin"), ids("ticket").alias("tickets"), ids("customer").alias("customers"))
    return sums.orderBy("period").select(
        "period",
        F.bround(dbl("_revenue"), 0).alias("revenue"),
        F.bround(dbl("_margin"), 0).alias("margin"),
        "tickets",
        "customers",
        F.bround(percent_even("_margin", "_revenue"), pct_decimals).alias("margin_pct"),
        F.bround(ratio("_revenue", "tickets"), 0).alias("avg_ticket"),
    )
