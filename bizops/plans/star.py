"""Business views over the benchmark tables, built from only the columns a query asks for.

Costs, stock, lead times and machines do not exist in those tables and are derived from their
columns by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizops.functions.numeric import MONEY, sum_where
from bizops.operators.profit import in_period
from bizops.session import cut_lineage

COST_FACTOR_PCT = 150  # unit cost as a percentage of the retail price
UNITS = {"revenue": 4, "cost": 4, "margin": 4, "discount": 2}  # decimals of a sale line's whole units
SHEET_MONTHS = ["2001-02-01", "2001-03-01", "2001-04-01", "2001-05-01", "2001-06-01", "2001-07-01"]


class Star:
    """Lazily built views over the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One Parquet table, listed once per query."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def sales(self, *columns: str, start: str | None = None, end: str | None = None, how: str = "inner",
              units: bool = False) -> DataFrame:
        """Sale lines with just ``columns``; a source table is joined only if one of them needs it.

        ``start``/``end`` bound the sale date before the join, so the orders scan is pruned and the
        line join only sees matching orders.  ``how="left"`` keeps lines without an order, product or
        supplier, for the checks that look for them.  With ``units`` revenue, cost, margin and discount are
        whole units of the scales in ``UNITS``, for operators that sum them as such.
        """
        lines = self.table("lineitem")
        wanted = set(columns)
        qty = whole("l_quantity")
        gross = hundredths("l_extendedprice") * (100 - hundredths("l_discount"))  # in 1/10,000
        have = {
            "ticket_id": F.col("l_orderkey"),
            "product_id": F.col("l_partkey"),
            "line_number": F.col("l_linenumber"),
            "qty": qty,
            "discount": from_units(hundredths("l_discount"), 2, "decimal(4,2)"),
            "revenue": from_units(gross, 4, MONEY),
        }
        if start or end or wanted & {"sale_date", "customer_id"}:
            orders = self.table("orders").select(
                F.col("o_orderkey").alias("l_orderkey"),
                F.col("o_orderdate").cast("date").alias("sale_date"),
                F.col("o_custkey").alias("customer_id"),
            )
            lines = lines.join(in_period(orders, "sale_date", start, end), "l_orderkey", how)
            have |= {"sale_date": F.col("sale_date"), "customer_id": F.col("customer_id")}
        if wanted & {"unit_cost", "cost", "margin", "category", "list_price"}:
            parts = self.table("part").select(
                F.col("p_partkey").alias("l_partkey"),
                hundredths("p_retailprice").alias("_retail"),
                F.col("p_type").alias("category"),
            )
            lines = lines.join(parts, "l_partkey", how)
            cost = F.col("_retail") * COST_FACTOR_PCT * qty  # in 1/10,000
            have |= {
                "category": F.col("category"),
                "list_price": from_units(F.col("_retail") * 2, 2, "decimal(10,2)"),
                "unit_cost": from_units(F.col("_retail") * COST_FACTOR_PCT, 4, "decimal(14,4)"),
                "cost": from_units(cost, 4, MONEY),
                "margin": from_units(gross - cost, 4, MONEY),
            }
            if units:
                have |= {"cost": cost, "margin": gross - cost}
        if units:
            have |= {"revenue": gross, "discount": hundredths("l_discount")}
        if "store_id" in wanted:
            suppliers = self.table("supplier").select(
                F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_id")
            )
            lines = lines.join(suppliers, "l_suppkey", how)
            have["store_id"] = F.col("store_id")
        return lines.select(*[have[c].alias(c) for c in columns])

    def dates_of_sales(self) -> DataFrame:
        """The dates of the orders that have lines; of the lines only the order keys are read."""
        sold = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        return self.table("orders").join(sold, "o_orderkey", "left_semi").select(
            F.col("o_orderdate").cast("date").alias("sale_date")
        )

    def _nations(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", "n_name", "r_name")

    def customers(self) -> DataFrame:
        return self.table("customer").join(
            self._nations(), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )

    def stores(self) -> DataFrame:
        return self._nations().select(
            F.col("n_nationkey").alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("region"),
        )

    def products(self) -> DataFrame:
        price = hundredths("p_retailprice")
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            from_units(price, 2, "decimal(10,2)").alias("unit_price"),
            from_units(price * COST_FACTOR_PCT, 4, "decimal(14,4)").alias("unit_cost"),
            (5 + key % 16).alias("lead_time_days"),
            (1500 + (key % 85) * 100).alias("order_cost"),
            (F.col("p_size") * 5).alias("stock_policy"),
            F.col("p_size").alias("stock_coverage"),
        )

    def skus(self) -> DataFrame:
        return self.products().withColumnsRenamed({"product_id": "sku", "product_name": "name"})

    def stock(self) -> DataFrame:
        return self.products().select(
            F.col("product_id").alias("sku"), F.col("stock_policy").alias("stock_on_hand")
        )

    def demand(self) -> DataFrame:
        month = F.trunc("l_shipdate", "month").alias("month_start")
        return self.table("lineitem").groupBy(F.col("l_partkey").alias("sku"), month).agg(
            F.sum(whole("l_quantity")).alias("units")
        )

    def stock_sheet(self) -> DataFrame:
        """Six monthly sales columns and the last month with movement, for every product."""
        month = F.trunc("l_shipdate", "month")
        sold = self.table("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
            *[
                sum_where(month == F.lit(m).cast("date"), whole("l_quantity")).alias(f"_m{i}")
                for i, m in enumerate(SHEET_MONTHS, 1)
            ],
            F.max(month).alias("last_movement"),
        )
        months = [F.coalesce(f"_m{i}", F.lit(0)).alias(f"m{i}") for i in range(1, 7)]
        products = self.products().withColumnRenamed("stock_coverage", "stock")
        return products.join(sold, "product_id", "left").select(
            "product_id", "category", "stock", "unit_cost", *months, "last_movement"
        )

    def stoppages(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("stoppage_id"),
            F.col("ts").cast("date").alias("stop_date"),
            F.col("user_id").alias("machine_id"),
            F.when(kind == "signup", "planned").otherwise("unplanned").alias("stop_type"),
            F.when(kind == "signup", "planned")
            .when(kind == "error", "mechanical")
            .when(kind == "click", "electrical")
            .otherwise("operational")
            .alias("cause"),
            from_units(hundredths("value"), 2, "decimal(12,2)").alias("minutes"),
        )

    def machines(self) -> DataFrame:
        """One row per machine; derived from the event log once for all readers of a query."""
        if "machines" not in self._tables:
            uid = F.col("machine_id")
            ids = self.table("events").select(F.col("user_id").alias("machine_id")).distinct()
            self._tables["machines"] = cut_lineage(ids.select(
                "machine_id",
                (9800 + (uid % 48) * 100).alias("hourly_cost"),
                F.date_add(F.lit("2023-06-01").cast("date"), (uid % 300).cast("int")).alias("last_service"),
                (120 + 30 * (uid % 3)).alias("service_interval_days"),
                ((79 + uid % 16) / F.lit(100.0)).alias("performance"),
                ((95 + uid % 5) / F.lit(100.0)).alias("quality"),
            ))
        return self._tables["machines"]


def hundredths(col: str) -> Column:
    """A stored double with two decimals as whole hundredths; whole-number arithmetic stays exact
    and avoids the far slower double-to-decimal conversion on every line."""
    return F.rint(F.col(col) * 100).cast("bigint")


def whole(col: str) -> Column:
    return F.rint(col).cast("bigint")


def from_units(units: Column, scale: int, kind: str) -> Column:
    """Whole units of ``10^-scale`` as an exact decimal."""
    step = F.lit(f"0.{'1'.zfill(scale)}").cast(f"decimal({scale},{scale})")
    return (units.cast("decimal(18,0)") * step).cast(kind)
