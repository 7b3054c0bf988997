"""Every registered query: an operator applied to the business views, with a fixed output schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizops.functions import rules
from bizops.operators import abcxyz, coverage, downtime, impact, kpi, profit, quality, rfm
from bizops.plans.star import SHEET_MONTHS, UNITS, Star, from_units, hundredths, whole
from bizops.session import cut_lineage, scratch_path, tune
from bizops.sources import publish
from bizops.sources.load import clean_extract, load_inventory, load_plant, load_star, read_sheet
from bizops.sources.schemas import INVENTORY, MACHINE_RATES, PLANT, STAR, UNPLANNED_LABEL

BASE, NEXT = ("1999-01-01", "2000-01-01"), ("2000-01-01", "2001-01-01")
BOTH = {"start": BASE[0], "end": NEXT[1]}
RECENT = ("2001-02-01", "2001-08-01")
AS_OF = "2024-02-01"
SHEET_AS_OF = "2001-08-01"
AVAILABLE_HOURS = 720
CRITICAL_MACHINES = (3, 6, 7)
VALID_CATEGORIES = ("ECONOMY", "STANDARD", "PROMO")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(schema: str):
    """Register a function of the business views; ``schema`` gives the output columns and types."""
    columns = [c.split() for c in schema.split(",")]

    def register(build: Callable[[Star], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            star = Star(tune(spark), folder)
            df = build(star)
            return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns])

        QUERIES[build.__name__] = run
        return build

    return register


# ---------------------------------------------------------------- profitability


@query("ticket_id bigint, product_id bigint, line_number int, list_price double, discount double,"
       "unit_price double")
def discounted_price(s: Star):
    return profit.discounted_price(s.sales("ticket_id", "product_id", "line_number", "list_price", "discount"))


@query("ticket_id bigint, product_id bigint, line_number int, qty bigint, unit_price double,"
       "unit_cost double, revenue double, cost double, margin double")
def line_margin(s: Star):
    lines = s.sales("ticket_id", "product_id", "line_number", "qty", "list_price", "discount", "unit_cost")
    return profit.line_margin(profit.discounted_price(lines))


@query("lines bigint, negative_lines bigint")
def negative_margin_lines(s: Star):
    return profit.negative_margin_lines(s.sales("margin"))


@query("category string, margin_pct double, margin_pct_half_even double")
def margin_pct(s: Star):
    return profit.margin_pct(s.sales("category", "revenue", "margin"), "category")


@query("sale_lines bigint, first_date date, last_date date, customers bigint, products bigint,"
       "stores bigint, revenue double, margin double, margin_pct double")
def profile(s: Star):
    return profit.profile(s.sales("product_id", "sale_date", "qty", "revenue"), s.customers(), s.products(), s.stores())


@query("lines bigint, customers bigint, revenue double")
def period_slice(s: Star):
    lines = profit.in_period(s.sales("sale_date", "customer_id", "revenue"), "sale_date", *BASE)
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("revenue").alias("revenue"),
    )


def _negative_products(s: Star) -> DataFrame:
    return profit.negative_margin_products(s.sales("product_id", "qty", "discount", "revenue"), s.products())


@query("product_id bigint, product_name string, category string, units bigint, revenue double,"
       "margin double, avg_discount double, recoverable double")
def negative_margin_products(s: Star):
    return _negative_products(s)


def _slow_movers(s: Star) -> DataFrame:
    return profit.slow_movers(s.sales("product_id", "sale_date", "qty"), s.products(), *RECENT)


@query("product_id bigint, product_name string, category string, unit_cost double, units_total bigint,"
       "units_recent bigint, months_sold bigint, units_per_month double, tied_capital double")
def slow_movers(s: Star):
    return _slow_movers(s)


def _customer_sales(s: Star) -> DataFrame:
    return s.sales("customer_id", "sale_date", "margin", **BOTH)


@query("lost_customers bigint, base_customers bigint, churn_pct double, margin_lost double")
def customer_churn(s: Star):
    return profit.customer_churn(_customer_sales(s), BASE, NEXT)


@query("customer_id bigint, customer_name string, segment string, region string, margin_base double")
def churned_customer_list(s: Star):
    return profit.churned_customer_list(_customer_sales(s), s.customers(), BASE, NEXT)


@query("customer_id bigint, margin_base double")
def retained_customers(s: Star):
    return profit.retained_customers(_customer_sales(s), BASE, NEXT)


@query("store_id bigint, store_name string, region string, customers bigint, tickets bigint,"
       "revenue double, margin double, avg_ticket double")
def store_ticket(s: Star):
    return profit.store_ticket(
        s.sales("store_id", "customer_id", "ticket_id", "revenue", "margin", units=True), s.stores(), UNITS
    )


@query("segment string, lines bigint, revenue double")
def sales_of_members(s: Star):
    """Revenue of the customers of one region, by segment."""
    members = s.customers().where(F.col("region") == "EUROPE")
    lines = profit.sales_of_members(s.sales("customer_id", "revenue"), members, "customer_id")
    per_customer = lines.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_l"), F.sum("revenue").alias("_r"))
    return per_customer.join(members, "customer_id").groupBy("segment").agg(
        F.sum("_l").alias("lines"), F.sum("_r").alias("revenue")
    )


def _months(s: Star):
    """Months with sales, from the orders that have lines: no line is joined or priced for it."""
    return kpi.months_covered(s.dates_of_sales()).scalar()


@query("store_id bigint, store_name string, tickets bigint, avg_ticket double, median_ticket double,"
       "gap double, gap_pct double, gain double, gain_per_year double")
def store_gap(s: Star):
    return profit.store_gap(
        s.sales("store_id", "ticket_id", "revenue", "margin", units=True), s.stores(), _months(s), scales=UNITS)


@query("month date, store_id bigint, avg_ticket double, median_ticket double, gap double, gap_pct double")
def store_gap_trend(s: Star):
    return profit.store_gap_trend(s.sales("store_id", "sale_date", "ticket_id", "revenue", "margin", units=True), UNITS)


# ---------------------------------------------------------------- KPIs


@query("ticket_id bigint, product_id bigint, customer_id bigint, store_id bigint, period string,"
       "segment string, city string, region string, store_name string, region_store string,"
       "category string, qty bigint, revenue double, margin double")
def sales_enriched(s: Star):
    sales = s.sales(
        "ticket_id", "product_id", "customer_id", "store_id", "sale_date", "category", "qty", "revenue", "margin"
    )
    return kpi.sales_enriched(sales, s.customers(), s.stores(), s.products())


@query("period string, revenue double, margin double, tickets bigint, customers bigint,"
       "margin_pct double, avg_ticket double, revenue_change_pct double")
def monthly_kpis(s: Star):
    return kpi.monthly_kpis(s.sales("sale_date", "ticket_id", "customer_id", "revenue", "margin", units=True), scales=UNITS)


@query("period string, revenue double, margin double, tickets bigint, customers bigint, margin_pct double, avg_ticket double")
def yearly_kpis(s: Star):
    """The years, merged from monthly states that are kept as a table; the lines are read once for
    the months and not again for the years."""
    states = kpi.month_states(s.sales("sale_date", "ticket_id", "customer_id", "revenue", "margin", units=True), UNITS)
    path = scratch_path(s.spark, "states")
    publish.publish(states, path)
    return kpi.kpis_of_states(publish.read_published(s.spark, path), F.substring("month", 1, 4))


@query("period string, revenue double, previous_revenue double, change_pct double")
def mom_change(s: Star):
    return kpi.mom_change(s.sales("sale_date", "revenue"))


@query("store_name string, revenue double, margin double, tickets bigint, margin_pct double")
def kpis_by_store(s: Star):
    sales = s.sales("store_id", "ticket_id", "revenue", "margin")
    return kpi.kpis_by(sales.join(s.stores(), "store_id"), "store_name")


@query("category string, revenue double, margin double, tickets bigint, margin_pct double")
def kpis_by_category(s: Star):
    return kpi.kpis_by(s.sales("category", "ticket_id", "revenue", "margin"), "category")


# ---------------------------------------------------------------- RFM


def _scores(s: Star) -> DataFrame:
    return rfm.rfm_scores(s.sales("customer_id", "sale_date", "ticket_id", "revenue", "margin", units=True), UNITS)


@query("customer_id bigint, recency bigint, frequency bigint, monetary double, margin double,"
       "r int, f int, m int, fm int, segment string, action string")
def rfm_scores(s: Star):
    return rfm.best_first(_scores(s))


@query("segment string, customers bigint, margin_total double, monetary_mean double, pct_customers double")
def rfm_segment_summary(s: Star):
    return rfm.rfm_segment_summary(_scores(s))


@query("hours_saved bigint, hours_value double, customers_at_risk bigint, recoverable double,"
       "total_impact double")
def rfm_impact(s: Star):
    return rfm.rfm_impact(rfm.rfm_segment_summary(_scores(s)), kpi.months_covered(s.dates_of_sales()))


# ---------------------------------------------------------------- ABC-XYZ and stock policy


@query("sku bigint, revenue double")
def sku_revenue(s: Star):
    return abcxyz.sku_revenue(s.demand(), s.skus()).withColumnRenamed("revenue_total", "revenue")


@query("sku bigint, revenue double, revenue_share double, cumulative_share double, abc string")
def abc_classes(s: Star):
    classes = abcxyz.abc_classes(abcxyz.sku_revenue(s.demand(), s.skus()))
    return classes.withColumnRenamed("revenue_total", "revenue")


@query("sku bigint, demand_avg double, demand_std double, demand_sum bigint, cv double")
def demand_stats(s: Star):
    return abcxyz.demand_stats(s.demand())


@query("sku bigint, cv double, xyz string")
def xyz_classes(s: Star):
    return abcxyz.xyz_classes(abcxyz.demand_stats(s.demand()))


def _classed(s: Star) -> DataFrame:
    return abcxyz.abc_xyz(s.demand(), s.skus(), s.stock())


def _policy(s: Star) -> DataFrame:
    return abcxyz.inventory_policy(_classed(s))


def _six_places(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles differ in the last bits between engines and partitionings."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("sku bigint, name string, category string, abc string, xyz string, class string, cv double,"
       "revenue_total double, revenue_share double, cumulative_share double")
def abc_xyz(s: Star):
    return _classed(s)


@query("abc string, xyz string, skus bigint, revenue double")
def abc_xyz_matrix(s: Star):
    return abcxyz.abc_xyz_matrix(_classed(s))


@query("abc string, skus bigint, revenue double, pct_skus double, pct_revenue double")
def abc_share(s: Star):
    return _six_places(abcxyz.abc_share(_classed(s)), "pct_skus", "pct_revenue")


POLICY_SCHEMA = (
    "sku bigint, name string, category string, class string, demand_avg double, demand_std double,"
    "cv double, lead_time_days bigint, safety_stock bigint, reorder_point bigint,"
    "order_quantity bigint, stock_on_hand bigint, optimal_stock bigint, excess_units bigint,"
    "tied_capital double, deficit_units bigint, sales_at_risk double, below_reorder_point boolean"
)


@query(POLICY_SCHEMA)
def inventory_policy(s: Star):
    return _policy(s)


@query("sku bigint, class string, z_score double, safety_stock bigint, reorder_point bigint,"
       "order_quantity bigint, optimal_stock bigint, excess_units bigint, deficit_units bigint")
def policy_by_service_level(s: Star):
    return abcxyz.policy_by_service_level(_classed(s))


@query("sku bigint, class string, below_reorder_point boolean, excess_units bigint")
def class_with_policy(s: Star):
    policy = cut_lineage(_policy(s))
    return abcxyz.class_with_policy(policy.select(*abcxyz.CLASSIFICATION_COLUMNS), policy)


@query("skus bigint, overstock bigint, below_reorder_point bigint, healthy bigint, healthy_pct double")
def stock_health(s: Star):
    return abcxyz.stock_health(_policy(s))


@query("tied_capital double, sales_at_risk double, order_saving double, time_saving double,"
       "total double, skus_below_reorder_point bigint, skus_overstock bigint")
def inventory_impact(s: Star):
    df = abcxyz.inventory_impact(_policy(s))
    return df.withColumns({c: F.round(c, 2) for c in ("order_saving", "total")})


@query("sku bigint, orders_now bigint, orders_optimal double, order_saving double")
def eoq_frequency(s: Star):
    return abcxyz.eoq_frequency(_policy(s))


@query("class string, skus bigint, orders_optimal_mean double, order_saving double")
def eoq_saving_by_class(s: Star):
    df = abcxyz.eoq_saving_by_class(_policy(s))
    return df.withColumns({c: F.round(c, 2) for c in ("orders_optimal_mean", "order_saving")})


@query("sku bigint, tied_capital double")
def top_overstock(s: Star):
    return abcxyz.top_overstock(_policy(s))


@query("sku bigint, sales_at_risk double")
def top_stockout_risk(s: Star):
    return abcxyz.top_stockout_risk(_policy(s))


# ---------------------------------------------------------------- stock coverage


def _covered(s: Star) -> DataFrame:
    return coverage.stock_coverage(s.stock_sheet())


@query("product_id bigint, category string, stock bigint, mean_monthly double, cover_days double,"
       "state string, action string")
def stock_coverage(s: Star):
    return _covered(s)


@query("product_id bigint, cover_days double, turnover double, capital double, state string,"
       "stockout_alert boolean, days_without_movement bigint, action string")
def stock_kpis(s: Star):
    return coverage.stock_kpis(s.stock_sheet(), SHEET_AS_OF)


@query("product_id bigint, sales bigint, share double")
def pct_of_total(s: Star):
    return coverage.pct_of_total(s.stock_sheet())


@query("product_id bigint, mean_monthly double, abc string")
def coverage_abc(s: Star):
    return coverage.coverage_abc(s.stock_sheet())


@query("state string, products bigint, capital double")
def coverage_state_counts(s: Star):
    return coverage.coverage_state_counts(_covered(s))


@query("category string, capital double")
def capital_by_category(s: Star):
    return coverage.capital_by_category(_covered(s))


@query("dead_products bigint, dead_capital double, total_capital double, dead_pct double")
def dead_stock_capital(s: Star):
    return coverage.dead_stock_capital(_covered(s))


@query("month string, sales bigint")
def monthly_sales_trend(s: Star):
    labels = {f"m{i}": month[:7] for i, month in enumerate(SHEET_MONTHS, 1)}
    return coverage.monthly_sales_trend(s.stock_sheet(), labels)


@query("product_id bigint, category string, capital double, state string")
def top_capital(s: Star):
    return coverage.top_capital(_covered(s))


@query("priority int, alert string, product_id bigint, category string, cover_days double,"
       "stock bigint, capital double, action string")
def stock_alerts(s: Star):
    return coverage.stock_alerts(_covered(s))


@query("product_id bigint, label string, state string")
def state_from_label(s: Star):
    """Labels with one state, with two (the first in the list of states counts) and with none."""
    named = F.concat(F.lit("* "), F.lower("category"), F.lit(" - "), F.col("state"), F.lit(" !"))
    label = (
        F.when(F.col("product_id") % 5 == 0, F.lower("category"))
        .when(F.col("product_id") % 5 == 1, F.concat(F.lit("NORMAL / "), named))
        .otherwise(named)
    )
    return _covered(s).withColumn("label", label).withColumn("state", rules.state_from_label(F.col("label")))


@query("product_id string, category string, price double, size double")
def clean_extract_parts(s: Star):
    """The parts list written as sheet exports and read back: text cells under a header line.

    The parts table is clean, so by a part's size some keys are blanked and some prices made text.
    """
    path = scratch_path(s.spark, "sheet")
    large = F.col("p_size") > 40
    cells = s.table("part").select(
        F.when(F.col("p_size") % 10 == 3, F.lit("  ")).otherwise(F.col("p_partkey").cast("string")).alias("Code"),
        F.col("p_type").alias("Category"),
        F.when(large, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string")).alias("Price"),
        F.col("p_size").cast("string").alias("Size"),
    )
    cells.write.option("header", True).csv(path)
    sheet = read_sheet(s.spark, path)
    return clean_extract(sheet, "Code", "Category", VALID_CATEGORIES, ["Price", "Size"]).select(
        F.col("Code").alias("product_id"), F.col("Category").alias("category"),
        F.col("Price").alias("price"), F.col("Size").alias("size"),
    )


def _as_files(s: Star, tables: dict[str, DataFrame], schema: dict) -> str:
    """Write tables, whose columns have the operators' names, as the CSV files the readers expect."""
    folder = scratch_path(s.spark, "files")
    for name, table in schema.items():
        cells = [
            (F.col(own) if own in tables[name].columns else F.lit(None)).cast("string").alias(column)
            for column, (own, _) in table.columns.items()
        ]
        tables[name].select(*cells).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


@query("store_id string, store_name string, lines bigint, customers bigint, first_date date, revenue double, margin double, thin_products bigint")
def loaded_star(s: Star):
    """Sales, customers, products and stores written as CSV files, read back typed and summed by store."""
    lines = s.sales("ticket_id", "sale_date", "customer_id", "product_id", "store_id", "qty", "discount", "unit_cost", "revenue", "cost", "margin")
    products = s.products().select(
        "product_id", "product_name", "category", "unit_cost", F.col("unit_price").alias("list_price"),
        (F.col("product_id") % 3 == 0).alias("is_thin_margin"), F.lit(False).alias("is_slow_mover"))
    folder = _as_files(s, {"ventas": lines, "clientes": s.customers(), "productos": products, "sucursales": s.stores()}, STAR)
    t = load_star(s.spark, folder, fmt="csv")
    # Hardly two lines have store, product and customer in common, so they are joined as they are.  The
    # customers come last: the lines of one are in one task then and meet before they are counted.
    lines = t["sales"].select("store_id", "product_id", "customer_id", "sale_date", "revenue", "margin")
    named = lines.join(t["products"].select("product_id", "is_thin_margin"), "product_id").join(t["customers"].select("customer_id"), "customer_id")
    sums = named.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("customer_id").alias("customers"), F.min("sale_date").alias("first_date"),
        F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
        F.count_distinct(F.when(F.col("is_thin_margin"), F.col("product_id"))).alias("thin_products"))
    return sums.join(t["stores"].select("store_id", "store_name"), "store_id")


@query("sku string, name string, months bigint, units bigint, first_month date, stock_on_hand int, lead_time_days int")
def loaded_inventory(s: Star):
    """Products, monthly demand and stock written as CSV files and read back typed."""
    demand = s.demand().select("sku", F.date_format("month_start", "yyyy-MM").alias("month"), "units")
    folder = _as_files(s, {"productos": s.skus(), "demanda_mensual": demand, "inventario_actual": s.stock()}, INVENTORY)
    t = load_inventory(s.spark, folder)
    sold = t["demand"].groupBy("sku").agg(
        F.count(F.lit(1)).alias("months"), F.sum("units").alias("units"), F.min("month_start").alias("first_month"))
    return t["products"].join(sold, "sku").join(t["stock"], "sku")


@query("machine_id bigint, hours double, hourly_cost bigint, rated boolean")
def loaded_plant(s: Star):
    """Machines and stoppages written as CSV files, read back with labels, minutes and rates."""
    names = F.array(*[F.lit(n) for n in [*MACHINE_RATES, "unrated"]])
    machines = s.machines().withColumn("machine_name", F.element_at(names, (F.col("machine_id") % (len(MACHINE_RATES) + 1) + 1).cast("int")))
    label = F.when(F.col("stop_type") == downtime.UNPLANNED, UNPLANNED_LABEL).otherwise(F.lit("Programado"))
    stoppages = s.stoppages().withColumns({"stop_type": label, "hours": F.round(F.col("minutes") / 60, 2)})
    t = load_plant(s.spark, _as_files(s, {"equipos": machines, "registro_paros": stoppages}, PLANT))
    hours = downtime.downtime_by_machine(t["stoppages"], t["machines"])
    return hours.withColumn("rated", F.col("performance").isNotNull())


# ---------------------------------------------------------------- downtime


@query("machine_id bigint, last_service date, next_service date, days_left bigint")
def next_service(s: Star):
    return downtime.next_service(s.machines(), AS_OF)


@query("machine_id bigint, days_left bigint, light string")
def service_light(s: Star):
    return downtime.service_light(s.machines(), AS_OF)


@query("stoppage_id bigint, machine_id bigint, minutes double, hourly_cost bigint, cost double")
def stoppage_cost(s: Star):
    return downtime.stoppage_cost(s.stoppages(), s.machines())


@query("stoppage_id bigint, stop_date date, machine_id bigint, cause string, minutes double")
def unplanned_stoppages(s: Star):
    return downtime.unplanned(s.stoppages())


@query("machine_id bigint, hours double")
def downtime_by_machine(s: Star):
    return downtime.downtime_by_machine(s.stoppages(), s.machines())


@query("machine_id bigint, hours double, availability double, oee double, rating string")
def oee(s: Star):
    return downtime.oee(s.stoppages(), s.machines(), AVAILABLE_HOURS)


@query("hours double, cost double, events bigint, mean_oee double")
def downtime_kpis(s: Star):
    machines = s.machines()
    costed = downtime.stoppage_cost(s.stoppages(), machines)
    return _six_places(downtime.downtime_kpis(costed, machines, AVAILABLE_HOURS), "mean_oee")


@query("critical_hours double, total_hours double, share double")
def critical_share(s: Star):
    return downtime.critical_share(s.stoppages(), CRITICAL_MACHINES)


@query("critical_hours double, share double")
def critical_share_top(s: Star):
    return _six_places(downtime.critical_share_top(s.stoppages(), 3), "critical_hours")


@query("month string, stop_type string, cause string, events bigint, hours double")
def monthly_stoppages(s: Star):
    return downtime.monthly_stoppages(s.stoppages(), "stop_type", "cause")


@query("machine_id bigint, rank bigint, hours double, share double, cumulative_share double, plan string")
def downtime_pareto_machine(s: Star):
    return downtime.downtime_pareto_machine(s.stoppages())


@query("cause string, rank bigint, hours double, share double, cumulative_share double, label string")
def downtime_pareto_cause(s: Star):
    return downtime.downtime_pareto_cause(s.stoppages())


# ---------------------------------------------------------------- impact


@query("recoverable double, impact double")
def impact_negative_margin(s: Star):
    return impact.impact_negative_margin(_negative_products(s), _months(s))


@query("impact double, impact_per_year double")
def impact_slow_movers(s: Star):
    return impact.impact_slow_movers(_slow_movers(s))


@query("margin_lost double, impact double")
def impact_churn(s: Star):
    return impact.impact_churn(profit.customer_churn(_customer_sales(s), BASE, NEXT))


@query("rank int, finding string, impact double, share double, cumulative_share double, total double")
def findings_ranked(s: Star):
    """All findings come from one pass over the joined lines."""
    sales = s.sales("product_id", "customer_id", "store_id", "ticket_id", "sale_date", "qty", "discount", "revenue", "margin", units=True)
    sums = profit.finding_sums(sales, BASE, NEXT, RECENT, UNITS)
    months = sums["months"].agg(F.count(F.lit(1)).alias("months")).scalar()
    negative = profit.negative_margin_products(sums["products"], s.products())
    rhythm = sums["products"].select("product_id", F.col("qty").alias("units_total"), "units_recent", F.lit(None).alias("months_sold"))
    gaps = profit.gaps_of(sums["stores"], s.stores(), months)
    ranked = impact.findings_ranked(
        {
            "negative_margin": impact.impact_negative_margin(negative, months),
            "churn": impact.impact_churn(profit.churn_of(sums["customers"])),
            "store_gap": impact.impact_store_gap(gaps),
            "slow_movers": impact.impact_slow_movers(profit.slowest(rhythm, s.products())),
        }
    )
    return _six_places(ranked, "share", "cumulative_share", "total")


@query("hours double, hours_saved double, weighted_hourly_cost double, saving double")
def preventive_saving(s: Star):
    saving = impact.preventive_saving(s.stoppages(), s.machines())
    return _six_places(saving, "hours", "hours_saved", "weighted_hourly_cost", "saving")


@query("cause string, hours double, hours_saved double, saving double")
def cause_reduction_saving(s: Star):
    return _six_places(
        impact.cause_reduction_saving(s.stoppages(), "mechanical"), "hours", "hours_saved", "saving"
    )


# ---------------------------------------------------------------- data quality


@query("relation string, orphan_rows bigint")
def orphan_keys(s: Star):
    pairs = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ]
    counted = {}
    for fact in ("lineitem", "orders"):  # each table is read once, for all its keys
        keys = [fk for f, fk, _, _ in pairs if f == fact]
        counted[fact] = cut_lineage(quality.key_counts(s.table(fact), keys))
    rows = []
    for fact, fk, dim, dk in pairs:
        known = counted[dim].where(F.col("kind") == dk).select("key") if dim in counted and dk in ("l_orderkey", "o_orderkey") else s.table(dim).select(F.col(dk).alias("key"))
        orphans = quality.orphan_rows(counted[fact].where(F.col("kind") == fk), known)
        rows.append(orphans.withColumn("relation", F.lit(f"{fact}.{fk}->{dim}")))
    return reduce(DataFrame.unionByName, rows)


@query("rule string, failing_rows bigint")
def quality_report(s: Star):
    """The rules on the lines as they are, those without an order included; a unit price is the
    line's price in whole cents, so price times quantity misses the revenue by up to a cent a piece."""
    cents = F.call_function("div", hundredths("l_extendedprice"), whole("l_quantity"))
    sales = s.table("lineitem").join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        whole("l_quantity").cast("decimal(5,0)").alias("qty"),
        from_units(cents, 2, "decimal(12,2)").alias("unit_price"),
        from_units(hundredths("l_extendedprice"), 2, "decimal(14,2)").alias("revenue"),
    )
    return quality.quality_report(sales, s.customers())


@query("total string, expected double, actual double, difference double")
def control_totals(s: Star):
    """The sums by store against the sum of all lines, both from one pass over the fact."""
    sums = quality.rolled_totals(s.sales("store_id", "revenue", "margin"), "store_id")
    return quality.control_totals(*sums)


@query("check string, rows bigint")
def date_range_check(s: Star):
    """The fact is joined once, lines without an order included, and reduced to its dates and
    distinct keys."""
    sales = s.sales("sale_date", "customer_id", "product_id", "store_id", how="left")
    keys = ["sale_date", "customer_id", "product_id", "store_id"]
    counted = cut_lineage(quality.key_counts(sales, keys))
    used = lambda k: counted.where(F.col("kind") == k).select(F.col("key").alias(k))
    dates = counted.where(F.col("kind") == "sale_date").select(F.col("key").cast("date").alias("sale_date"), "rows")
    return quality.check_report(
        {
            "dates_out_of_range": quality.dates_out_of_range(dates, BASE[0], NEXT[1], "rows"),
            "customers_without_sales": quality.unused_members(s.customers(), used("customer_id"), "customer_id"),
            "products_without_sales": quality.unused_members(s.products(), used("product_id"), "product_id"),
            "stores_without_sales": quality.unused_members(s.stores(), used("store_id"), "store_id"),
        }
    )


# ---------------------------------------------------------------- publishing and reading back


@query("sale_month string, lines bigint, revenue double")
def saved_star_slice(s: Star):
    """Persist the priced fact by month, then read one year back from its folders alone."""
    path = scratch_path(s.spark, "star")
    publish.save_star({"sales": s.sales("ticket_id", "sale_date", "revenue"), "stores": s.stores()}, path)
    year = profit.in_period(publish.read_star(s.spark, path, ["sales"])["sales"], "sale_date", *BASE)
    return year.groupBy("sale_month").agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))


@query("period string, cause string, events bigint, hours double")
def monthly_snapshot(s: Star):
    """Freeze two monthly reports below one folder and read both back."""
    path = scratch_path(s.spark, "snapshot")
    for as_of in ("2024-02-20", "2024-03-20"):
        report = downtime.monthly_stoppages(s.stoppages(), "cause")
        publish.snapshot(report.where(F.col("month") <= publish.previous_month(as_of)), path, as_of)
    return publish.read_snapshots(s.spark, path)


@query("table string, sku bigint, class string, revenue double, order_quantity bigint, tied_capital double,"
       "sales_at_risk double")
def published_inventory(s: Star):
    """Write the classification and policy tables and read their contents back."""
    path = scratch_path(s.spark, "inventory")
    publish.publish_inventory(_policy(s), path, "parquet")
    classes, policy = (publish.read_published(s.spark, path, t) for t in ("classification", "policy"))
    return classes.select(
        F.lit("classification").alias("table"), "sku", "class", F.col("revenue_total").cast("double").alias("revenue")
    ).unionByName(
        policy.select(F.lit("policy").alias("table"), "sku", "class", "order_quantity",
                      F.col("tied_capital").cast("double").alias("tied_capital"),
                      F.col("sales_at_risk").cast("double").alias("sales_at_risk")),
        allowMissingColumns=True,
    )


@query("report string, entry string, customers bigint, tickets bigint, revenue double, margin double")
def published_report(s: Star):
    """Publish the five report tables, all from one pass over the lines, and read them back."""
    path = scratch_path(s.spark, "report")
    sales = s.sales("store_id", "category", "customer_id", "ticket_id", "sale_date", "revenue", "margin", units=True)
    sums = kpi.report_sums(sales, ["store_id", "category"], UNITS)
    scores = cut_lineage(rfm.scores_of(sums["customers"]))
    publish.publish_report(
        {
            "monthly": kpi.monthly_of(sums["months"]),
            "by_store": kpi.kpis_of(sums["store_id"].join(s.stores(), "store_id"), "store_name"),
            "by_category": kpi.kpis_of(sums["category"], "category"),
            "segments": rfm.rfm_segment_summary(scores),
            "customers": rfm.best_first(scores),
        },
        path,
    )
    contents = {
        "monthly": {"entry": "period", "customers": "customers", "tickets": "tickets", "revenue": "revenue", "margin": "margin"},
        "by_store": {"entry": "store_name", "tickets": "tickets", "revenue": "revenue", "margin": "margin"},
        "by_category": {"entry": "category", "tickets": "tickets", "revenue": "revenue", "margin": "margin"},
        "segments": {"entry": "segment", "customers": "customers", "margin": "margin_total"},
        "customers": {"entry": "customer_id", "tickets": "frequency", "revenue": "monetary", "margin": "margin"},
    }
    wanted = {"entry": "string", "customers": "bigint", "tickets": "bigint", "revenue": "double", "margin": "double"}
    parts = [
        publish.read_published(s.spark, path, name).select(
            F.lit(name).alias("report"),
            *[(F.col(found[c]) if c in found else F.lit(None)).cast(kind).alias(c) for c, kind in wanted.items()],
        )
        for name, found in contents.items()
    ]
    return reduce(DataFrame.unionByName, parts)
