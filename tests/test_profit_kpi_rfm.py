"""Commercial operators on small hand-made tables, with the edges that large data rarely shows."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bizops.operators import impact, kpi, profit, quality, rfm

SALES = ("ticket_id bigint, sale_date date, customer_id string, product_id string, store_id string,"
         "qty int, unit_price decimal(14,2), discount decimal(4,2), revenue decimal(16,2),"
         "cost decimal(16,2), margin decimal(16,2)")
BASE, NEXT = ("2024-01-01", "2025-01-01"), ("2025-01-01", "2026-01-01")


def line(ticket, day, customer, product, store, qty, price, cost, discount="0.00"):
    revenue, total = D(price) * qty, D(cost) * qty
    return (ticket, date.fromisoformat(day), customer, product, store, qty, D(price), D(discount),
            revenue, total, revenue - total)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [
            line(1, "2024-01-10", "C1", "P1", "S1", 2, "10.00", "4.00"),
            line(1, "2024-01-10", "C1", "P2", "S1", 1, "5.00", "6.00", "0.20"),
            line(2, "2024-02-05", "C2", "P1", "S2", 1, "10.00", "4.00"),
            line(3, "2025-01-01", "C1", "P1", "S1", 3, "10.00", "4.00"),
            line(4, "2025-03-31", "C3", "P2", "S2", 4, "5.00", "6.00", "0.10"),
            line(5, "2024-12-31", None, "P1", "S1", 1, "10.00", "4.00"),
        ],
        SALES,
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [("P1", "one", "x", D("4.00")), ("P2", "two", "y", D("6.00")), ("P3", "unsold", "y", D("1.00"))],
        "product_id string, product_name string, category string, unit_cost decimal(14,2)",
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(c, f"name {c}", "retail", "town", "north") for c in ("C1", "C2", "C4")],
        "customer_id string, customer_name string, segment string, city string, region string",
    )


@pytest.fixture(scope="module")
def stores(spark):
    return spark.createDataFrame(
        [("S1", "first", "south"), ("S2", "second", "north")],
        "store_id string, store_name string, region string",
    )


def test_negative_margin_products(sales, products):
    rows = profit.negative_margin_products(sales, products).collect()
    assert [(r["product_id"], r["units"], r["margin"], r["recoverable"], r["avg_discount"]) for r in rows] == [
        ("P2", 5, D("-5.00"), D("5.00"), D("0.150"))
    ]


def test_margin_priced_after_the_sum_equals_line_margins(sales, products):
    with_lines = profit.negative_margin_products(sales, products)
    without = profit.negative_margin_products(sales.drop("margin", "cost"), products)
    key = ["product_id", "units", "revenue", "margin", "avg_discount"]
    assert with_lines.select(*key).collect() == without.select(*key).collect()


def test_line_margin_and_discounted_price(spark):
    df = spark.createDataFrame(
        [(D("100.00"), D("0.15"), 3, D("90.00"))],
        "list_price decimal(14,2), discount decimal(4,2), qty int, unit_cost decimal(14,2)",
    )
    row = profit.line_margin(profit.discounted_price(df)).first()
    assert (row["unit_price"], row["revenue"], row["cost"], row["margin"]) == (85, 255, 270, -15)


def test_slow_movers_drop_unsold_products_and_break_ties_by_id(sales, products):
    rows = profit.slow_movers(sales, products, "2025-01-01", limit=8).collect()
    assert [r["product_id"] for r in rows] == ["P1", "P2"]
    assert [r["units_recent"] for r in rows] == [3, 4]
    assert rows[0]["months_sold"] == 4 and rows[0]["units_per_month"] == 0.5
    assert rows[0]["tied_capital"] == 6.0


def test_churn_ignores_null_customers(sales, customers):
    row = profit.customer_churn(sales, BASE, NEXT).first()
    assert (row["lost_customers"], row["base_customers"], row["churn_pct"], row["margin_lost"]) == (
        1, 2, 50.0, D("6.00"))
    assert [r["customer_id"] for r in profit.churned_customer_list(sales, customers, BASE, NEXT).collect()] == ["C2"]
    kept = profit.retained_customers(sales, BASE, NEXT).collect()
    assert [(r["customer_id"], r["margin_base"]) for r in kept] == [("C1", D("11.00"))]


def test_churn_without_base_customers(sales):
    row = profit.customer_churn(sales, ("2020-01-01", "2021-01-01"), NEXT).first()
    assert row["base_customers"] == 0 and row["churn_pct"] is None


def test_members_semi_join_keeps_each_line_once(sales, customers):
    twice = customers.unionByName(customers)
    assert profit.sales_of_members(sales, twice, "customer_id").count() == 4


def test_store_ticket_counts_distinct(sales, stores):
    rows = {r["store_id"]: r for r in profit.store_ticket(sales, stores).collect()}
    assert (rows["S1"]["tickets"], rows["S1"]["customers"], rows["S1"]["avg_ticket"]) == (3, 1, 21.67)
    assert (rows["S2"]["tickets"], rows["S2"]["avg_ticket"]) == (2, 15.0)


def test_store_gap(sales, stores):
    rows = {r["store_id"]: r for r in profit.store_gap(sales, stores, months=24).collect()}
    median = (21.67 + 15.0) / 2
    assert rows["S2"]["gap"] == pytest.approx(round(15 - median, 2), abs=0.011)
    assert rows["S1"]["gain"] == 0.0
    margin_share = 37 / 95
    assert rows["S2"]["gain"] == pytest.approx((median - 15) * 2 * margin_share * 0.5, abs=0.01)
    assert rows["S2"]["gain_per_year"] == pytest.approx(rows["S2"]["gain"] / 2, abs=0.01)


def test_monthly_kpis_and_first_change_is_null(sales):
    rows = kpi.monthly_kpis(sales).collect()
    assert [r["period"] for r in rows] == ["2024-01", "2024-02", "2024-12", "2025-01", "2025-03"]
    assert rows[0]["revenue_change_pct"] is None and rows[1]["revenue_change_pct"] == -60.0
    assert rows[0]["margin_pct"] == 44.0
    assert kpi.monthly_kpis(sales, pct_decimals=0).collect()[1]["margin_pct"] == 60.0


def test_enriched_keeps_lines_without_master_rows(sales, customers, stores, products):
    wide = kpi.sales_enriched(sales, customers, stores, products)
    assert wide.count() == sales.count()
    assert {"region", "region_store", "period", "category"} <= set(wide.columns)
    assert wide.where("customer_id = 'C3'").first()["segment"] is None
    by_store = kpi.kpis_by(wide, "store_name").collect()
    assert [(r["store_name"], r["revenue"]) for r in by_store] == [("first", 65.0), ("second", 30.0)]


def test_rfm_scores_and_summary(spark):
    # customer i bought i times; later customers bought more recently and spent more
    rows = [line(100 * i + k, f"2025-01-{i:02d}", f"C{i:02d}", "P", "S", 1, f"{i}.00", "0.50")
            for i in range(1, 11) for k in range(i)]
    scores = rfm.rfm_scores(spark.createDataFrame(rows, SALES))
    got = {r["customer_id"]: r for r in scores.collect()}
    assert got["C10"]["recency"] == 1 and got["C01"]["recency"] == 10
    assert (got["C10"]["r"], got["C10"]["f"], got["C10"]["m"], got["C10"]["segment"]) == (5, 5, 5, "Campeones")
    assert (got["C01"]["r"], got["C01"]["fm"], got["C01"]["segment"]) == (1, 1, "Hibernando / Perdidos")
    summary = rfm.rfm_segment_summary(scores).collect()
    assert sum(r["customers"] for r in summary) == 10
    assert sum(r["pct_customers"] for r in summary) == pytest.approx(100)
    best = rfm.best_first(scores).first()
    assert best["r"] == 5


def test_rfm_equal_recency_is_ranked_by_customer_id(spark):
    rows = [line(i, "2025-01-01", f"C{i}", "P", "S", 1, "1.00", "0.50") for i in range(1, 6)]
    got = {r["customer_id"]: (r["r"], r["f"], r["m"]) for r in
           rfm.rfm_scores(spark.createDataFrame(rows, SALES)).collect()}
    assert got == {"C1": (5, 1, 1), "C2": (4, 2, 2), "C3": (3, 3, 3), "C4": (2, 4, 4), "C5": (1, 5, 5)}


def test_rfm_impact_without_at_risk_segment_is_zero(spark):
    summary = spark.createDataFrame([("Leales", 3, 100.0)], "segment string, customers bigint, margin_total double")
    months = spark.createDataFrame([(24,)], "months bigint")
    row = rfm.rfm_impact(summary, months).first()
    assert (row["customers_at_risk"], row["recoverable"], row["total_impact"]) == (0, 0.0, 270000.0)


def test_impacts_reproduce_the_published_estimates(spark):
    negative = spark.createDataFrame(
        [(D("730785"),), (D("491179"),), (D("365970"),), (D("235225"),)], "recoverable decimal(18,2)")
    assert impact.impact_negative_margin(negative, 24).first()["impact"] == pytest.approx(0.91e6, abs=5e3)
    churn = spark.createDataFrame([(2.45e6,)], "margin_lost double")
    assert impact.impact_churn(churn).first()["impact"] == pytest.approx(0.74e6, abs=1e4)
    slow = spark.createDataFrame([(79000.0,)], "tied_capital double")
    assert impact.impact_slow_movers(slow).first()["impact_per_year"] == pytest.approx(6320)


def test_published_store_gap_estimate(spark):
    """Average tickets of five stores; closing half the gap of the weakest is worth 0.39 M a year."""
    stores = {"S1": (9499, 3128), "S2": (10882, 3467), "S3": (11267, 743), "S4": (11730, 5562), "S5": (12713, 2800)}
    rows, ticket = [], 0
    for store, (avg, tickets) in stores.items():
        for _ in range(tickets):
            ticket += 1
            rows.append((ticket, store, D(avg), D(avg) * D("0.282")))
    sales = spark.createDataFrame(
        rows, "ticket_id bigint, store_id string, revenue decimal(16,2), margin decimal(16,4)")
    names = spark.createDataFrame([(s, s, "r") for s in stores], "store_id string, store_name string, region string")
    worst = profit.store_gap(sales, names, months=24).first()
    assert (worst["store_id"], worst["gap"], worst["gap_pct"]) == ("S1", -1768.0, -15.7)
    assert worst["gain_per_year"] == pytest.approx(0.39e6, abs=1e3)


def test_findings_are_ranked_with_cumulative_share(spark):
    one = lambda v: spark.createDataFrame([(float(v),)], "impact double")
    rows = impact.findings_ranked({"a": one(10), "b": one(60), "c": one(30)}).collect()
    assert [(r["rank"], r["finding"]) for r in rows] == [(1, "b"), (2, "c"), (3, "a")]
    assert [r["cumulative_share"] for r in rows] == pytest.approx([0.6, 0.9, 1.0])
    assert {r["total"] for r in rows} == {100.0}


def test_quality_report_counts_each_rule(sales, customers):
    bad = sales.unionByName(sales.where("ticket_id = 2")).withColumn(
        "ticket_id", F.when(F.col("ticket_id") != 4, F.col("ticket_id"))
    ).withColumn("revenue", F.when(F.col("product_id") == "P2", F.col("revenue") + 1).otherwise(F.col("revenue")))
    got = {r["rule"]: r["failing_rows"] for r in quality.quality_report(bad, customers).collect()}
    assert got == {"null_ids": 1, "revenue_mismatch": 2, "duplicate_rows": 1, "orphan_customers": 2}


def test_control_totals_show_the_difference(sales):
    part = sales.where("store_id = 'S1'").agg(
        F.count("*").alias("lines"), F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"))
    got = {r["total"]: r["difference"] for r in quality.control_totals(sales, part).collect()}
    assert got == {"lines": -2, "revenue": -30, "margin": -2}


def test_date_and_dimension_checks(sales, products):
    report = quality.check_report(
        {"dates": quality.dates_out_of_range(sales, *BASE),
         "products": quality.unused_members(products, sales, "product_id")})
    assert {r["check"]: r["rows"] for r in report.collect()} == {"dates": 2, "products": 1}


def test_orphan_keys_count_rows_not_keys(sales, customers):
    assert quality.orphan_keys(sales, customers, "customer_id").first()[0] == 2


def test_detection_score(spark):
    truth = spark.createDataFrame([(i, i < 4) for i in range(10)], "k int, flag boolean")
    found = spark.createDataFrame([(i,) for i in (1, 2, 3, 8)], "k int")
    row = quality.detection_score(found, truth, "k", "flag").first()
    assert (row["true_positives"], row["precision"], row["recall"]) == (3, 0.75, 0.75)


def test_profile(sales, customers, products, stores):
    row = profit.profile(sales, customers, products, stores).first()
    assert (row["sale_lines"], row["customers"], row["products"], row["stores"]) == (6, 3, 3, 2)
    assert (row["first_date"], row["last_date"]) == (date(2024, 1, 10), date(2025, 3, 31))
    assert (row["revenue"], row["margin"], row["margin_pct"]) == (95, 37, 38.9)
