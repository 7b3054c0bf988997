"""Stock policy, classes and coverage: published rows, edges and invariants."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bizops.functions import rules
from bizops.operators import abcxyz, coverage

# --- Fixed values: published policy rows (inputs, then results). -----------------------------
# sku, mean, deviation, lead days, order cost, unit cost, price, stock ->
#   safety, reorder, quantity, optimum, excess, capital, deficit, risk, below
POLICY = [
    ("SKU-001", 52.5, 9.155658739627736, 18, 7046, 6824, 10040, 7, 12, 43, 72, 79, 0, 0, 36, 361440, True),
    ("SKU-002", 73.83333333333333, 12.733614079915881, 12, 5835, 6454, 9251, 11, 13, 43, 80, 83, 0, 0, 32, 296032, True),
    ("SKU-003", 84.375, 11.941205605145061, 8, 8858, 5298, 8674, 6, 10, 33, 116, 91, 0, 0, 27, 234198, True),
    ("SKU-019", 24.208333333333332, 5.175016628132636, 5, 3753, 3291, 5148, 55, 3, 8, 51, 33, 0, 0, 0, 0, False),
    ("SKU-020", 37.5, 7.999999999999998, 13, 3413, 1982, 3319, 65, 9, 25, 79, 64, 0, 0, 0, 0, False),
    ("SKU-021", 32.583333333333336, 5.633106075512072, 12, 4200, 1621, 2700, 59, 6, 19, 90, 64, 0, 0, 0, 0, False),
    ("SKU-059", 7.208333333333333, 4.727157125879531, 6, 2748, 794, 1186, 110, 3, 5, 49, 29, 56, 44464, 0, 0, False),
    ("SKU-060", 4.333333333333333, 3.059790653064309, 4, 3085, 212, 342, 205, 2, 2, 78, 41, 125, 26500, 0, 0, False),
    ("SKU-061", 6.541666666666667, 2.8889469522221454, 4, 3372, 983, 1730, 72, 2, 3, 46, 26, 23, 22609, 0, 0, False),
    ("SKU-099", 8.0, 6.345145354144174, 13, 2006, 1227, 1933, 14, 7, 10, 35, 28, 0, 0, 0, 0, False),
    ("SKU-100", 9.708333333333334, 5.179215709189841, 12, 3082, 1032, 1668, 16, 5, 9, 53, 36, 0, 0, 0, 0, False),
    ("SKU-101", 4.0, 3.078678429060953, 6, 1587, 273, 423, 16, 2, 3, 47, 27, 0, 0, 0, 0, False),
    ("SKU-102", 5.166666666666667, 3.559026084010437, 9, 3652, 412, 644, 18, 3, 5, 66, 38, 0, 0, 0, 0, False),
]
# ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame(
        [row[:8] for row in POLICY],
        "sku string, demand_avg double, demand_std double, lead_time_days int, order_cost int,"
        "unit_cost int, unit_price int, stock_on_hand int",
    )


def test_policy_reproduces_the_published_rows(published):
    got = {r["sku"]: r for r in abcxyz.inventory_policy(published).collect()}
    for row in POLICY:
        r = got[row[0]]
        assert (
            r["safety_stock"], r["reorder_point"], r["order_quantity"], r["optimal_stock"],
            r["excess_units"], r["tied_capital"], r["deficit_units"], r["sales_at_risk"],
            r["below_reorder_point"],
        ) == row[8:], row[0]


def test_excess_and_deficit_exclude_each_other(published):
    both = abcxyz.inventory_policy(published).where("excess_units * deficit_units != 0")
    assert both.count() == 0


def test_health_and_impact(published):
    policy = abcxyz.inventory_policy(published)
    health = abcxyz.stock_health(policy).first()
    assert (health["skus"], health["overstock"], health["below_reorder_point"], health["healthy"]) == (13, 3, 3, 7)
    assert health["healthy_pct"] == 53.8
    money = abcxyz.inventory_impact(policy).first()
    assert money["tied_capital"] == 44464 + 26500 + 22609
    assert money["sales_at_risk"] == 361440 + 296032 + 234198
    saving = sum(max(0, r[4] * (12 - min(52, r[1] * 12 / r[10]))) for r in POLICY)
    assert money["order_saving"] == pytest.approx(saving)
    assert money["time_saving"] == 270000
    assert money["total"] == pytest.approx(
        money["tied_capital"] + money["sales_at_risk"] + saving + 270000)
    assert [r["sku"] for r in abcxyz.top_stockout_risk(policy).collect()] == ["SKU-001", "SKU-002", "SKU-003"]
    assert [r["sku"] for r in abcxyz.top_overstock(policy, k=2).collect()] == ["SKU-059", "SKU-060"]


def test_policy_by_service_level_moves_only_the_named_classes(published):
    classed = published.withColumn(
        "class", F.when(F.col("sku") < "SKU-010", "AX").when(F.col("sku") > "SKU-100", "CZ").otherwise("BX"))
    flat = {r["sku"]: r["safety_stock"] for r in abcxyz.inventory_policy(classed).collect()}
    for r in abcxyz.policy_by_service_level(classed).collect():
        if r["class"] == "AX":
            assert r["z_score"] == 2.054 and r["safety_stock"] > flat[r["sku"]]
        elif r["class"] == "CZ":
            assert r["z_score"] == 1.282 and r["safety_stock"] <= flat[r["sku"]]
        else:
            assert r["z_score"] == 1.645 and r["safety_stock"] == flat[r["sku"]]


def test_free_product_does_not_divide_by_zero(spark):
    df = spark.createDataFrame(
        [("a", 10.0, None, 30, 100, 0, 5, 0), ("b", 0.0, 0.0, 30, 100, 4, 5, 0)],
        "sku string, demand_avg double, demand_std double, lead_time_days int, order_cost int,"
        "unit_cost int, unit_price int, stock_on_hand int",
    )
    a, b = abcxyz.eoq_frequency(abcxyz.inventory_policy(df)).orderBy("sku").collect()
    assert (a["safety_stock"], a["reorder_point"], a["order_quantity"]) == (0, 10, 155)
    assert (b["reorder_point"], b["order_quantity"], b["orders_optimal"], b["order_saving"]) == (0, 0, 0.0, 1200.0)


@pytest.fixture(scope="module")
def small(spark):
    months = [date(2024, m, 1) for m in range(1, 5)]
    units = {"s1": [100, 100, 100, 100], "s2": [10, 20, 10, 20], "s3": [0, 9, 0, 0], "s4": [3], "s9": [5]}
    demand = spark.createDataFrame(
        [(s, m, u) for s, us in units.items() for m, u in zip(months, us)],
        "sku string, month_start date, units int")
    products = spark.createDataFrame(
        [(s, s, "c", D("1.00"), D("0.50"), 10, 100) for s in ("s1", "s2", "s3", "s4")],
        "sku string, name string, category string, unit_price decimal(10,2), unit_cost decimal(10,2),"
        "lead_time_days int, order_cost int")
    stock = spark.createDataFrame([(s, 50) for s in ("s1", "s2", "s3", "s4")], "sku string, stock_on_hand int")
    return demand, products, stock


def test_classes_of_a_small_catalogue(small):
    got = {r["sku"]: r for r in abcxyz.abc_xyz(*small).collect()}
    assert set(got) == {"s1", "s2", "s3", "s4"}  # s9 has no product row
    # the single best seller is above 80 % of revenue, so it is not A
    assert {s: r["abc"] for s, r in got.items()} == {"s1": "B", "s2": "C", "s3": "C", "s4": "C"}
    assert {s: r["xyz"] for s, r in got.items()} == {"s1": "X", "s2": "Y", "s3": "Z", "s4": "Z"}
    assert got["s4"]["cv"] is None  # one month: no deviation
    assert sum(r["revenue_share"] for r in got.values()) == pytest.approx(1)
    assert got["s4"]["cumulative_share"] == pytest.approx(1)


def test_share_keeps_empty_classes_and_sums_to_hundred(small):
    rows = abcxyz.abc_share(abcxyz.abc_xyz(*small)).collect()
    assert [(r["abc"], r["skus"]) for r in rows] == [("A", 0), ("B", 1), ("C", 3)]
    assert sum(r["pct_revenue"] for r in rows) == pytest.approx(100)


def test_matrix_and_flags(small):
    classed = abcxyz.abc_xyz(*small)
    cells = {(r["abc"], r["xyz"]): r["skus"] for r in abcxyz.abc_xyz_matrix(classed).collect()}
    assert cells == {("B", "X"): 1, ("C", "Y"): 1, ("C", "Z"): 2}
    policy = abcxyz.inventory_policy(classed)
    flags = abcxyz.class_with_policy(classed.select(*abcxyz.CLASSIFICATION_COLUMNS), policy)
    assert flags.count() == 4 and {"class", "below_reorder_point", "excess_units"} <= set(flags.columns)


def test_a_zero_revenue_catalogue_has_null_shares(spark):
    df = spark.createDataFrame([("a", D(0)), ("b", D(0))], "sku string, revenue_total decimal(12,2)")
    rows = abcxyz.abc_classes(df).collect()
    assert all(r["revenue_share"] is None and r["abc"] == "A" for r in rows)


# ---------------------------------------------------------------- coverage

SHEET = ("product_id string, category string, stock int, unit_cost decimal(10,2), m1 int, m2 int, m3 int,"
         "m4 int, m5 int, m6 int, last_movement date")


@pytest.fixture(scope="module")
def sheet(spark):
    def row(i, stock, monthly):
        return (f"p{i}", "ab"[i % 2], stock, D("2.00"), *[monthly] * 6, date(2025, 6, 15))

    rows = [row(0, 6, 30), row(1, 7, 30), row(2, 14, 30), row(3, 90, 30), row(4, 91, 30), row(5, 181, 30),
            row(6, 5, 0)]
    return spark.createDataFrame(rows, SHEET)


def test_states_actions_and_products_that_never_sell(sheet):
    rows = {r["product_id"]: r for r in coverage.stock_coverage(sheet).collect()}
    assert [rows[f"p{i}"]["state"] for i in range(7)] == [
        "QUIEBRE", "CRÍTICO", "NORMAL", "NORMAL", "SOBRESTOCK", "STOCK MUERTO", "STOCK MUERTO"]
    assert rows["p6"]["cover_days"] == 9999 and rows["p6"]["action"] == "LIQUIDAR / DEVOLVER"


def test_stock_kpis(sheet):
    rows = {r["product_id"]: r for r in coverage.stock_kpis(sheet, "2025-07-01").collect()}
    assert rows["p0"]["turnover"] == 30.0 and rows["p0"]["stockout_alert"] is True
    assert rows["p1"]["stockout_alert"] is False and rows["p3"]["capital"] == 180
    assert rows["p0"]["days_without_movement"] == 16


def test_state_counts_partition_the_products_and_keep_empty_states(sheet):
    counts = coverage.coverage_state_counts(coverage.stock_coverage(sheet).where("state != 'NORMAL'")).collect()
    assert [r["state"] for r in counts] == rules.COVERAGE_STATES
    assert [r["products"] for r in counts] == [1, 1, 0, 1, 2]
    assert counts[2]["capital"] == 0.0


def test_capital_views(sheet):
    covered = coverage.stock_coverage(sheet)
    dead = coverage.dead_stock_capital(covered).first()
    assert (dead["dead_products"], dead["dead_capital"], dead["total_capital"], dead["dead_pct"]) == (2, 372, 788, 47.2)
    assert {r["category"]: r["capital"] for r in coverage.capital_by_category(covered).collect()} == {"a": 232, "b": 556}
    assert [r["product_id"] for r in coverage.top_capital(covered, 2).collect()] == ["p5", "p4"]
    alerts = coverage.stock_alerts(covered).orderBy("priority", "product_id").collect()
    assert [(r["priority"], r["product_id"]) for r in alerts] == [(1, "p0"), (2, "p5"), (2, "p6"), (3, "p4"), (4, "p1")]


def test_trend_share_and_percentile_class(sheet):
    labels = {f"m{i}": f"2025-0{i}" for i in range(1, 7)}
    trend = coverage.monthly_sales_trend(sheet, labels).collect()
    assert [(r["month"], r["sales"]) for r in trend] == [(m, 180) for m in labels.values()]
    assert sum(r["share"] for r in coverage.pct_of_total(sheet).collect()) == pytest.approx(1)
    classes = {r["product_id"]: r["abc"] for r in coverage.coverage_abc(sheet).collect()}
    assert classes == {**{f"p{i}": "A" for i in range(6)}, "p6": "C"}


def test_deviations_are_the_same_bits_on_any_partitioning(spark, conf):
    import random

    rng = random.Random(3)
    rows = [(f"S{k % 200}", k, rng.randrange(1, 10**6)) for k in range(9000)]
    seen = set()
    for n in (1, 8, 64):
        conf(spark__sql__shuffle__partitions=str(n), spark__sql__adaptive__coalescePartitions__enabled="false")
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "sku string, month int, units bigint").repartition(n)
        seen.add(tuple(sorted((r["sku"], r["demand_avg"].hex(), r["demand_std"].hex(), r["cv"].hex()) for r in abcxyz.demand_stats(df).collect())))
    assert len(seen) == 1
    by = {}
    for sku, _, units in rows:
        by.setdefault(sku, []).append(units)
    import statistics

    for sku, _, std, _ in seen.pop():
        assert float.fromhex(std) == pytest.approx(statistics.stdev(by[sku]), rel=1e-15)


def test_deviation_of_one_month_fractions_and_nulls(spark):
    one = spark.createDataFrame([("a", 5), ("b", 1), ("b", 3), ("c", None)], "sku string, units int")
    got = {r["sku"]: (r["demand_avg"], r["demand_std"], r["demand_sum"]) for r in abcxyz.demand_stats(one).collect()}
    assert got == {"a": (5.0, None, 5), "b": (2.0, pytest.approx(2 ** 0.5), 4), "c": (None, None, None)}
    half = spark.createDataFrame([("a", 0.5), ("a", 1.5)], "sku string, units double")
    assert abcxyz.demand_stats(half).first()["demand_std"] == pytest.approx(0.5 ** 0.5)
