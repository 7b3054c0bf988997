"""Several groupings from one pass, mergeable distinct counts, duplicate rows by hash."""

import pytest
from pyspark.sql import functions as F

from bizops.operators import kpi, profit, quality, rfm
from bizops.operators.grouped import count_bits, grouped_once, id_word, visits


def distinct(df, keys, col):
    block, bit = id_word(df, col)
    words = df.groupBy(*keys, block.alias("_b")).agg(F.bit_or(bit).alias("_w"))
    return words


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_words_count_what_count_distinct_counts(spark, kind):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("store"), (F.col("id") % 12).alias("month"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 901) - 450).cast(kind).alias("ticket")).repartition(4)
    words = distinct(df, ["store", "month"], "ticket")
    want = {r["store"]: r["n"] for r in df.groupBy("store").agg(F.count_distinct("ticket").alias("n")).collect()}
    # Months merge to the whole period without the rows.
    merged = words.groupBy("store", "_b").agg(F.bit_or("_w").alias("_w")).groupBy("store").agg(count_bits("_w").alias("n"))
    assert {r["store"]: r["n"] for r in merged.collect()} == want
    monthly = words.groupBy("month").agg(F.count(F.lit(1)))
    assert monthly.count() == 12


def test_groups_of_one_pass_equal_single_groupings(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 10 != 0, F.col("id") % 4).alias("a"), (F.col("id") % 6).alias("b"), (F.col("id") % 5).alias("c"), F.col("id").alias("v"))
    sets = {"one": ["a"], "two": ["b", "c"], "three": ["c", "a"]}
    for name, got in grouped_once(df, sets, F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).items():
        want = df.groupBy(*sets[name]).agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


SALES = "ticket_id bigint, customer_id string, product_id string, store_id string, sale_date date, qty int, discount double, revenue decimal(16,4), margin decimal(16,4)"


@pytest.fixture
def sales(spark):
    df = spark.range(2000).selectExpr(
        "id DIV 3 AS ticket_id", "IF(id % 50 = 0, NULL, 'C' || (id DIV 3) % 90) AS customer_id", "'P' || id % 41 AS product_id",
        "'S' || id % 7 AS store_id", "date_add(DATE'2024-01-01', CAST(id % 700 AS INT)) AS sale_date", "CAST(1 + id % 5 AS INT) AS qty",
        "id % 4 / 10 AS discount", "CAST(id * 1.25 AS DECIMAL(16,4)) AS revenue", "CAST(200 - id % 300 AS DECIMAL(16,4)) AS margin")
    return spark.createDataFrame(df.collect(), SALES)


def rows(df):
    return sorted(map(str, df.collect()))


def test_finding_sums_equal_the_operators_own(spark, sales):
    base, following, recent = ("2024-01-01", "2025-01-01"), ("2025-01-01", "2026-01-01"), ("2025-05-01", "2025-11-01")
    products = spark.range(41).selectExpr("'P' || id AS product_id", "'n' AS product_name", "'c' AS category", "CAST(2 AS DECIMAL(14,4)) AS unit_cost")
    stores = spark.range(7).selectExpr("'S' || id AS store_id", "'s' AS store_name", "'r' AS region")
    sums = profit.finding_sums(sales, base, following, recent)
    assert rows(profit.churn_of(sums["customers"])) == rows(profit.customer_churn(sales, base, following))
    assert rows(profit.negative_margin_products(sums["products"], products)) == rows(profit.negative_margin_products(sales, products))
    assert rows(profit.gaps_of(sums["stores"], stores, 24)) == rows(profit.store_gap(sales, stores, 24))
    rhythm = sums["products"].select("product_id", F.col("qty").alias("units_total"), "units_recent", F.lit(None).alias("months_sold"))
    own = profit.slow_movers(sales, products, *recent).drop("months_sold")
    assert rows(profit.slowest(rhythm, products).drop("months_sold")) == rows(own)
    assert sums["months"].count() == kpi.months_covered(sales).first()["months"]


def test_report_sums_equal_the_operators_own(spark, sales):
    sums = kpi.report_sums(sales, ["store_id"])
    assert rows(kpi.monthly_of(sums["months"])) == rows(kpi.monthly_kpis(sales))
    assert rows(kpi.kpis_of(sums["store_id"], "store_id")) == rows(kpi.kpis_by(sales, "store_id"))
    assert rows(rfm.scores_of(sums["customers"])) == rows(rfm.rfm_scores(sales))


def test_repeated_rows_and_lines_without_a_customer(spark):
    schema = "ticket_id bigint, line_number int, customer_id string, qty decimal(5,0), unit_price decimal(12,2), revenue decimal(14,2)"
    one, two = (1, 1, "A", 2, 5, 10), (1, None, "A", 2, 5, 10)
    swapped = [(None, 7, "A", 1, 1, 1), (7, None, "A", 1, 1, 1)]  # equal but for where the null is
    lines = [one] * 3 + [two] * 2 + swapped + [(2, 1, None, 1, 1, 1), (3, 1, "ghost", 1, 1, 9)]
    from decimal import Decimal

    typed = [(a, b, c, *(Decimal(x) for x in rest)) for a, b, c, *rest in lines]
    customers = spark.createDataFrame([("A",), ("A",)], "customer_id string")
    df = spark.createDataFrame(typed, schema).repartition(3)
    got = {r["rule"]: r["failing_rows"] for r in quality.quality_report(df, customers).collect()}
    assert got == {"null_ids": 1, "duplicate_rows": 3, "orphan_customers": 2, "revenue_mismatch": 1}


def test_a_repeated_hash_alone_is_no_repeated_row(spark, monkeypatch):
    monkeypatch.setattr(quality, "_with_hash", lambda df: df.withColumns({"_h1": F.lit(1), "_h2": F.lit(2)}))
    df = spark.range(50).selectExpr("id AS ticket_id", "'A' AS customer_id", "1 AS qty", "CAST(1 AS DECIMAL(9,2)) AS unit_price", "CAST(1 AS DECIMAL(9,2)) AS revenue")
    got = {r["rule"]: r["failing_rows"] for r in quality.quality_report(df.union(df.limit(4)), df.select("customer_id")).collect()}
    assert got["duplicate_rows"] == 4 and got["orphan_customers"] == 0


def test_visits_counts_like_plain_sets(spark):
    """Tickets of two customers or stores, negative and null ids, ids as text, lines that repeat."""
    lines = [(i % 3, i % 40 - 20, (i * 7 % 90 - 30) if i % 11 else None, i % 5) for i in range(300)] * 2 + [(1, None, 4, 2)]
    want = {
        s: (len({c for k, _, c, _ in lines if k == s and c is not None}), len({t for k, t, _, _ in lines if k == s and t is not None}),
            sum(v for k, *_, v in lines if k == s)) for s in range(3)}
    units = spark.createDataFrame(lines, "store_id int, ticket_id bigint, customer_id int, revenue bigint").withColumn("margin", F.col("revenue") * 2)
    text = units.withColumns({c: F.concat(F.lit("x"), c) for c in ("ticket_id", "customer_id")})
    for df in (units, text):
        got = {r["store_id"]: (r["customers"], r["tickets"], r["_revenue"]) for r in visits(df, "store_id").collect()}
        assert got == want
    got = visits(units, "store_id", {"revenue": 2, "margin": 2}).where("store_id = 1").first()
    assert (float(got["_revenue"]), float(got["_margin"])) == (want[1][2] / 100, want[1][2] / 50)
