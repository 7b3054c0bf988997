"""Distributed ranks, running totals and percentiles against plain single-task answers."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.operators import ordered
from bizops.operators.ordered import percentiles, with_order


def check_against_plain_window(df):
    got = with_order(df, [F.desc("v"), "id"], value="v")
    w = W.orderBy(F.desc("v"), "id")
    plain = df.select(
        "id",
        F.row_number().over(w).alias("p_rank"),
        F.sum("v").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("p_running"),
        F.count("*").over(W.partitionBy()).alias("p_rows"),
        F.sum("v").over(W.partitionBy()).alias("p_total"),
    )
    both = got.join(plain, "id")
    assert both.count() == df.count()
    wrong = both.where(
        (F.col("rank") != F.col("p_rank"))
        | (F.col("running") != F.col("p_running"))
        | (F.col("total_rows") != F.col("p_rows"))
        | (F.col("grand_total") != F.col("p_total"))
    )
    assert wrong.count() == 0
    return got


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_equals_plain_window_with_heavy_ties(spark, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__coalescePartitions__enabled="false")
    # a third of all rows share one value
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("decimal(12,2)")
    df = spark.range(30000).withColumn("v", value)
    check_against_plain_window(df)


def test_hot_value_is_spread_over_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(40000).withColumn("v", F.lit(1).cast("decimal(12,2)"))
    placed = df.orderBy("v", "id").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(placed) == 8 and max(r["count"] for r in placed) < 40000 / 3
    check_against_plain_window(df)


def test_result_does_not_depend_on_partitioning(spark, conf):
    rows = [(i, Decimal(random.Random(i).randint(0, 50))) for i in range(500)]
    base = spark.createDataFrame(rows, "id int, v decimal(12,2)")
    results = []
    for n in (1, 8):
        conf(spark__sql__shuffle__partitions=str(n), spark__sql__adaptive__coalescePartitions__enabled="false")
        out = with_order(base.repartition(n), [F.desc("v"), "id"], value="v")
        results.append(sorted((r["id"], r["rank"], r["running"]) for r in out.collect()))
    assert results[0] == results[1]


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "id int, v decimal(12,2)")
    assert with_order(empty, ["v", "id"], value="v").collect() == []
    one = with_order(empty.unionByName(spark.createDataFrame([(1, Decimal(5))], empty.schema)), ["v", "id"], "v")
    row = one.first()
    assert (row["rank"], row["total_rows"], row["running"], row["grand_total"]) == (1, 1, 5, 5)


def test_rank_without_value(spark):
    out = with_order(spark.range(10), [F.desc("id")])
    assert {r["id"]: r["rank"] for r in out.collect()} == {i: 10 - i for i in range(10)}


@pytest.mark.parametrize("n", [1, 2, 5, 10, 101, 1000])
def test_percentiles_match_linear_interpolation(spark, n):
    values = [float(random.Random(i * n).randint(0, n // 2 + 1)) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    row = percentiles(df, "x", {"p0": 0.0, "p50": 0.5, "p80": 0.8, "p100": 1.0}).first()
    for name, p in (("p0", 0), ("p50", 50), ("p80", 80), ("p100", 100)):
        assert row[name] == pytest.approx(np.percentile(values, p), abs=1e-12)


def sorted_places(rows, ranks):
    whole = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return [tuple(whole[r - 1]) for r in ranks]


@pytest.mark.parametrize("in_task", [ordered.IN_TASK, 0])
@pytest.mark.parametrize("case", ["spread", "tied", "hot", "nulls", "few", "one"])
def test_ranks_are_selected_exactly(spark, monkeypatch, case, in_task):
    monkeypatch.setattr(ordered, "IN_TASK", in_task)
    rng = random.Random(case)
    n = {"few": 7, "one": 1}.get(case, 4000)
    values = {
        "spread": lambda i: rng.randrange(10**9), "tied": lambda i: rng.randrange(9), "few": lambda i: rng.randrange(5), "one": lambda i: 3,
        "hot": lambda i: 50 if i % 3 == 0 else rng.randrange(100), "nulls": lambda i: None if i % 4 == 0 else rng.randrange(50),
    }[case]
    rows = [(values(i), i) for i in range(n)]
    money = [(None if v is None else Decimal(v) / 100, k) for v, k in rows]
    df = spark.createDataFrame([(v, m, k) for (v, k), (m, _) in zip(rows, money)], "v bigint, m decimal(16,2), k bigint").repartition(5)
    ranks = lambda n: sorted({1, n, *(max(1, q * n // 7) for q in range(1, 7))})
    got = ordered.at_ranks(df, {"a": F.col("v"), "b": -F.col("v"), "c": F.col("m")}, "k", ranks)
    down = [(None if v is None else -v, k) for v, k in rows]
    for name, want in (("a", rows), ("b", down), ("c", money)):
        assert [tuple(p) for p in got[name]] == sorted_places(want, ranks(n)), name


def test_ranks_of_no_rows_and_text_keys(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z")], "v int, k string")
    assert ordered.at_ranks(df.where("v > 5"), {"v": F.col("v")}, "k", lambda n: [1]) == {"v": []}
    assert [tuple(p) for p in ordered.at_ranks(df, {"v": F.col("v")}, "k", lambda n: [1, 2, 3])["v"]] == [(0, "z"), (1, "a"), (1, "b")]


@pytest.mark.parametrize("in_task", [ordered.IN_TASK, 0])
def test_only_rows_in_brackets_are_sorted(spark, monkeypatch, in_task):
    monkeypatch.setattr(ordered, "IN_TASK", in_task)
    seen, real = [], ordered.with_order

    def count(df, *args, **kwargs):
        seen.append(df.count())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(ordered, "with_order", count)
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("v"), F.col("id").alias("k"))
    [place] = ordered.at_ranks(df, {"v": F.col("v")}, "k", lambda n: [n // 2])["v"]
    want = sorted(i * 7919 % 100_003 for i in range(100_000))[49_999]
    assert place.value == want and (seen == [] if in_task else len(seen) == 1 and seen[0] < 200)


def test_percentiles_of_groups(spark):
    rng = random.Random(5)
    rows = [(g, None if rng.random() < 0.1 else rng.choice([1.5, 7.25, rng.uniform(0, 9)])) for g in [None, "a", "b", "c"] for _ in range(rng.randint(1, 90))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: (r["lo"], r["mid"]) for r in ordered.percentiles_by(df, "g", "v", {"lo": 0.3, "mid": 0.5}).collect()}
    for g in {r[0] for r in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        if values:
            assert got[g] == pytest.approx(tuple(np.percentile(values, [30, 50])))
    assert ordered.percentiles_by(df.where("false"), "g", "v", {"mid": 0.5}).count() == 0
