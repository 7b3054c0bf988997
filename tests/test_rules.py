"""Label rules at and around their thresholds."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bizops.functions import rules
from bizops.functions.numeric import percent, percent_even, ratio, zero_to_one


def apply(spark, values, kind, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


def test_quintiles_equal_quantile_cut_for_every_size(spark):
    sizes = list(range(5, 160)) + [997, 998, 999, 1000, 1001]
    rows = spark.createDataFrame([(n,) for n in sizes], "n int").select(
        "n", F.explode(F.sequence(F.lit(1), "n")).alias("r")
    )
    got = rows.select("n", "r", rules.quintile(F.col("r"), F.col("n")).alias("q")).toPandas()
    for n, part in got.groupby("n"):
        part = part.sort_values("r")
        expected = pd.qcut(part["r"], 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert (part["q"].to_numpy() == expected.to_numpy()).all(), n
        sizes_ = part["q"].value_counts()
        assert sizes_.max() - sizes_.min() <= 1


def test_quintile_of_tiny_groups(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (1, 3), (2, 3), (3, 3)], "r int, n int")
    got = [x[0] for x in rows.select(rules.quintile(F.col("r"), F.col("n"))).collect()]
    assert got == [1, 1, 5, 1, 3, 5]


def test_segments_cover_every_score_pair(spark):
    pairs = [(r, fm) for r in range(1, 6) for fm in range(1, 6)]
    df = spark.createDataFrame(pairs, "r int, fm int")
    got = {(x["r"], x["fm"]): x["s"] for x in
           df.select("r", "fm", rules.rfm_segment(F.col("r"), F.col("fm")).alias("s")).collect()}
    for fm in (4, 5):
        assert got[4, fm] == got[5, fm] == "Campeones"
        assert got[3, fm] == "Leales"
    assert got[5, 3] == got[4, 3] == got[3, 3] == "Leales"
    assert {got[r, fm] for r in (4, 5) for fm in (1, 2)} == {"Potenciales"}
    assert {got[3, fm] for fm in (1, 2)} == {"Necesitan atención"}
    assert {got[r, fm] for r in (1, 2) for fm in (3, 4, 5)} == {"En riesgo"}
    assert {got[r, fm] for r in (1, 2) for fm in (1, 2)} == {"Hibernando / Perdidos"}
    assert set(got.values()) == set(rules.SEGMENT_ACTIONS)


def test_xyz_thresholds(spark):
    got = apply(spark, [0.0, 0.2999, 0.30, 0.5999, 0.60, 9.0, None], "double", rules.xyz_class)
    assert got == ["X", "X", "Y", "Y", "Z", "Z", "Z"]


def test_abc_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(80,), (81,), (95,), (96,)], "run int").select(
        rules.abc_class(F.col("run").cast("decimal(12,2)"), F.lit(100).cast("decimal(12,2)"))
    )
    assert [r[0] for r in df.collect()] == ["A", "B", "B", "C"]


def test_coverage_states(spark):
    days = [0.0, 6.99, 7.0, 13.99, 14.0, 90.0, 90.01, 180.0, 180.01, 9999.0]
    got = apply(spark, days, "double", rules.coverage_state)
    assert got == ["QUIEBRE"] * 2 + ["CRÍTICO"] * 2 + ["NORMAL"] * 2 + ["SOBRESTOCK"] * 2 + ["STOCK MUERTO"] * 2


def test_service_light(spark):
    got = apply(spark, [-1, 0, 29, 30, 59, 60], "int", rules.service_light)
    assert got == ["VENCIDO", "URGENTE", "URGENTE", "PRÓXIMO", "PRÓXIMO", "OK"]


def test_oee_rating(spark):
    got = apply(spark, [0.85, 0.849, 0.65, 0.649], "double", rules.oee_rating)
    assert got == ["Excelente ≥ 85%", "Aceptable ≥ 65%", "Aceptable ≥ 65%", "Bajo < 65%"]


def test_state_from_label_takes_the_first_known_state(spark):
    labels = ["🔴 QUIEBRE", "🟡 SOBRESTOCK", "🔴 STOCK MUERTO", "NORMAL o CRÍTICO", "otro", "", None]
    got = apply(spark, labels, "string", rules.state_from_label)
    assert got == ["QUIEBRE", "SOBRESTOCK", "STOCK MUERTO", "CRÍTICO", None, None, None]


def test_machine_and_cause_labels(spark):
    assert apply(spark, [1, 3, 4, 5, 6], "int", rules.machine_plan) == [
        "Plan preventivo urgente", "Plan preventivo urgente", "Monitorear", "Monitorear",
        "Sin intervención prioritaria",
    ]
    df = spark.createDataFrame([(1, 0.9), (2, 0.80), (3, 0.81)], "r int, c double")
    got = [x[0] for x in df.select(rules.cause_label(F.col("r"), F.col("c"))).collect()]
    assert got == ["Causa principal", "Top 3 — 80 % del downtime", "Causa secundaria"]


def test_the_two_roundings_differ_on_ties(spark):
    row = spark.createDataFrame([(1, 800)], "a int, b int").select(
        percent("a", "b", 2).alias("up"), percent_even("a", "b", 2).alias("even")
    ).first()
    assert (row["up"], row["even"]) == (pytest.approx(0.13), pytest.approx(0.12))


def test_zero_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    row = df.select(ratio("a", "b").alias("r"), zero_to_one("b").alias("one")).first()
    assert row["r"] is None and row["one"] == 1.0
