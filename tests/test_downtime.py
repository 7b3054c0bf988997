"""Stoppages, service dates and effectiveness."""

from datetime import date
from decimal import Decimal as D

import pytest

from bizops.operators import downtime, impact

# --- Fixed values: published machine list: id, hourly cost, last service, interval, next, days left, light.
MACHINES = [
    (1, 10500, "2024-08-15", 180, "2025-02-11", 41, "PRÓXIMO"),
    (2, 10500, "2024-09-20", 180, "2025-03-19", 77, "OK"),
    (3, 13200, "2024-03-10", 120, "2024-07-08", -177, "VENCIDO"),
    (4, 11800, "2024-10-05", 180, "2025-04-03", 92, "OK"),
    (5, 9800, "2024-07-22", 150, "2024-12-19", -13, "VENCIDO"),
    (6, 14500, "2024-02-18", 120, "2024-06-17", -198, "VENCIDO"),
    (7, 12000, "2024-04-30", 120, "2024-08-28", -126, "VENCIDO"),
    (8, 11200, "2024-11-10", 180, "2025-05-09", 128, "OK"),
]


@pytest.fixture(scope="module")
def machines(spark):
    return spark.createDataFrame(
        [(m, c, date.fromisoformat(d), i, 0.9, 0.98) for m, c, d, i, *_ in MACHINES],
        "machine_id int, hourly_cost int, last_service date, service_interval_days int,"
        "performance double, quality double",
    )


@pytest.fixture(scope="module")
def stoppages(spark):
    rows = [
        (1, "2024-01-02", 3, "unplanned", "mechanical", "300"),
        (2, "2024-01-03", 3, "unplanned", "electrical", "60"),
        (3, "2024-02-03", 6, "unplanned", "mechanical", "240"),
        (4, "2024-02-04", 6, "planned", "planned", "600"),
        (5, "2024-02-05", 1, "unplanned", "operational", "30"),
        (6, "2024-02-06", 99, "unplanned", "operational", "90"),  # not in the machine list
    ]
    return spark.createDataFrame(
        [(i, date.fromisoformat(d), m, t, c, D(n)) for i, d, m, t, c, n in rows],
        "stoppage_id int, stop_date date, machine_id int, stop_type string, cause string, minutes decimal(12,2)",
    )


def test_service_dates_match_the_published_list(machines):
    got = {r["machine_id"]: r for r in downtime.service_light(machines, "2025-01-01").collect()}
    for m, _, _, _, due, left, light in MACHINES:
        assert (str(got[m]["next_service"]), got[m]["days_left"], got[m]["light"]) == (due, left, light)


def test_lights_can_be_recomputed_at_another_date(machines):
    got = {r["machine_id"]: r["light"] for r in downtime.service_light(machines, "2025-02-01").collect()}
    assert got[1] == "URGENTE" and got[2] == "PRÓXIMO"


def test_cost_uses_half_even_rounding(spark, machines):
    df = spark.createDataFrame([(1, 1, D("0.10")), (2, 8, D("0.15")), (3, 42, D("1.00"))],
                               "stoppage_id int, machine_id int, minutes decimal(12,2)")
    got = {r["stoppage_id"]: r["cost"] for r in downtime.stoppage_cost(df, machines).collect()}
    assert got == {1: 18.0, 2: 28.0, 3: None}  # 17.5 -> 18, 28.0, unknown machine


def test_machines_without_stoppages_stay_at_zero(stoppages, machines):
    got = {r["machine_id"]: r["hours"] for r in downtime.downtime_by_machine(stoppages, machines).collect()}
    assert got == {1: 0.5, 2: 0.0, 3: 6.0, 4: 0.0, 5: 0.0, 6: 4.0, 7: 0.0, 8: 0.0}


def test_effectiveness_is_clipped_and_sorted_worst_first(stoppages, machines):
    rows = downtime.oee(stoppages, machines, available_hours=5).collect()
    assert rows[0]["machine_id"] == 3 and rows[0]["availability"] == 0.0 and rows[0]["rating"] == "Bajo < 65%"
    assert rows[-1]["oee"] == pytest.approx(0.882) and rows[-1]["rating"] == "Excelente ≥ 85%"


def test_published_effectiveness(spark):
    """8 h a day over a year; 5.4 % of it stopped at 79 % performance and 95 % quality is 68.6 %."""
    machine = spark.createDataFrame([(6, 0.79, 0.95)], "machine_id int, performance double, quality double")
    stop = spark.createDataFrame([(6, "unplanned", D("15060.00"))],
                                 "machine_id int, stop_type string, minutes decimal(12,2)")
    row = downtime.oee(stop, machine, 2920).first()
    assert row["hours"] == 251.0 and row["oee"] == pytest.approx(0.686, abs=5e-4)


def test_kpis_count_unlisted_machines_in_cost_and_events_only(stoppages, machines):
    costed = downtime.stoppage_cost(stoppages, machines)
    row = downtime.downtime_kpis(costed, machines, 2920).first()
    assert row["hours"] == 10.5 and row["events"] == 5
    assert row["cost"] == 5 * 13200 + 13200 + 4 * 14500 + 5250
    expected = sum((2920 - h) / 2920 * 0.9 * 0.98 for h in (0.5, 0, 6, 0, 0, 4, 0, 0)) / 8
    assert row["mean_oee"] == pytest.approx(expected)


def test_pareto(stoppages):
    rows = downtime.downtime_pareto_machine(stoppages).collect()
    assert [(r["machine_id"], r["rank"], r["hours"]) for r in rows] == [(3, 1, 6.0), (6, 2, 4.0), (99, 3, 1.5), (1, 4, 0.5)]
    assert rows[-1]["cumulative_share"] == 1.0 and rows[-1]["plan"] == "Monitorear"
    causes = downtime.downtime_pareto_cause(stoppages).collect()
    assert [(r["cause"], r["label"]) for r in causes] == [
        ("mechanical", "Causa principal"), ("operational", "Causa secundaria"), ("electrical", "Causa secundaria")]


def test_shares_and_savings(stoppages, machines):
    assert downtime.critical_share(stoppages, [3, 6]).first()["share"] == pytest.approx(10 / 12)
    assert downtime.critical_share_top(stoppages, 2).first()["share"] == pytest.approx(10 / 12)
    saving = impact.preventive_saving(stoppages, machines, k=2).first()
    assert saving["weighted_hourly_cost"] == pytest.approx((6 * 13200 + 4 * 14500) / 10)
    assert saving["saving"] == pytest.approx((6 * 13200 + 4 * 14500) * 0.65)
    cause = impact.cause_reduction_saving(stoppages, "mechanical").first()
    assert cause["hours_saved"] == pytest.approx(9 * 0.4) and cause["saving"] == pytest.approx(9 * 0.4 * 12000)
    assert impact.cause_reduction_saving(stoppages, "none").first()["saving"] == 0.0


def test_published_cause_estimate(spark):
    """540 h of mechanical failures cut by 40 % at 12,000 an hour is 2.6 M."""
    stop = spark.createDataFrame([("unplanned", "mechanical", D(540 * 60))],
                                 "stop_type string, cause string, minutes decimal(12,2)")
    row = impact.cause_reduction_saving(stop, "mechanical").first()
    assert row["hours_saved"] == pytest.approx(216) and row["saving"] == pytest.approx(2.6e6, abs=1e4)


def test_monthly_cut(stoppages):
    rows = downtime.monthly_stoppages(stoppages, "stop_type").collect()
    assert [(r["month"], r["stop_type"], r["events"], r["hours"]) for r in rows] == [
        ("2024-01", "unplanned", 2, 6.0), ("2024-02", "planned", 1, 10.0), ("2024-02", "unplanned", 3, 6.0)]
