"""Label rules: scores, classes, states and traffic lights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: labels and texts that the published reports use. -------------------------
CHAMPIONS = "Campeones"
LOYAL = "Leales"
POTENTIAL = "Potenciales"
NEEDS_ATTENTION = "Necesitan atención"
AT_RISK = "En riesgo"
HIBERNATING = "Hibernando / Perdidos"

SEGMENT_ACTIONS = {
    "Campeones": "Fidelizar: programa VIP y acceso anticipado",
    "Leales": "Upsell y recompensas por lealtad",
    "Potenciales": "Incentivar la segunda compra (frecuencia)",
    "Necesitan atención": "Ofertas reactivadoras antes de que se enfríen",
    "En riesgo": "Campaña de recuperación URGENTE (cupón dirigido)",
    "Hibernando / Perdidos": "Recuperación de bajo costo; no sobreinvertir",
}

COVERAGE_STATES = ["QUIEBRE", "CRÍTICO", "NORMAL", "SOBRESTOCK", "STOCK MUERTO"]
COVERAGE_ACTIONS = {
    "QUIEBRE": "REPOSICIÓN URGENTE",
    "CRÍTICO": "Revisar orden de compra",
    "NORMAL": "Stock en niveles óptimos",
    "SOBRESTOCK": "Reducir próxima compra",
    "STOCK MUERTO": "LIQUIDAR / DEVOLVER",
}
# Order of the alert panel: out of stock, dead stock, overstock, critical.
ALERT_PRIORITY = {"QUIEBRE": 1, "STOCK MUERTO": 2, "SOBRESTOCK": 3, "CRÍTICO": 4}

SERVICE_OVERDUE, SERVICE_URGENT, SERVICE_SOON, SERVICE_OK = "VENCIDO", "URGENTE", "PRÓXIMO", "OK"
OEE_EXCELLENT, OEE_ACCEPTABLE, OEE_LOW = "Excelente ≥ 85%", "Aceptable ≥ 65%", "Bajo < 65%"
CAUSE_MAIN, CAUSE_TOP, CAUSE_SECONDARY = "Causa principal", "Top 3 — 80 % del downtime", "Causa secundaria"
MACHINE_URGENT = "Plan preventivo urgente"
MACHINE_MONITOR = "Monitorear"
MACHINE_NONE = "Sin intervención prioritaria"
# --------------------------------------------------------------------------------------------


def value_rows(spark: SparkSession, column: str, values: list) -> DataFrame:
    """A fixed list of values as rows, with their position in ``_order``."""
    listed = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.posexplode(listed).alias("_order", column))


def lookup(col: Column, table: dict, default=None) -> Column:
    """Map values through a small fixed table; unknown values give ``default``."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, col)
    return found if default is None else F.coalesce(found, F.lit(default))


def quintile(rank: Column, total: Column) -> Column:
    """Bin 1..5 of row ``rank`` (from 1) among ``total`` rows, with edges at the linear quantiles."""
    steps = (F.lit(5) * (rank - 1)).cast("bigint")
    gaps = (total - 1).cast("bigint")
    # ceil(steps / gaps) in whole numbers
    quotient = F.call_function("div", steps + gaps - 1, F.when(gaps > 0, gaps))
    return F.greatest(F.lit(1), F.coalesce(quotient, F.lit(1))).cast("int")


def rfm_segment(r: Column, fm: Column) -> Column:
    """Segment from the recency score and the joint frequency-money score; first match wins."""
    recent, fading = r >= 4, r <= 2
    valuable = fm >= 3
    return (
        F.when(recent & (fm >= 4), CHAMPIONS)
        .when(~fading & valuable, LOYAL)
        .when(recent, POTENTIAL)
        .when(~fading, NEEDS_ATTENTION)
        .when(valuable, AT_RISK)
        .otherwise(HIBERNATING)
    )


def abc_class(running: Column, total: Column, a: str = "0.80", b: str = "0.95") -> Column:
    """Class by cumulative share; compared as exact decimals, so a share of just 80 % is still A."""
    share = lambda limit: F.lit(limit).cast("decimal(4,2)") * total
    return F.when(running <= share(a), "A").when(running <= share(b), "B").otherwise("C")


def xyz_class(cv: Column, x: float = 0.30, y: float = 0.60) -> Column:
    """Class by coefficient of variation; an unknown one counts as erratic."""
    return F.when(cv < x, "X").when(cv < y, "Y").otherwise("Z")


def coverage_state(days: Column, limits: tuple = (7, 14, 90, 180)) -> Column:
    out, critical, normal, over = limits
    return (
        F.when(days < out, COVERAGE_STATES[0])
        .when(days < critical, COVERAGE_STATES[1])
        .when(days <= normal, COVERAGE_STATES[2])
        .when(days <= over, COVERAGE_STATES[3])
        .otherwise(COVERAGE_STATES[4])
    )


def state_from_label(label: Column) -> Column:
    """First known state named anywhere in a free-form label, null if none is."""
    return F.coalesce(*[F.when(F.contains(label, F.lit(s)), s) for s in COVERAGE_STATES])


def service_light(days_left: Column, urgent: int = 30, soon: int = 60) -> Column:
    return (
        F.when(days_left < 0, SERVICE_OVERDUE)
        .when(days_left < urgent, SERVICE_URGENT)
        .when(days_left < soon, SERVICE_SOON)
        .otherwise(SERVICE_OK)
    )


def oee_rating(oee: Column, excellent: float = 0.85, acceptable: float = 0.65) -> Column:
    return F.when(oee >= excellent, OEE_EXCELLENT).when(oee >= acceptable, OEE_ACCEPTABLE).otherwise(OEE_LOW)


def cause_label(rank: Column, cumulative: Column, top: float = 0.80) -> Column:
    return F.when(rank == 1, CAUSE_MAIN).when(cumulative <= top, CAUSE_TOP).otherwise(CAUSE_SECONDARY)


def machine_plan(rank: Column, urgent: int = 3, monitor: int = 5) -> Column:
    return F.when(rank <= urgent, MACHINE_URGENT).when(rank <= monitor, MACHINE_MONITOR).otherwise(MACHINE_NONE)
