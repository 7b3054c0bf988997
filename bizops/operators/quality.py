"""Data-quality rules, reconciliation and detection scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.functions.numeric import count_where, ratio, sum_where
from bizops.session import cut_lineage


def key_counts(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(kind, key, rows): how many rows hold each value of each key column, in one pass.

    Keys become text.  The counts are summed on the map side, so a hot key is one row per task by
    the time it is shuffled.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in keys]))
    return fact.select(each.alias("_k")).groupBy("_k.kind", "_k.key").agg(F.count(F.lit(1)).alias("rows"))


def orphan_rows(counted: DataFrame, known: DataFrame) -> DataFrame:
    """Rows behind the counted keys that are missing from ``known`` (null keys included)."""
    there = known.select(F.col("key").cast("string").alias("key")).distinct()
    missing = counted.select("key", "rows").join(there, "key", "left_anti")
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"))


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key is missing from the dimension (null keys included).

    Both sides are reduced to distinct keys before the anti join, so a hot key is one row by then.
    """
    return orphan_rows(key_counts(fact, [fact_key]), dim.select(F.col(dim_key or fact_key).alias("key")))


def quality_report(
    sales: DataFrame,
    customers: DataFrame,
    id_col: str = "ticket_id",
    atol: float = 0.01,
    rtol: float = 1e-5,
) -> DataFrame:
    """Failing rows per rule: null ids, repeated rows, unknown customers, revenue that does not add up.

    The tolerance is ``atol`` plus ``rtol`` of the stored revenue.  The fact is read once and never
    shuffled whole: its lines are counted by customer and by a 128-bit hash of the row, and what is
    kept are the customers' counts and the hashes that come more than once.  Only if there are such
    hashes, their lines are read again and compared as whole rows.
    """
    off = F.abs(F.round(F.col("unit_price") * F.col("qty"), 2) - F.col("revenue"))
    allowed = F.lit(atol) + F.lit(rtol) * F.abs("revenue")
    hashed = _with_hash(sales)
    narrow = hashed.select(
        "customer_id", *_HASH, F.col(id_col).isNull().cast("int").alias("_null"), F.coalesce((off > allowed).cast("int"), F.lit(0)).alias("_off")
    )
    keys = ["customer_id", *_HASH]
    counted = cut_lineage(
        narrow.groupingSets([["customer_id"], list(_HASH)], *keys)
        .agg(F.grouping("customer_id").alias("_by_hash"), F.count(F.lit(1)).alias("_rows"),
             F.sum("_null").alias("null_ids"), F.sum("_off").alias("revenue_mismatch"))
        .where("_by_hash = 0 OR _rows > 1")
    )
    per_customer = counted.where("_by_hash = 0")
    found = per_customer.agg(*[F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in ("null_ids", "revenue_mismatch")])
    orphans = per_customer.join(customers.select("customer_id").distinct(), "customer_id", "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("failing_rows")
    )
    return (
        found.unpivot([], ["null_ids", "revenue_mismatch"], "rule", "failing_rows")
        .unionByName(_repeated_rows(hashed, counted.where("_by_hash = 1").select(*_HASH)).withColumn("rule", F.lit("duplicate_rows")))
        .unionByName(orphans.withColumn("rule", F.lit("orphan_customers")))
    )


_HASH = ("_h1", "_h2")


def _with_hash(df: DataFrame) -> DataFrame:
    """Adds two 64-bit hashes of the whole row; where the nulls are is part of them."""
    nulls = reduce(Column.__add__, [F.col(c).isNull().cast("bigint") * (1 << i % 62) for i, c in enumerate(df.columns)])
    return df.withColumns({"_h1": F.xxhash64(nulls, *df.columns), "_h2": F.xxhash64(F.lit("second"), *reversed(df.columns), nulls)})


def _repeated_rows(hashed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows beyond the first of every group of equal rows, among those with a repeated hash."""
    if repeated.isEmpty():
        return hashed.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("failing_rows"))
    suspects = hashed.join(repeated, list(_HASH), "left_semi").drop(*_HASH)
    equal = suspects.groupBy(*suspects.columns).agg((F.count(F.lit(1)) - 1).alias("_n"))
    return equal.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failing_rows"))


def rolled_totals(sales: DataFrame, dim: str) -> tuple[DataFrame, DataFrame]:
    """Lines, revenue and margin of the whole fact and of every ``dim``, from one pass over it."""
    rolled = cut_lineage(sales.rollup(dim).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
        F.grouping(dim).alias("_all"),
    ))
    return rolled.where("_all = 1").drop("_all", dim), rolled.where("_all = 0").drop("_all")


def control_totals(totals: DataFrame, derived: DataFrame) -> DataFrame:
    """Reconcile a derived table with the fact it came from.

    Both are summed over lines, revenue and margin; without a ``lines`` column, as in the fact
    itself, every row is a line.
    """
    names = ["lines", "revenue", "margin"]
    if "lines" not in totals.columns:
        totals = totals.withColumn("lines", F.lit(1))

    def long(df: DataFrame, value: str) -> DataFrame:
        sums = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,4)").alias(c) for c in names])
        return sums.unpivot([], names, "total", value)

    return long(totals, "expected").join(long(derived, "actual"), "total").withColumn(
        "difference", F.col("actual") - F.col("expected")
    )


def dates_out_of_range(sales: DataFrame, start: str, end: str, rows: str | None = None) -> DataFrame:
    """Sale lines dated outside ``[start, end)`` or undated; ``rows`` names a column of line counts
    if ``sales`` is already counted by date."""
    date = F.col("sale_date")
    outside = (date < F.lit(start).cast("date")) | (date >= F.lit(end).cast("date")) | date.isNull()
    return sales.agg((sum_where(outside, rows) if rows else count_where(outside)).alias("rows"))


def unused_members(dim: DataFrame, sales: DataFrame, key: str) -> DataFrame:
    """Dimension members without a single sale; only the key column of ``sales`` is read."""
    return dim.join(sales.select(key).distinct(), key, "left_anti").agg(F.count(F.lit(1)).alias("rows"))


def check_report(checks: dict[str, DataFrame]) -> DataFrame:
    """Several one-row checks as one table."""
    rows = [df.select(F.lit(name).alias("check"), "rows") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def detection_score(found: DataFrame, truth: DataFrame, key: str, flag: str) -> DataFrame:
    """Precision and recall of the found keys against a true/false column of the master table."""
    marked = truth.join(found.select(key).distinct().withColumn("_found", F.lit(True)), key, "left")
    hit, real = F.coalesce("_found", F.lit(False)), F.col(flag)
    sums = marked.agg(
        count_where(hit & real).alias("true_positives"),
        count_where(hit).alias("found"),
        count_where(real).alias("actual"),
    )
    return sums.withColumns(
        {"precision": ratio("true_positives", "found"), "recall": ratio("true_positives", "actual")}
    )

