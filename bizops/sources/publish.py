"""Writers and the readers of what they published.

Every table is written by the executors; nothing is collected.  What was published before stays
readable until the new contents are complete (see ``manifest``).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizops.operators.abcxyz import CLASSIFICATION_COLUMNS, POLICY_COLUMNS
from bizops.session import cut_lineage
from bizops.sources import manifest

_ONLY = "table"  # the entry of a path that holds one table


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("encoding", "UTF-8")
    writer.save(path)


def publish(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Publish one table at ``path``, in place of what was there."""
    publish_report({_ONLY: df}, path, fmt)


def publish_report(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Publish several named tables at ``path``; readers see all old ones or all new ones."""
    folders = {name: manifest.new_folder(name) for name in tables}
    for name, df in tables.items():
        _write(df, f"{path}/{folders[name]}", fmt)
    manifest.commit(path, folders)


def read_published(spark: SparkSession, path: str, name: str = _ONLY, fmt: str = "parquet") -> DataFrame:
    """One published table as it is now."""
    folder = manifest.current(path).get(name)
    if folder is None:
        raise ValueError(f"nothing is published as {name} at {path}")
    reader = spark.read.option("header", True).option("encoding", "UTF-8") if fmt == "csv" else spark.read
    # The folder of this write is the base, so its name does not become a column.
    return reader.option("basePath", f"{path}/{folder}").format(fmt).load(f"{path}/{folder}")


def publish_inventory(policy: DataFrame, path: str, fmt: str = "csv") -> None:
    """Publish the classification and the policy table; the policy is computed once for both."""
    once = cut_lineage(policy)
    publish_report({"classification": once.select(*CLASSIFICATION_COLUMNS), "policy": once.select(*POLICY_COLUMNS)}, path, fmt)


def previous_month(as_of: str) -> str:
    """The month before ``as_of`` (``yyyy-MM-dd``) as ``yyyy-MM``."""
    last_day = date.fromisoformat(as_of).replace(day=1) - timedelta(days=1)
    return f"{last_day:%Y-%m}"


def snapshot(df: DataFrame, path: str, as_of: str) -> str:
    """Freeze ``df`` as the report of the month before ``as_of``.

    Only that month changes, and only once its new report is complete; a report without rows
    leaves an empty month.  Returns the month.
    """
    month = previous_month(as_of)
    folder = manifest.new_folder(f"data/period={month}")
    df.write.parquet(f"{path}/{folder}")
    manifest.commit(path, manifest.current(path) | {month: folder})
    return month


def freeze_months(states: DataFrame, path: str, months: list[str]) -> None:
    """Keep the states of some months (rows of ``month``) beside those of the others, all at once.

    A month that is frozen again is replaced.
    """
    folders = {m: manifest.new_folder(f"data/period={m}") for m in months}
    for m, folder in folders.items():
        states.where(F.col("month") == m).write.parquet(f"{path}/{folder}")
    manifest.commit(path, manifest.current(path) | folders)


def read_snapshots(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The frozen reports of all (or some) months with their ``period``; only the named months'
    folders are listed and read."""
    frozen = manifest.current(path)
    folders = [f"{path}/{frozen[m]}" for m in sorted(frozen) if months is None or m in months]
    if not folders:
        raise ValueError(f"no month is frozen at {path}")
    read = spark.read.option("basePath", f"{path}/data").parquet(*folders)
    return read.withColumn("period", F.date_format(F.to_date(F.col("period").cast("string").substr(1, 7), "yyyy-MM"), "yyyy-MM")).drop("v")


def save_star(tables: dict[str, DataFrame], path: str, fact: str = "sales", date_col: str = "sale_date") -> None:
    """Persist a star schema for repeated querying: dimensions whole, the fact by month.

    The rebalance hint evens out file sizes at run time: small months share a task, a month that
    holds much of the fact is split over many.  A star saved before stays readable until this one
    is complete.
    """
    folders = {name: manifest.new_folder(name) for name in tables}
    for name, df in tables.items():
        if name != fact:
            _write(df, f"{path}/{folders[name]}", "parquet")
    monthly = tables[fact].withColumn("sale_month", F.date_format(date_col, "yyyy-MM"))
    monthly.hint("rebalance", F.col("sale_month")).write.partitionBy("sale_month").parquet(f"{path}/{folders[fact]}")
    manifest.commit(path, folders)


def read_star(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: read_published(spark, path, name) for name in names}
