"""Readers: columns by name, typed by the table's schema."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.operators.downtime import PLANNED, UNPLANNED, with_rates
from bizops.operators.ordered import with_order
from bizops.sources.schemas import INVENTORY, MACHINE_RATES, PLANT, STAR, UNPLANNED_LABEL, Table

BYTE_ORDER_MARK = "\ufeff"


def load_tables(
    spark: SparkSession, folder: str, tables: dict[str, Table], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Read ``<folder>/<table>.<fmt>`` for each table, typed and under the operators' names.

    Columns are found by their names, in any order; further ones are ignored and a missing one is
    an error.  CSV files have a header line and may start with a byte-order mark; cells that are
    not of their column's type become null.
    """
    return {name: _read(spark, f"{folder}/{name}.{fmt}", table, fmt) for name, table in tables.items()}


def _read(spark: SparkSession, path: str, table: Table, fmt: str) -> DataFrame:
    if fmt == "csv":
        raw = spark.read.csv(path, header=True, encoding="UTF-8", inferSchema=False)
        raw = raw.toDF(*[c.removeprefix(BYTE_ORDER_MARK) for c in raw.columns])
    else:
        raw = spark.read.format(fmt).load(path)
    return table.rename(raw, path)


def load_star(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """sales, customers, products, stores."""
    t = load_tables(spark, folder, STAR, fmt)
    return {
        "sales": t["ventas"],
        "customers": t["clientes"],
        "products": t["productos"],
        "stores": t["sucursales"],
    }


def load_inventory(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """products, demand, stock; demand months become dates."""
    t = load_tables(spark, folder, INVENTORY, fmt)
    demand = t["demanda_mensual"].withColumn("month_start", F.to_date("month", "yyyy-MM")).drop("month")
    return {"products": t["productos"], "demand": demand, "stock": t["inventario_actual"]}


def load_plant(spark: SparkSession, folder: str, fmt: str = "csv", rates: DataFrame | None = None) -> dict[str, DataFrame]:
    """machines and stoppages, ready for the downtime operators.

    Stoppage hours become exact minutes and the file's stop types the operators' labels.  Machines
    get their performance and quality rates from ``rates`` (machine_name, performance, quality),
    by default the published ones.
    """
    t = load_tables(spark, folder, PLANT, fmt)
    kind = F.when(F.col("stop_type") == UNPLANNED_LABEL, UNPLANNED).when(F.col("stop_type").isNotNull(), PLANNED)
    stoppages = t["registro_paros"].withColumn("minutes", (F.col("hours") * 60).cast("decimal(12,2)")).withColumn("stop_type", kind)
    return {"machines": with_rates(t["equipos"], published_rates(spark) if rates is None else rates), "stoppages": stoppages}


def published_rates(spark: SparkSession) -> DataFrame:
    """The published performance and quality rates by machine name."""
    listed = F.array(*[F.struct(F.lit(n).alias("machine_name"), F.lit(p).alias("performance"), F.lit(q).alias("quality"))
                       for n, (p, q) in MACHINE_RATES.items()])
    return spark.range(1).select(F.inline(listed))


def read_sheet(spark: SparkSession, path: str, header_row: int = 1, columns: int | None = None) -> DataFrame:
    """A sheet's CSV export as text columns named by the record that starts in line ``header_row``.

    The lines above the header are skipped; blank lines are ignored.  Every file below ``path`` is
    one export with the same lines on top.  Cells may hold line breaks between quotes (a quote inside
    such a cell is doubled); a break in a cell becomes a line feed.  ``columns`` gives the number of
    cells to take (default: all of the header); cells without a name become ``col<n>``.

    Files are split like any text: each split counts its lines and quotes, the counts of the splits
    before it give every line its number and tell whether a cell is still open, and only the lines of
    records that go over several lines are brought together.
    """
    lines = _numbered(spark.read.text(path))
    # Lines that are a record of their own stay where they are.
    single = lines.where("NOT _inside AND NOT _open").select("_file", F.col("_line").alias("_at"), "value")
    open_ = lines.where("_inside OR _open").withColumn("_starts", (~F.col("_inside")).cast("bigint"))
    # The running count of records that start, over all files, numbers them.
    numbered = with_order(open_, ["_file", "_line"], value="_starts")
    parts = numbered.groupBy("_file", F.col("running").alias("_record")).agg(
        F.min("_line").alias("_at"), F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("_parts"))
    joined = parts.select("_file", "_at", F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value"))
    records = single.unionByName(joined)
    first = F.min_by("value", F.struct("_at", "_file"))
    head = records.where(F.col("_at") == header_row).agg(first.alias("head")).first()["head"]
    if not head:
        raise ValueError(f"{path} has no header in line {header_row}")
    cells = next(csv.reader(io.StringIO(head.lstrip(BYTE_ORDER_MARK), newline="")))
    names = [c.strip() or f"col{i}" for i, c in enumerate(cells, 1)][:columns]
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = records.where((F.col("_at") > header_row) & (F.trim("value") != ""))
    return rows.select(F.from_csv("value", schema, {"escape": '"', "multiLine": "true"}).alias("row")).select("row.*")


def _numbered(text: DataFrame) -> DataFrame:
    """The lines of text files with _file, _line (from 1), _inside (the line begins within an open
    cell) and _open (it ends within one).

    A cell is open after an odd number of quotes.  What goes through one task is a split of a file,
    never a file, and one row per split for the sums.
    """
    lines = text.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"), F.length(F.regexp_replace("value", '[^"]', "")).alias("_quotes"),
    )
    whole = lines.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.sum("_quotes").alias("_q"))
    before = W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    starts = whole.select(
        F.col("_file").alias("_f"), F.col("_split").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_lines_before"), F.coalesce(F.sum("_q").over(before), F.lit(0)).alias("_quotes_before"),
    )
    inside = W.partitionBy("_file", "_split").orderBy("_id")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = lines.withColumns({"_nth": F.row_number().over(inside), "_sum": F.sum("_quotes").over(upto)})
    return counted.join(starts, (F.col("_file") == F.col("_f")) & (F.col("_split") == F.col("_s"))).select(
        "value", "_file", (F.col("_lines_before") + F.col("_nth")).alias("_line"),
        ((F.col("_quotes_before") + F.col("_sum") - F.col("_quotes")) % 2 == 1).alias("_inside"),
        ((F.col("_quotes_before") + F.col("_sum")) % 2 == 1).alias("_open"),
    )


def clean_extract(
    df: DataFrame, key: str, category: str, valid: Sequence[str], numeric: Iterable[str]
) -> DataFrame:
    """Clean a sheet export: rows with a key that is not blank and a known category; bad numbers
    become null."""
    kept = df.where((F.trim(F.col(key).cast("string")) != "") & F.col(category).isin(list(valid)))
    return kept.withColumns({c: F.col(c).try_cast("double") for c in numeric})
