"""Readers and writers."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bizops.operators import abcxyz, downtime
from bizops.operators.profit import in_period
from bizops.sources import load, manifest, publish
from bizops.sources.schemas import INVENTORY, PLANT, STAR, UNPLANNED_LABEL

BOM = load.BYTE_ORDER_MARK


def header(table):
    return ",".join(table.columns) + "\n"


def write(path, text):
    path.write_text(text, encoding="utf-8")


def test_inventory_csv_with_byte_order_mark(spark, tmp_path):
    write(tmp_path / "productos.csv",
          BOM + header(INVENTORY["productos"]) + "SKU-002,LÁC-002,Lácteos,A,9251,6454,12,5835\n")
    write(tmp_path / "demanda_mensual.csv",
          BOM + header(INVENTORY["demanda_mensual"]) + "SKU-002,2024-01,60\nSKU-002,2024-02,80\n")
    write(tmp_path / "inventario_actual.csv", BOM + header(INVENTORY["inventario_actual"]) + "SKU-002,11,2025-01\n")
    t = load.load_inventory(spark, str(tmp_path))
    assert t["products"].first()["name"] == "LÁC-002"
    assert [r["month_start"] for r in t["demand"].orderBy("month_start").collect()] == [date(2024, 1, 1), date(2024, 2, 1)]
    row = abcxyz.inventory_policy(abcxyz.abc_xyz(t["demand"], t["products"], t["stock"])).first()
    assert row["class"] == "CX" and row["demand_avg"] == 70.0 and row["below_reorder_point"]


def test_star_csv_is_typed(spark, tmp_path):
    write(tmp_path / "ventas.csv",
          header(STAR["ventas"]) + "1,2024-01-02,C1,P1,S1,3,10.10,0.1,4.0,30.3,12.0,18.3\n")
    write(tmp_path / "clientes.csv",
          header(STAR["clientes"]) + "C1,Ana,A,X,Sur,2023-01-01,True\n")
    write(tmp_path / "productos.csv",
          header(STAR["productos"]) + "P1,uno,c,4.0,11.2,False,True\n")
    write(tmp_path / "sucursales.csv", header(STAR["sucursales"]) + "S1,Sur,Bariloche,Sur\n")
    t = load.load_star(spark, str(tmp_path), fmt="csv")
    sale = t["sales"].first()
    assert (sale["sale_date"], sale["revenue"], sale["discount"]) == (date(2024, 1, 2), D("30.30"), D("0.10"))
    assert t["customers"].first()["is_churn"] is True and t["products"].first()["is_slow_mover"] is True
    assert t["stores"].first()["store_name"] == "Sur"


def test_plant_csv_hours_become_exact_minutes(spark, tmp_path):
    write(tmp_path / "equipos.csv",
          BOM + header(PLANT["equipos"]) + "1,CNC,Línea A,10500,2024-08-15,2025-02-11,41,180\n")
    write(tmp_path / "registro_paros.csv",
          BOM + header(PLANT["registro_paros"])
          + f"2024-01-02,1,CNC,Línea A,Turno 1,{UNPLANNED_LABEL},Mecánica,Falla,1.1,11550\n")
    t = load.load_plant(spark, str(tmp_path))
    assert t["machines"].first()["hourly_cost"] == 10500
    assert t["stoppages"].first()["minutes"] == D("66.00")


def test_columns_are_found_by_name(spark, tmp_path):
    write(tmp_path / "x.csv", BOM + "ciudad,extra,id_sucursal,region,nombre_sucursal\nBariloche,9,S1,Sur,Tienda Sur\n")
    row = load._read(spark, str(tmp_path / "x.csv"), STAR["sucursales"], "csv").first()
    assert (row["store_id"], row["store_name"], row["city"], row["region"]) == ("S1", "Tienda Sur", "Bariloche", "Sur")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_missing_column_is_an_error(spark, tmp_path, fmt):
    spark.createDataFrame([("S1", "Sur")], "id_sucursal string, region string").write.option("header", True).format(fmt).save(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nombre_sucursal, ciudad"):
        load._read(spark, str(tmp_path / "t"), STAR["sucursales"], fmt)


def test_a_bad_cell_becomes_null(spark, tmp_path):
    write(tmp_path / "inventario_actual.csv", "sku,stock_actual,fecha_corte\nA,x,2025-01\nB,7,2025-01\n")
    rows = load._read(spark, str(tmp_path / "inventario_actual.csv"), INVENTORY["inventario_actual"], "csv").orderBy("sku").collect()
    assert [r["stock_on_hand"] for r in rows] == [None, 7]


def test_plant_files_to_effectiveness(spark, tmp_path):
    """From the files to the panel without naming a label or a rate."""
    write(tmp_path / "equipos.csv", header(PLANT["equipos"]) + "1,CNC Alpha 01,A,10500,2024-08-15,2025-02-11,41,180\n2,Torno CNC 06,B,9800,2024-08-15,2025-02-11,41,180\n3,Sin datos,B,9800,2024-08-15,2025-02-11,41,180\n")
    write(tmp_path / "registro_paros.csv", header(PLANT["registro_paros"])
          + f"2024-01-02,1,CNC Alpha 01,A,T1,{UNPLANNED_LABEL},Mecánica,Falla,292,1\n2024-01-03,1,CNC Alpha 01,A,T1,Programado,Service,x,50,1\n")
    t = load.load_plant(spark, str(tmp_path))
    got = {r["machine_id"]: r for r in downtime.oee(t["stoppages"], t["machines"], 2920).collect()}
    assert got[1]["hours"] == 292 and got[1]["oee"] == pytest.approx(0.9 * 0.91 * 0.98)
    assert got[2]["hours"] == 0 and got[2]["oee"] == pytest.approx(0.79 * 0.95) and got[3]["oee"] is None
    costed = downtime.stoppage_cost(t["stoppages"], t["machines"])
    kpis = downtime.downtime_kpis(costed, t["machines"], 2920).first()
    assert (kpis["hours"], kpis["cost"], kpis["events"]) == (292, 292 * 10500, 1)
    own = spark.createDataFrame([("Sin datos", 1.0, 0.5)], "machine_name string, performance double, quality double")
    rated = load.load_plant(spark, str(tmp_path), rates=own)["machines"].where("machine_id = 3").first()
    assert (rated["performance"], rated["quality"]) == (1.0, 0.5)


def test_read_sheet_skips_the_lines_above_the_header(spark, tmp_path):
    write(tmp_path / "s.csv", BOM + 'Analysis,,\n,,\nall in pesos\nCode,,"Price, net"\nP1,x,"10,5"\n\nP2,,n/a\n')
    sheet = load.read_sheet(spark, str(tmp_path / "s.csv"), header_row=4)
    assert sheet.columns == ["Code", "col2", "Price, net"]
    assert [tuple(r) for r in sheet.collect()] == [("P1", "x", "10,5"), ("P2", None, "n/a")]
    assert load.read_sheet(spark, str(tmp_path / "s.csv"), header_row=4, columns=2).columns == ["Code", "col2"]
    with pytest.raises(ValueError, match="no header in line 40"):
        load.read_sheet(spark, str(tmp_path / "s.csv"), header_row=40)


def test_read_sheet_with_breaks_inside_cells_over_many_splits(spark, tmp_path, conf):
    """Records of one and of several lines, cut anywhere by splits far smaller than a file."""
    import csv as plain

    rows = [(str(i), ['plain', 'two\nlines', 'a "quoted" word', ',', '"\n"\n,\n', '  ', 'x' * 90][i % 7], str(i * 3)) for i in range(4000)]
    for name in ("a", "b"):
        (tmp_path / "s").mkdir(exist_ok=True)
        with open(tmp_path / "s" / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            out.write(BOM + 'title,"over\ntwo lines",\r\n\r\n')
            writer = plain.writer(out)
            writer.writerow(["Code", "Text\nof the cell", "N"])
            writer.writerows(rows)
    conf(spark__sql__files__maxPartitionBytes="2048", spark__sql__files__openCostInBytes="0", spark__sql__shuffle__partitions="4")
    sheet = load.read_sheet(spark, str(tmp_path / "s"), header_row=4)
    assert sheet.columns == ["Code", "Text\nof the cell", "N"]
    assert spark.read.text(str(tmp_path / "s")).rdd.getNumPartitions() > 50
    # from_csv drops nothing but the white space around a bare cell
    got = sorted((tuple(r) for r in sheet.collect()), key=lambda r: int(r[0]))
    want = sorted(rows * 2, key=lambda r: int(r[0]))
    assert [(a, (b or "").strip(" "), c) for a, b, c in got] == [(a, b.strip(" "), c) for a, b, c in want]


def test_clean_extract(spark):
    df = spark.createDataFrame(
        [("1", "a", "10.5"), (None, "a", "1"), ("", "a", "1"), ("  ", "a", "1"), ("2", "other", "1"), ("3", "b", "n/a"), ("4", "b", None)],
        "id string, cat string, amount string")
    rows = load.clean_extract(df, "id", "cat", ["a", "b"], ["amount"]).orderBy("id").collect()
    assert [(r["id"], r["amount"]) for r in rows] == [("1", 10.5), ("3", None), ("4", None)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_publish_report_round_trip(spark, tmp_path, fmt):
    tables = {"one": spark.range(3), "two": spark.range(5)}
    publish.publish_report(tables, str(tmp_path / "r"), fmt)
    read = lambda n: publish.read_published(spark, str(tmp_path / "r"), n, fmt)
    assert {n: read(n).count() for n in tables} == {"one": 3, "two": 5}
    assert read("one").columns == ["id"]


def test_publish_inventory_writes_both_projections(spark, tmp_path):
    columns = sorted(set(abcxyz.CLASSIFICATION_COLUMNS) | set(abcxyz.POLICY_COLUMNS))
    policy = spark.range(2).select(*[F.lit(1).alias(c) for c in columns], F.lit(2).alias("other"))
    publish.publish_inventory(policy, str(tmp_path), "parquet")
    read = lambda n: publish.read_published(spark, str(tmp_path), n)
    assert read("classification").columns == abcxyz.CLASSIFICATION_COLUMNS
    assert read("policy").columns == abcxyz.POLICY_COLUMNS
    assert len(abcxyz.CLASSIFICATION_COLUMNS) == 10 and len(abcxyz.POLICY_COLUMNS) == 18


def test_snapshot_freezes_the_previous_month_and_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert publish.snapshot(spark.range(3), path, "2024-03-15") == "2024-02"
    assert publish.snapshot(spark.range(5), path, "2024-01-01") == "2023-12"
    assert publish.snapshot(spark.range(4), path, "2024-03-31") == "2024-02"  # replaces only February
    counts = lambda *months: {
        r["period"]: r["count"] for r in publish.read_snapshots(spark, path, *months).groupBy("period").count().collect()}
    assert counts() == {"2024-02": 4, "2023-12": 5} and counts(["2023-12"]) == {"2023-12": 5}
    publish.snapshot(spark.range(0), path, "2024-03-31")  # an empty report empties its month
    assert counts() == {"2023-12": 5} and publish.read_snapshots(spark, path).columns == ["id", "period"]


def failing(spark):
    """A table whose write breaks off in its last task, when the others have written their files."""
    return spark.range(0, 4000, 1, 4).select(F.when(F.col("id") > 3990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))


def test_a_failed_freeze_keeps_the_month(spark, tmp_path):
    path = str(tmp_path / "snap")
    publish.snapshot(spark.range(5), path, "2024-03-15")
    with pytest.raises(Exception, match="lost"):
        publish.snapshot(failing(spark), path, "2024-03-15")
    assert publish.read_snapshots(spark, path).count() == 5
    publish.snapshot(spark.range(6), path, "2024-03-15")
    assert publish.read_snapshots(spark, path).count() == 6


def test_a_report_changes_in_one_step(spark, tmp_path):
    """The first table of the second report is complete when its second one fails."""
    path = str(tmp_path / "r")
    with pytest.raises(ValueError, match="nothing is published"):
        publish.read_published(spark, path, "one")
    publish.publish_report({"one": spark.range(3), "two": spark.range(5)}, path)
    with pytest.raises(Exception, match="lost"):
        publish.publish_report({"one": spark.range(30), "two": failing(spark)}, path)
    read = lambda: [publish.read_published(spark, path, n).count() for n in ("one", "two")]
    assert read() == [3, 5]
    # A process killed while it writes the manifest leaves a file that is none.
    (tmp_path / "r" / "_manifests" / "000000000099.json.tmp").write_text('{"one": "gone"')
    assert read() == [3, 5]


def test_readers_of_the_version_before_are_not_cut_off(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(spark.range(3), path)
    before = publish.read_published(spark, path)
    publish.publish(spark.range(4), path)
    assert before.count() == 3 and publish.read_published(spark, path).count() == 4
    for n in (5, 6):
        publish.publish(spark.range(n), path)
    assert len(list((tmp_path / "t" / "table").iterdir())) == manifest.KEEP == len(list((tmp_path / "t" / "_manifests").glob("*.json")))


def test_saved_star_prunes_months(spark, tmp_path):
    sales = spark.range(300).select(
        F.col("id").alias("ticket_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("sale_date"))
    publish.save_star({"sales": sales, "stores": spark.range(2)}, str(tmp_path))
    t = publish.read_star(spark, str(tmp_path), ["sales", "stores"])
    assert t["stores"].count() == 2
    spring = in_period(t["sales"], "sale_date", "2024-03-01", "2024-05-01")
    assert spring.count() == 61
    plan = spring._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan
    assert len(spring.inputFiles()) >= 1
