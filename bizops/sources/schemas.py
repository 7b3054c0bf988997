"""Typed input tables: file columns, their Spark types, and the names the operators use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    """``columns`` maps each file column to (operator column, Spark type), in file order."""

    columns: dict[str, tuple[str, str]]

    def rename(self, df: DataFrame, where: str = "the table") -> DataFrame:
        """The known columns, found by name, under the operators' names and types."""
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{where} lacks the columns {', '.join(missing)}")
        return df.select(*[F.col(c).try_cast(t).alias(n) for c, (n, t) in self.columns.items()])


# --- Fixed values: input file names, their columns and types. --------------------------------
STAR = {
    "ventas": Table({
        "id_venta": ("ticket_id", "bigint"),
        "fecha": ("sale_date", "date"),
        "id_cliente": ("customer_id", "string"),
        "id_producto": ("product_id", "string"),
        "id_sucursal": ("store_id", "string"),
        "cantidad": ("qty", "int"),
        "precio_unitario": ("unit_price", "decimal(14,2)"),
        "descuento": ("discount", "decimal(4,2)"),
        "costo_unitario": ("unit_cost", "decimal(14,2)"),
        "ingreso": ("revenue", "decimal(16,2)"),
        "costo": ("cost", "decimal(16,2)"),
        "margen": ("margin", "decimal(16,2)"),
    }),
    "clientes": Table({
        "id_cliente": ("customer_id", "string"),
        "nombre_cliente": ("customer_name", "string"),
        "segmento": ("segment", "string"),
        "ciudad": ("city", "string"),
        "region": ("region", "string"),
        "fecha_alta": ("since", "date"),
        "es_fuga": ("is_churn", "boolean"),
    }),
    "productos": Table({
        "id_producto": ("product_id", "string"),
        "nombre_producto": ("product_name", "string"),
        "categoria": ("category", "string"),
        "costo_unitario": ("unit_cost", "decimal(14,2)"),
        "precio_lista": ("list_price", "decimal(14,2)"),
        "es_margen_fino": ("is_thin_margin", "boolean"),
        "es_baja_rotacion": ("is_slow_mover", "boolean"),
    }),
    "sucursales": Table({
        "id_sucursal": ("store_id", "string"),
        "nombre_sucursal": ("store_name", "string"),
        "ciudad": ("city", "string"),
        "region": ("region", "string"),
    }),
}

INVENTORY = {
    "productos": Table({
        "sku": ("sku", "string"),
        "nombre": ("name", "string"),
        "categoria": ("category", "string"),
        "tier_diseno": ("design_tier", "string"),
        "precio_unitario": ("unit_price", "int"),
        "costo_unitario": ("unit_cost", "int"),
        "lead_time_dias": ("lead_time_days", "int"),
        "costo_pedido_fijo": ("order_cost", "int"),
    }),
    "demanda_mensual": Table({
        "sku": ("sku", "string"),
        "fecha": ("month", "string"),
        "unidades_vendidas": ("units", "int"),
    }),
    "inventario_actual": Table({
        "sku": ("sku", "string"),
        "stock_actual": ("stock_on_hand", "int"),
        "fecha_corte": ("as_of_month", "string"),
    }),
}

PLANT = {
    "equipos": Table({
        "id_equipo": ("machine_id", "int"),
        "nombre_equipo": ("machine_name", "string"),
        "linea_produccion": ("line", "string"),
        "costo_hora_parada": ("hourly_cost", "int"),
        "fecha_ultimo_service": ("last_service", "date"),
        "proximo_service": ("next_service", "date"),
        "dias_para_service": ("days_left", "int"),
        "intervalo_servicio_dias": ("service_interval_days", "int"),
    }),
    "registro_paros": Table({
        "fecha": ("stop_date", "date"),
        "id_equipo": ("machine_id", "int"),
        "nombre_equipo": ("machine_name", "string"),
        "linea": ("line", "string"),
        "turno": ("shift", "string"),
        "tipo_paro": ("stop_type", "string"),
        "categoria_causa": ("cause", "string"),
        "causa_detalle": ("cause_detail", "string"),
        "horas_paro": ("hours", "decimal(10,2)"),
        "costo_paro": ("cost", "double"),
    }),
}

UNPLANNED_LABEL = "No programado"
# Performance and quality rate by machine name.
MACHINE_RATES = {
    "CNC Alpha 01": (0.91, 0.98),
    "CNC Alpha 02": (0.89, 0.97),
    "Torno CNC 03": (0.82, 0.96),
    "Fresadora 04": (0.93, 0.99),
    "Centro Mec. 05": (0.88, 0.97),
    "Torno CNC 06": (0.79, 0.95),
    "Rectificadora 07": (0.83, 0.96),
    "CNC Delta 08": (0.94, 0.98),
}
# ---------------------------------------------------------------------------------------------
