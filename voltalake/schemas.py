"""Tables of the lake: columns, types and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: raw files, one tuple of header names per dataset ----------
RAW_COLUMNS = {
    "proveedores": (
        "nombre_proveedor", "tipo_energia", "pais_origen",
        "capacidad_mw", "fecha_registro", "activo",
    ),
    "clientes": (
        "tipo_identificacion", "identificacion", "nombre", "ciudad",
        "segmento", "fecha_vinculacion", "consumo_promedio_kwh",
    ),
    "transacciones": (
        "id_transaccion", "tipo_transaccion", "nombre_cliente_proveedor",
        "cantidad_kwh", "precio_cop_kwh", "tipo_energia",
        "fecha_transaccion", "estado", "mercado",
    ),
}

# --- Fixed values: domains and thresholds ------------------------------------
ENERGY_TYPES = ("eolica", "hidroelectrica", "nuclear")
ID_TYPES = ("CC", "NIT", "CE", "PP", "TI")
TRANSACTION_TYPES = ("compra", "venta")
BUY, SELL = TRANSACTION_TYPES
DONE, PENDING = "completada", "pendiente"
SMALL, MEDIUM, LARGE = "pequeña", "mediana", "grande"
MEDIUM_FROM_KWH, MEDIUM_TO_KWH = 1_000, 100_000
SUPPLIER_SOURCE = "sistema_transaccional"
MASK, MASK_TAIL = "****", 4

# --- Fixed values: processed tables ------------------------------------------
PROCESSED = {
    "proveedores": {
        "nombre_proveedor": "string",
        "tipo_energia": "string",
        "pais_origen": "string",
        "capacidad_mw": "double",
        "fecha_registro": "date",
        "activo": "boolean",
        "_fecha_ingesta": "date",
        "_fuente": "string",
    },
    "clientes": {
        "tipo_identificacion": "string",
        "identificacion": "string",
        "nombre": "string",
        "ciudad": "string",
        "segmento": "string",
        "fecha_vinculacion": "date",
        "consumo_promedio_kwh": "double",
        "antiguedad_dias": "bigint",
        "identificacion_enmascarada": "string",
        "_fecha_ingesta": "date",
    },
    "transacciones": {
        "id_transaccion": "string",
        "tipo_transaccion": "string",
        "nombre_cliente_proveedor": "string",
        "cantidad_kwh": "double",
        "precio_cop_kwh": "double",
        "tipo_energia": "string",
        "fecha_transaccion": "date",
        "estado": "string",
        "mercado": "string",
        "valor_total_cop": "double",
        "clasificacion_volumen": "string",
        "anio": "int",
        "mes": "int",
        "dia_semana": "int",
        "precio_promedio_tipo_energia": "double",
        "sobre_precio_promedio": "boolean",
        "desviacion_precio_pct": "double",
        "_fecha_ingesta": "date",
    },
    "metricas_energia": {
        "tipo_energia": "string",
        "tipo_transaccion": "string",
        "num_transacciones": "bigint",
        "total_kwh": "double",
        "total_cop": "double",
        "precio_promedio_kwh": "double",
        "precio_min_kwh": "double",
        "precio_max_kwh": "double",
        "_fecha_ingesta": "date",
        "_tipo_metrica": "string",
    },
    "metricas_segmento": {
        "segmento": "string",
        "tipo_energia": "string",
        "num_transacciones": "bigint",
        "total_kwh": "double",
        "total_cop": "double",
        "ticket_promedio_cop": "double",
        "_fecha_ingesta": "date",
        "_tipo_metrica": "string",
    },
}

# --- Fixed values: warehouse tables ------------------------------------------
WAREHOUSE = {
    "dim_proveedores": {
        "nombre_proveedor": "varchar(200) not null",
        "tipo_energia": "varchar(50) not null",
        "pais_origen": "varchar(100)",
        "capacidad_mw": "decimal(12,2)",
        "fecha_registro": "date",
        "activo": "boolean",
        "_fecha_ingesta": "date",
        "_fuente": "varchar(100)",
    },
    "dim_clientes": {
        "tipo_identificacion": "varchar(10) not null",
        "identificacion": "varchar(50) not null",
        "identificacion_enmascarada": "varchar(20)",
        "nombre": "varchar(200)",
        "ciudad": "varchar(100)",
        "segmento": "varchar(50)",
        "consumo_promedio_kwh": "decimal(15,2)",
        "fecha_vinculacion": "date",
        "antiguedad_dias": "bigint",
        "_fecha_ingesta": "date",
    },
    "fact_transacciones": {
        "id_transaccion": "varchar(50) not null",
        "tipo_transaccion": "varchar(20)",
        "nombre_cliente_proveedor": "varchar(200)",
        "cantidad_kwh": "decimal(18,2)",
        "precio_cop_kwh": "decimal(12,4)",
        "valor_total_cop": "decimal(20,2)",
        "tipo_energia": "varchar(50)",
        "fecha_transaccion": "date",
        "estado": "varchar(30)",
        "mercado": "varchar(30)",
        "clasificacion_volumen": "varchar(20)",
        "anio": "smallint",
        "mes": "smallint",
        "dia_semana": "smallint",
        "precio_promedio_tipo_energia": "decimal(12,4)",
        "sobre_precio_promedio": "boolean",
        "desviacion_precio_pct": "decimal(8,2)",
        "_fecha_ingesta": "date",
    },
    "agg_metricas_energia": {
        "tipo_energia": "varchar(50)",
        "tipo_transaccion": "varchar(20)",
        "num_transacciones": "bigint",
        "total_kwh": "decimal(20,2)",
        "total_cop": "decimal(20,2)",
        "precio_promedio_kwh": "decimal(12,4)",
        "precio_min_kwh": "decimal(12,4)",
        "precio_max_kwh": "decimal(12,4)",
        "_fecha_ingesta": "date",
        "_tipo_metrica": "varchar(30)",
    },
    "agg_metricas_segmento": {
        "segmento": "varchar(50)",
        "tipo_energia": "varchar(50)",
        "num_transacciones": "bigint",
        "total_kwh": "decimal(20,2)",
        "total_cop": "decimal(20,2)",
        "ticket_promedio_cop": "decimal(20,2)",
        "_fecha_ingesta": "date",
        "_tipo_metrica": "varchar(30)",
    },
}

# Warehouse table filled from each processed dataset, in loading order.
WAREHOUSE_OF = {
    "proveedores": "dim_proveedores",
    "clientes": "dim_clientes",
    "transacciones": "fact_transacciones",
    "metricas_energia": "agg_metricas_energia",
    "metricas_segmento": "agg_metricas_segmento",
}

# Sort keys of the warehouse tables: rows lie in this order inside each file,
# so that row-group statistics can skip data.
WAREHOUSE_SORT = {
    "dim_proveedores": ("tipo_energia", "activo"),
    "dim_clientes": ("segmento", "ciudad"),
    "fact_transacciones": ("fecha_transaccion", "tipo_transaccion"),
    "agg_metricas_energia": ("_fecha_ingesta", "tipo_energia"),
    "agg_metricas_segmento": ("_fecha_ingesta", "segmento"),
}

# Natural keys.
KEYS = {
    "proveedores": ("nombre_proveedor",),
    "clientes": ("tipo_identificacion", "identificacion"),
    "transacciones": ("id_transaccion",),
}

# Column of each entity that decides which duplicate stays: the earliest date.
AGE_COLUMN = {
    "proveedores": "fecha_registro",
    "clientes": "fecha_vinculacion",
    "transacciones": "fecha_transaccion",
}

CORRUPT = "_corrupt_record"
DAY_FORMAT = "yyyy-MM-dd"
DAY_PARTITION = ("year", "month", "day")
HOUR_PARTITION = (*DAY_PARTITION, "hour")

_SPARK_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
}


def raw_schema(dataset: str, corrupt: bool = True) -> T.StructType:
    """All columns of a raw file as text, with a place for unparseable lines."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[dataset]])
    return schema.add(CORRUPT, T.StringType()) if corrupt else schema


def processed_schema(dataset: str) -> T.StructType:
    """Declared schema of a processed table."""
    return T.StructType(
        [T.StructField(name, _SPARK_TYPES[kind]) for name, kind in PROCESSED[dataset].items()]
    )
