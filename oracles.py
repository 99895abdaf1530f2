"""SQL that DuckDB runs on the driver's tables to check each registered query.

Every text is a chain of common table expressions: the raw datasets derived
from the star schema, then the cleaned ones, then the query itself.
"""

from __future__ import annotations

from voltalake.schemas import WAREHOUSE

LOAD_DATE = "2024-01-15"
SECOND_DATE = "2024-02-20"

_RAW_SUPPLIERS = """
raw_p AS (
  SELECT '  ' || s_name || ' ' AS nombre_proveedor,
    CASE s_suppkey % 4 WHEN 0 THEN 'EOLICA ' WHEN 1 THEN 'Hidroelectrica'
      WHEN 2 THEN ' nuclear' ELSE 'carbon' END AS tipo_energia,
    ' ' || n_name AS pais_origen,
    CASE WHEN s_suppkey % 25 = 0 THEN 'n/d'
      ELSE CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS capacidad_mw,
    '20' || CAST(10 + s_suppkey % 14 AS VARCHAR) || '-0'
      || CAST(1 + s_suppkey % 9 AS VARCHAR) || '-15' AS fecha_registro,
    CASE WHEN s_suppkey % 10 = 0 THEN 'false' ELSE 'true' END AS activo
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

_RAW_CUSTOMERS = """
raw_c AS (
  SELECT CASE (c_custkey - c_custkey % 2) % 12 WHEN 0 THEN ' cc' WHEN 2 THEN 'NIT'
      WHEN 4 THEN 'CE ' WHEN 6 THEN 'pp' WHEN 8 THEN 'TI' ELSE 'RC' END AS tipo_identificacion,
    CAST(1000000 + c_custkey - c_custkey % 2 AS VARCHAR) AS identificacion,
    ' ' || c_name || '  ' AS nombre, lower(n_name) AS ciudad, c_mktsegment || ' ' AS segmento,
    '20' || CAST(10 + c_custkey % 14 AS VARCHAR) || '-0'
      || CAST(1 + c_custkey % 9 AS VARCHAR) || '-20' AS fecha_vinculacion,
    CASE WHEN c_custkey % 50 = 0 THEN 'n/d'
      ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS consumo_promedio_kwh
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_RAW_TRANSACTIONS = """
raw_t AS (
  SELECT 'TRX-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
      AS id_transaccion,
    CASE WHEN l_linestatus = 'O' THEN ' COMPRA' ELSE 'venta ' END AS tipo_transaccion,
    CASE WHEN l_linestatus = 'O' THEN s_name || ' ' ELSE c_name END AS nombre_cliente_proveedor,
    CAST(CAST(l_quantity * p_size * 100 AS BIGINT) AS VARCHAR) AS cantidad_kwh,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS precio_cop_kwh,
    CASE l_returnflag WHEN 'R' THEN 'EOLICA ' WHEN 'A' THEN 'hidroelectrica'
      ELSE 'Nuclear' END AS tipo_energia,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS fecha_transaccion,
    CASE WHEN o_orderstatus = 'O' THEN 'PENDIENTE' ELSE 'completada' END AS estado,
    CASE WHEN o_orderpriority < '3' THEN 'Mayorista ' ELSE 'minorista' END AS mercado
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN part ON l_partkey = p_partkey
)"""


def _iso_day(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"THEN TRY_CAST({text} AS DATE) END"
    )


def _exact(value: str) -> str:
    """Sum of doubles with the rounding errors carried along."""
    return f"FSUM({value})"


def _mean(value: str, digits: int = 2) -> str:
    """Average, rounded half up in decimals."""
    quotient = f"CAST({_exact(value)} / COUNT({value}) AS DECIMAL(28,8))"
    return f"CAST(ROUND({quotient}, {digits}) AS DOUBLE)"


_SUPPLIERS = f"""
typed_p AS (
  SELECT trim(nombre_proveedor) AS nombre_proveedor, lower(trim(tipo_energia)) AS tipo_energia,
    trim(pais_origen) AS pais_origen, TRY_CAST(capacidad_mw AS DOUBLE) AS capacidad_mw,
    {_iso_day('fecha_registro')} AS fecha_registro, TRY_CAST(activo AS BOOLEAN) AS activo
  FROM raw_p
), p AS (
  SELECT *, DATE '{LOAD_DATE}' AS _fecha_ingesta, 'sistema_transaccional' AS _fuente
  FROM typed_p WHERE tipo_energia IN ('eolica', 'hidroelectrica', 'nuclear')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY nombre_proveedor
    ORDER BY fecha_registro NULLS LAST, tipo_energia NULLS LAST, pais_origen NULLS LAST,
      capacidad_mw NULLS LAST, activo NULLS LAST) = 1
)"""


def _customers(as_of: str, load_date: str) -> str:
    return f"""
typed_c AS (
  SELECT upper(trim(tipo_identificacion)) AS tipo_identificacion, identificacion,
    trim(nombre) AS nombre,
    upper(trim(ciudad)[1]) || lower(trim(ciudad)[2:]) AS ciudad,
    lower(trim(segmento)) AS segmento, {_iso_day('fecha_vinculacion')} AS fecha_vinculacion,
    TRY_CAST(consumo_promedio_kwh AS DOUBLE) AS consumo_promedio_kwh
  FROM raw_c
), c AS (
  SELECT *, date_diff('day', fecha_vinculacion, DATE '{as_of}') AS antiguedad_dias,
    '****' || right(identificacion, 4) AS identificacion_enmascarada,
    DATE '{load_date}' AS _fecha_ingesta
  FROM typed_c WHERE tipo_identificacion IN ('CC', 'NIT', 'CE', 'PP', 'TI')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY tipo_identificacion, identificacion
    ORDER BY fecha_vinculacion NULLS LAST, nombre NULLS LAST, ciudad NULLS LAST,
      segmento NULLS LAST, consumo_promedio_kwh NULLS LAST) = 1
)"""


_TRANSACTIONS = f"""
typed_t AS (
  SELECT id_transaccion, lower(trim(tipo_transaccion)) AS tipo_transaccion,
    trim(nombre_cliente_proveedor) AS nombre_cliente_proveedor,
    TRY_CAST(cantidad_kwh AS DOUBLE) AS cantidad_kwh,
    TRY_CAST(precio_cop_kwh AS DOUBLE) AS precio_cop_kwh,
    lower(trim(tipo_energia)) AS tipo_energia,
    {_iso_day('fecha_transaccion')} AS fecha_transaccion,
    lower(trim(estado)) AS estado, lower(trim(mercado)) AS mercado
  FROM raw_t
), clean_t AS (
  SELECT * FROM typed_t
  QUALIFY ROW_NUMBER() OVER (PARTITION BY id_transaccion
    ORDER BY fecha_transaccion NULLS LAST, tipo_transaccion NULLS LAST,
      nombre_cliente_proveedor NULLS LAST, cantidad_kwh NULLS LAST, precio_cop_kwh NULLS LAST,
      tipo_energia NULLS LAST, estado NULLS LAST, mercado NULLS LAST) = 1
), d AS (
  SELECT *, CAST(CAST(cantidad_kwh AS DECIMAL(18,2)) * CAST(precio_cop_kwh AS DECIMAL(12,2))
      AS DECIMAL(30,2))::DOUBLE AS valor_total_cop,
    CASE WHEN cantidad_kwh < 1000 THEN 'pequeña' WHEN cantidad_kwh <= 100000 THEN 'mediana'
      WHEN cantidad_kwh IS NOT NULL THEN 'grande' END AS clasificacion_volumen,
    CAST(year(fecha_transaccion) AS INTEGER) AS anio,
    CAST(month(fecha_transaccion) AS INTEGER) AS mes,
    CAST(dayofweek(fecha_transaccion) + 1 AS INTEGER) AS dia_semana
  FROM clean_t
)"""

_PRICED = f"""
pr AS (
  SELECT tipo_energia AS te, {_mean('precio_cop_kwh')} AS m FROM d GROUP BY tipo_energia
), t AS (
  SELECT d.*, m AS precio_promedio_tipo_energia, precio_cop_kwh > m AS sobre_precio_promedio,
    ROUND((precio_cop_kwh - m) / NULLIF(m, 0) * 100, 2) + 0.0 AS desviacion_precio_pct,
    DATE '{LOAD_DATE}' AS _fecha_ingesta
  FROM d LEFT JOIN pr ON d.tipo_energia IS NOT DISTINCT FROM te
)"""

_ENERGY = f"""
me AS (
  SELECT tipo_energia, tipo_transaccion, COUNT(*) AS num_transacciones,
    ROUND({_exact('cantidad_kwh')}, 2) AS total_kwh,
    ROUND({_exact('valor_total_cop')}, 2) AS total_cop,
    {_mean('precio_cop_kwh')} AS precio_promedio_kwh,
    ROUND(MIN(precio_cop_kwh), 2) AS precio_min_kwh,
    ROUND(MAX(precio_cop_kwh), 2) AS precio_max_kwh,
    DATE '{LOAD_DATE}' AS _fecha_ingesta, 'por_energia' AS _tipo_metrica
  FROM d GROUP BY tipo_energia, tipo_transaccion
)"""

_SALES = """
vc AS (
  SELECT d.*, c.nombre AS nombre_cliente, c.ciudad, c.segmento, c.consumo_promedio_kwh
  FROM d LEFT JOIN c ON d.nombre_cliente_proveedor = c.nombre
  WHERE d.tipo_transaccion = 'venta'
)"""

_SEGMENT = f"""
ms AS (
  SELECT segmento, tipo_energia, COUNT(*) AS num_transacciones,
    ROUND({_exact('cantidad_kwh')}, 2) AS total_kwh,
    ROUND({_exact('valor_total_cop')}, 2) AS total_cop,
    {_mean('valor_total_cop')} AS ticket_promedio_cop,
    DATE '{LOAD_DATE}' AS _fecha_ingesta, 'por_segmento' AS _tipo_metrica
  FROM vc WHERE segmento IS NOT NULL GROUP BY segmento, tipo_energia
)"""

_DIM_P = """
dim_p AS (
  SELECT nombre_proveedor, tipo_energia, pais_origen,
    TRY_CAST(capacidad_mw AS DECIMAL(12,2)) AS capacidad_mw, fecha_registro, activo,
    _fecha_ingesta, _fuente
  FROM p
)"""

_DIM_C = """
dim_c AS (
  SELECT tipo_identificacion, identificacion, identificacion_enmascarada, nombre, ciudad, segmento,
    TRY_CAST(consumo_promedio_kwh AS DECIMAL(15,2)) AS consumo_promedio_kwh, fecha_vinculacion,
    antiguedad_dias, _fecha_ingesta
  FROM c
)"""

_FACT = """
fact AS (
  SELECT id_transaccion, tipo_transaccion, nombre_cliente_proveedor,
    TRY_CAST(cantidad_kwh AS DECIMAL(18,2)) AS cantidad_kwh,
    TRY_CAST(precio_cop_kwh AS DECIMAL(12,4)) AS precio_cop_kwh,
    TRY_CAST(valor_total_cop AS DECIMAL(20,2)) AS valor_total_cop,
    tipo_energia, fecha_transaccion, estado, mercado, clasificacion_volumen,
    CAST(anio AS SMALLINT) AS anio, CAST(mes AS SMALLINT) AS mes,
    CAST(dia_semana AS SMALLINT) AS dia_semana,
    TRY_CAST(precio_promedio_tipo_energia AS DECIMAL(12,4)) AS precio_promedio_tipo_energia,
    sobre_precio_promedio, TRY_CAST(desviacion_precio_pct AS DECIMAL(8,2)) AS desviacion_precio_pct,
    _fecha_ingesta
  FROM t
)"""

_AGG_E = """
agg_e AS (
  SELECT tipo_energia, tipo_transaccion, num_transacciones,
    TRY_CAST(total_kwh AS DECIMAL(20,2)) AS total_kwh,
    TRY_CAST(total_cop AS DECIMAL(20,2)) AS total_cop,
    TRY_CAST(precio_promedio_kwh AS DECIMAL(12,4)) AS precio_promedio_kwh,
    TRY_CAST(precio_min_kwh AS DECIMAL(12,4)) AS precio_min_kwh,
    TRY_CAST(precio_max_kwh AS DECIMAL(12,4)) AS precio_max_kwh, _fecha_ingesta, _tipo_metrica
  FROM me
)"""

_AGG_S = """
agg_s AS (
  SELECT segmento, tipo_energia, num_transacciones,
    TRY_CAST(total_kwh AS DECIMAL(20,2)) AS total_kwh,
    TRY_CAST(total_cop AS DECIMAL(20,2)) AS total_cop,
    TRY_CAST(ticket_promedio_cop AS DECIMAL(20,2)) AS ticket_promedio_cop,
    _fecha_ingesta, _tipo_metrica
  FROM ms
)"""


def _with(*steps: str) -> str:
    return "WITH " + ",".join(steps) + "\n"


_CUSTOMERS = _customers(LOAD_DATE, LOAD_DATE)
_P = (_RAW_SUPPLIERS, _SUPPLIERS)
_C = (_RAW_CUSTOMERS, _CUSTOMERS)
_D = (_RAW_TRANSACTIONS, _TRANSACTIONS)
_T = (*_D, _PRICED)
_E = (*_D, _ENERGY)
_V = (*_C, *_D, _SALES)
_S = (*_V, _SEGMENT)
_ALL = (*_P, *_C, *_T, _ENERGY, _SALES, _SEGMENT)

_DONE = "estado = 'completada'"

_CUSTOMER_TEXT_LIMITS = (
    ("tipo_identificacion", 10), ("identificacion", 50), ("identificacion_enmascarada", 20),
    ("nombre", 200), ("ciudad", 100), ("segmento", 50),
)
_SUPPLIER_TEXT_LIMITS = (
    ("nombre_proveedor", 200), ("tipo_energia", 50), ("pais_origen", 100), ("_fuente", 100),
)
_FACT_TEXT_LIMITS = (
    ("id_transaccion", 50), ("tipo_transaccion", 20), ("nombre_cliente_proveedor", 200),
    ("tipo_energia", 50), ("estado", 30), ("mercado", 30), ("clasificacion_volumen", 20),
)


def _report(table: str, source: str, required: tuple[str, ...], checks: dict[str, str]) -> str:
    """One SELECT per check over the cleaned table."""
    selects = [
        f"SELECT '{table}' AS tabla, 'no_vacia' AS regla, "
        f"CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS filas_malas FROM {source}"
    ]
    selects += [f"SELECT '{table}', 'columna_{name}', 0" for name in required]
    selects += [
        f"SELECT '{table}', '{rule}', COUNT(*) FROM {source} WHERE {bad}"
        for rule, bad in checks.items()
    ]
    return " UNION ALL ".join(selects)


def _fits(texts: tuple[tuple[str, int], ...], numbers: dict[str, str]) -> dict[str, str]:
    checks = {f"{name}_cabe": f"length({name}) > {size}" for name, size in texts}
    checks |= {
        f"{name}_cabe": f"{name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL"
        for name, kind in numbers.items()
    }
    return checks


_REPORT = " UNION ALL ".join([
    _report(
        "proveedores", "p", ("nombre_proveedor", "tipo_energia", "capacidad_mw", "activo"),
        {
            "tipo_energia_valido": "tipo_energia NOT IN ('eolica', 'hidroelectrica', 'nuclear')",
            "nombre_no_nulo": "nombre_proveedor IS NULL",
            "tipo_energia_no_nulo": "tipo_energia IS NULL",
            "capacidad_positiva": "capacidad_mw <= 0",
        } | _fits(_SUPPLIER_TEXT_LIMITS, {"capacidad_mw": "DECIMAL(12,2)"}),
    ),
    _report(
        "clientes", "c", ("tipo_identificacion", "identificacion", "nombre", "segmento"),
        {
            "tipo_identificacion_valido":
                "tipo_identificacion NOT IN ('CC', 'NIT', 'CE', 'PP', 'TI')",
            "tipo_identificacion_no_nulo": "tipo_identificacion IS NULL",
            "identificacion_no_nula": "identificacion IS NULL",
            "identificacion_se_enmascara": "length(identificacion) <= 4",
            "antiguedad_no_negativa": "antiguedad_dias < 0",
        } | _fits(_CUSTOMER_TEXT_LIMITS, {"consumo_promedio_kwh": "DECIMAL(15,2)"}),
    ),
    _report(
        "transacciones", "t",
        ("id_transaccion", "tipo_transaccion", "cantidad_kwh", "precio_cop_kwh"),
        {
            "id_no_nulo": "id_transaccion IS NULL",
            "tipo_energia_valido": "tipo_energia NOT IN ('eolica', 'hidroelectrica', 'nuclear')",
            "tipo_transaccion_valido": "tipo_transaccion NOT IN ('compra', 'venta')",
            "cantidad_positiva": "cantidad_kwh <= 0",
            "precio_positivo": "precio_cop_kwh <= 0",
            "desviacion_coherente": "(sobre_precio_promedio AND desviacion_precio_pct < 0) "
            "OR (NOT sobre_precio_promedio AND desviacion_precio_pct > 0)",
            "desviacion_redondeada": "sobre_precio_promedio AND desviacion_precio_pct = 0",
        } | _fits(_FACT_TEXT_LIMITS, {
            "cantidad_kwh": "DECIMAL(18,2)",
            "precio_cop_kwh": "DECIMAL(12,4)",
            "valor_total_cop": "DECIMAL(20,2)",
            "precio_promedio_tipo_energia": "DECIMAL(12,4)",
            "desviacion_precio_pct": "DECIMAL(8,2)",
        }),
    ),
])


def _counts(label: str = "tabla") -> str:
    tables = {
        "proveedores": "p", "clientes": "c", "transacciones": "t",
        "metricas_energia": "me", "metricas_segmento": "ms",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, COUNT(*) AS filas FROM {source}"
        for name, source in tables.items()
    )


_PENDING = f"""
SELECT id_transaccion, tipo_transaccion, nombre_cliente_proveedor, ROUND(cantidad_kwh, 2) AS kwh,
  ROUND(valor_total_cop, 2) AS valor_cop, tipo_energia, fecha_transaccion,
  CAST(date_diff('day', fecha_transaccion, DATE '{LOAD_DATE}') AS INTEGER) AS dias_pendiente
FROM d WHERE estado = 'pendiente' ORDER BY dias_pendiente DESC, valor_cop DESC, id_transaccion"""



def _texts(table: str) -> str:
    """All columns of a warehouse table as texts, an empty one for NULL."""
    return ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in WAREHOUSE[table])


ORACLES = {
    "scan_csv": _with(_RAW_TRANSACTIONS) + "SELECT * FROM raw_t",
    "scan_partition": _with(_RAW_CUSTOMERS, _customers(SECOND_DATE, SECOND_DATE))
    + "SELECT * FROM c",
    "sink_parquet": _with(*_T)
    + "SELECT *, '2024' AS year, '01' AS month, '15' AS day FROM t",
    "ingest_stream": _with(_RAW_TRANSACTIONS)
    + f"SELECT *, 'transacciones' AS tabla, DATE '{LOAD_DATE}' AS fecha FROM raw_t",
    "landing_layout": _with(_RAW_SUPPLIERS, _RAW_CUSTOMERS, _RAW_TRANSACTIONS)
    + " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, "
        f"'raw/{name}/year=2024/month=01/day=15/hour=08/' AS destino, "
        f"COUNT(*) AS filas, 'ok' AS estado FROM {source}"
        for name, source in
        (("proveedores", "raw_p"), ("clientes", "raw_c"), ("transacciones", "raw_t"))
    ),
    "catalog_refresh": _with(*_ALL)
    + f"""SELECT tabla, columnas, CAST(1 AS BIGINT) AS particiones, 'SUCCEEDED' AS estado, filas
FROM ({_counts()}) JOIN (VALUES ('proveedores', 11), ('clientes', 13), ('transacciones', 21),
  ('metricas_energia', 13), ('metricas_segmento', 11)) AS w(nombre, columnas) ON tabla = nombre""",
    "run_metrics": _with(*_ALL)
    + f"""SELECT tabla, CAST(leidas AS BIGINT) AS leidas, CAST(ilegibles AS BIGINT) AS ilegibles,
  CAST(leidas - conocidas AS BIGINT) AS filtradas, CAST(conocidas - filas AS BIGINT) AS fusionadas,
  filas
FROM ({_counts()}) LEFT JOIN (
  SELECT 'proveedores' AS nombre, COUNT(*) AS leidas, 0 AS ilegibles, COUNT(*) FILTER
    (WHERE lower(trim(tipo_energia)) IN ('eolica', 'hidroelectrica', 'nuclear')) AS conocidas
  FROM raw_p
  UNION ALL SELECT 'clientes', COUNT(*), 0, COUNT(*) FILTER
    (WHERE upper(trim(tipo_identificacion)) IN ('CC', 'NIT', 'CE', 'PP', 'TI')) FROM raw_c
  UNION ALL SELECT 'transacciones', COUNT(*), 0, COUNT(*) FROM raw_t
) ON tabla = nombre""",
    "catalog_zones": _with(*_ALL)
    + f"""SELECT zona, tabla, columnas, CAST(particiones AS BIGINT) AS particiones,
  'SUCCEEDED' AS estado, filas
FROM (SELECT 'processed' AS zona, tabla, filas FROM ({_counts()})
  UNION ALL SELECT 'raw', 'proveedores', COUNT(*) FROM raw_p
  UNION ALL SELECT 'raw', 'clientes', COUNT(*) FROM raw_c
  UNION ALL SELECT 'raw', 'transacciones', COUNT(*) FROM raw_t
  UNION ALL SELECT 'curated', 'q7', COUNT(*) FROM p WHERE activo)
JOIN (VALUES ('processed', 'proveedores', 11, 1), ('processed', 'clientes', 13, 1),
  ('processed', 'transacciones', 21, 1), ('processed', 'metricas_energia', 13, 1),
  ('processed', 'metricas_segmento', 11, 1), ('raw', 'proveedores', 13, 1),
  ('raw', 'clientes', 14, 1), ('raw', 'transacciones', 16, 1), ('curated', 'q7', 5, NULL)
) AS w(zona, tabla, columnas, particiones) USING (zona, tabla)""",
    "stream_unique": _with(_RAW_TRANSACTIONS)
    + "SELECT id_transaccion, CAST(1 AS BIGINT) AS filas FROM raw_t GROUP BY id_transaccion",
    "ingest_reordenado": _with(_RAW_SUPPLIERS) + "SELECT * FROM raw_p",
    "ingest_cuarentena": _with(_RAW_SUPPLIERS, _RAW_CUSTOMERS, _RAW_TRANSACTIONS)
    + """SELECT 'proveedores' AS tabla, 'ingerido' AS motivo, COUNT(*) AS lineas FROM raw_p
UNION ALL SELECT 'clientes', 'ingerido', COUNT(*) FROM raw_c
UNION ALL SELECT 'transacciones', 'ingerido', COUNT(*) FROM raw_t
UNION ALL SELECT 'proveedores', 'columnas desconocidas: n_name; columnas que faltan: '
  || 'nombre_proveedor, tipo_energia, pais_origen, capacidad_mw, fecha_registro, activo',
  COUNT(*) + 1 FROM nation""",
    "warehouse_load": _with(*_ALL, _DIM_P, _DIM_C, _FACT, _AGG_E, _AGG_S)
    + " UNION ALL ".join(
        f"SELECT '{table}' AS tabla, COUNT(*) AS filas, "
        f"CAST(SUM(('0x' || md5(concat_ws('|', {_texts(table)}))[1:12])::BIGINT) AS DECIMAL(38,0)) "
        f"AS huella FROM {source}"
        for table, source in (
            ("dim_proveedores", "dim_p"),
            ("dim_clientes", "dim_c"),
            ("fact_transacciones", "fact"),
            ("agg_metricas_energia", "agg_e"),
            ("agg_metricas_segmento", "agg_s"),
        )
    ),
    "export_result": _with(*_D) + _PENDING,
    "export_json": _with(*_D) + _PENDING,
    "ingest_otros": "SELECT 'paises' AS tabla, n_name AS linea FROM nation",
    "norm_proveedores": _with(*_P) + "SELECT * FROM p",
    "norm_clientes": _with(*_C) + "SELECT * FROM c",
    "mask_id": _with(_RAW_CUSTOMERS)
    + "SELECT trim(nombre) AS nombre, identificacion, "
    "'****' || right(identificacion, 4) AS identificacion_enmascarada FROM raw_c",
    "dedup_tx": _with(*_D) + "SELECT * FROM clean_t",
    "tx_valor_total": _with(*_D)
    + "SELECT id_transaccion, cantidad_kwh, precio_cop_kwh, valor_total_cop FROM d",
    "tx_band": _with(*_D) + "SELECT id_transaccion, cantidad_kwh, clasificacion_volumen FROM d",
    "tx_calendar": _with(*_D)
    + "SELECT id_transaccion, fecha_transaccion, anio, mes, dia_semana FROM d",
    "tx_price_stats": _with(*_T)
    + "SELECT id_transaccion, tipo_energia, precio_cop_kwh, precio_promedio_tipo_energia, "
    "sobre_precio_promedio, desviacion_precio_pct FROM t",
    "enrich_transacciones": _with(*_T) + "SELECT * FROM t",
    "band_counts": _with(*_D)
    + "SELECT clasificacion_volumen, COUNT(*) AS n FROM d GROUP BY clasificacion_volumen",
    "ventas_cliente": _with(*_V) + "SELECT * FROM vc",
    "compras_proveedor": _with(*_P, *_D)
    + """SELECT d.*, p.nombre_proveedor, p.capacidad_mw, p.pais_origen
FROM d LEFT JOIN p ON d.nombre_cliente_proveedor = p.nombre_proveedor
WHERE d.tipo_transaccion = 'compra'""",
    "metricas_energia": _with(*_E) + "SELECT * FROM me",
    "metricas_segmento": _with(*_S) + "SELECT * FROM ms",
    "q1": _with(*_D)
    + f"""SELECT tipo_energia, COUNT(*) AS num_transacciones,
  ROUND({_exact('cantidad_kwh')}, 2) AS total_kwh,
  ROUND({_exact('valor_total_cop')}, 2) AS total_cop,
  {_mean('precio_cop_kwh')} AS precio_promedio_kwh
FROM d WHERE tipo_transaccion = 'compra' AND {_DONE}
GROUP BY tipo_energia ORDER BY total_kwh DESC, tipo_energia""",
    "q2": _with(*_D)
    + f"""SELECT nombre_cliente_proveedor AS cliente, COUNT(*) AS num_compras,
  ROUND({_exact('cantidad_kwh')}, 2) AS total_kwh_consumido,
  ROUND({_exact('valor_total_cop')}, 2) AS total_pagado_cop, clasificacion_volumen
FROM d WHERE tipo_transaccion = 'venta' AND {_DONE}
GROUP BY nombre_cliente_proveedor, clasificacion_volumen
ORDER BY total_kwh_consumido DESC, cliente, clasificacion_volumen LIMIT 5""",
    "q3": _with(*_D)
    + f"""SELECT tipo_energia, mercado, tipo_transaccion,
  {_mean('precio_cop_kwh')} AS precio_promedio,
  ROUND(MIN(precio_cop_kwh), 2) AS precio_min, ROUND(MAX(precio_cop_kwh), 2) AS precio_max,
  COUNT(*) AS num_operaciones
FROM d WHERE {_DONE} GROUP BY ALL ORDER BY tipo_energia, mercado, tipo_transaccion""",
    "q4": _with(*_D) + _PENDING,
    "q5": _with(*_D)
    + f""", b AS (
  SELECT tipo_energia, {_mean('precio_cop_kwh', 4)} AS pc, {_exact('cantidad_kwh')} AS kc
  FROM d WHERE tipo_transaccion = 'compra' AND {_DONE} GROUP BY tipo_energia
), s AS (
  SELECT tipo_energia, {_mean('precio_cop_kwh', 4)} AS pv, {_exact('cantidad_kwh')} AS kv
  FROM d WHERE tipo_transaccion = 'venta' AND {_DONE} GROUP BY tipo_energia
)
SELECT tipo_energia, pc AS precio_compra, pv AS precio_venta, ROUND(pv - pc, 4) AS margen_cop_kwh,
  ROUND((pv - pc) / pc * 100, 2) AS margen_pct, kc AS kwh_comprado, kv AS kwh_vendido
FROM b JOIN s USING (tipo_energia) ORDER BY margen_pct DESC, tipo_energia""",
    "q6": _with(*_C)
    + f"""SELECT segmento, ciudad, COUNT(*) AS num_clientes,
  {_mean('c.consumo_promedio_kwh')} AS consumo_promedio_kwh,
  ROUND({_exact('c.consumo_promedio_kwh')}, 2) AS consumo_total_kwh
FROM c GROUP BY segmento, ciudad ORDER BY segmento, consumo_total_kwh DESC""",
    "q7": _with(*_P)
    + """SELECT nombre_proveedor, tipo_energia, pais_origen, capacidad_mw, fecha_registro
FROM p WHERE activo ORDER BY capacidad_mw DESC NULLS LAST, nombre_proveedor""",
    "v_margen_energia": _with(*_E, _AGG_E)
    + """SELECT b.tipo_energia, b.precio_promedio_kwh AS precio_compra_kwh,
  s.precio_promedio_kwh AS precio_venta_kwh,
  CAST(s.precio_promedio_kwh - b.precio_promedio_kwh AS DECIMAL(13,4)) AS margen_cop_kwh,
  CAST(ROUND((s.precio_promedio_kwh - b.precio_promedio_kwh) / b.precio_promedio_kwh * 100, 2)
    AS DECIMAL(20,2)) AS margen_pct,
  b.total_kwh AS kwh_comprado, s.total_kwh AS kwh_vendido, b._fecha_ingesta
FROM agg_e b JOIN agg_e s ON b.tipo_energia = s.tipo_energia
  AND b._fecha_ingesta = s._fecha_ingesta
WHERE b.tipo_transaccion = 'compra' AND s.tipo_transaccion = 'venta'""",
    "v_resumen_diario": _with(*_T, _FACT)
    + f"""SELECT fecha_transaccion, tipo_energia, tipo_transaccion, COUNT(*) AS num_transacciones,
  CAST(SUM(cantidad_kwh) AS DECIMAL(28,2)) AS total_kwh,
  CAST(SUM(valor_total_cop) AS DECIMAL(30,2)) AS total_cop,
  CAST(ROUND(CAST(SUM(precio_cop_kwh) AS DOUBLE) / COUNT(precio_cop_kwh), 4) AS DECIMAL(12,4))
    AS precio_promedio
FROM fact WHERE {_DONE} GROUP BY ALL ORDER BY fecha_transaccion DESC, tipo_energia""",
    "dim_proveedores": _with(*_P, _DIM_P) + "SELECT * FROM dim_p",
    "dim_clientes": _with(*_C, _DIM_C) + "SELECT * FROM dim_c",
    "fact_transacciones": _with(*_T, _FACT) + "SELECT * FROM fact",
    "agg_metricas_energia": _with(*_E, _AGG_E) + "SELECT * FROM agg_e",
    "agg_metricas_segmento": _with(*_S, _AGG_S) + "SELECT * FROM agg_s",
    "dq_report": _with(*_P, *_C, *_T)
    + f"SELECT tabla, regla, filas_malas, filas_malas = 0 AS cumple FROM ({_REPORT})",
    "dq_unique": _with(_RAW_SUPPLIERS, _RAW_CUSTOMERS, _RAW_TRANSACTIONS)
    + """SELECT 'proveedores' AS tabla, nombre_proveedor AS clave, COUNT(*) AS filas
FROM raw_p GROUP BY nombre_proveedor HAVING COUNT(*) > 1
UNION ALL SELECT 'clientes', upper(trim(tipo_identificacion)) || '|' || identificacion, COUNT(*)
FROM raw_c GROUP BY 2 HAVING COUNT(*) > 1
UNION ALL SELECT 'transacciones', id_transaccion, COUNT(*)
FROM raw_t GROUP BY id_transaccion HAVING COUNT(*) > 1
UNION ALL SELECT 'clientes_nombre', trim(nombre), COUNT(*)
FROM raw_c GROUP BY 2 HAVING COUNT(*) > 1""",
    "quarantine": _with(_RAW_SUPPLIERS, _RAW_CUSTOMERS, _RAW_TRANSACTIONS)
    + f"""SELECT 'proveedores' AS tabla, nombre_proveedor AS clave, concat_ws(',',
    CASE WHEN capacidad_mw IS NOT NULL AND TRY_CAST(capacidad_mw AS DOUBLE) IS NULL
      THEN 'capacidad_mw' END,
    CASE WHEN fecha_registro IS NOT NULL AND ({_iso_day('fecha_registro')}) IS NULL
      THEN 'fecha_registro' END) AS motivo
FROM raw_p WHERE motivo <> ''
UNION ALL SELECT 'clientes', identificacion, concat_ws(',',
    CASE WHEN fecha_vinculacion IS NOT NULL AND ({_iso_day('fecha_vinculacion')}) IS NULL
      THEN 'fecha_vinculacion' END,
    CASE WHEN consumo_promedio_kwh IS NOT NULL AND TRY_CAST(consumo_promedio_kwh AS DOUBLE) IS NULL
      THEN 'consumo_promedio_kwh' END) AS motivo
FROM raw_c WHERE motivo <> ''
UNION ALL SELECT 'transacciones', id_transaccion, concat_ws(',',
    CASE WHEN TRY_CAST(cantidad_kwh AS DOUBLE) IS NULL THEN 'cantidad_kwh' END,
    CASE WHEN TRY_CAST(precio_cop_kwh AS DOUBLE) IS NULL THEN 'precio_cop_kwh' END) AS motivo
FROM raw_t WHERE motivo <> ''""",
    "clientes_analista": _with(*_C) + "SELECT * EXCLUDE (identificacion) FROM c",
}

# The same rows by way of stored tables.
ORACLES["stored_queries"] = ORACLES["q3"]
ORACLES["stored_margin"] = ORACLES["v_margen_energia"]
ORACLES["stored_summary"] = ORACLES["v_resumen_diario"]
ORACLES["analyst_views"] = ORACLES["clientes_analista"]
# Columns of the stored tables: those of their rows and three of the load date.
ORACLES["catalog_listing"] = " UNION ALL ".join(
    f"SELECT '{table}' AS tabla, CAST({columns} AS INTEGER) AS columnas"
    for table, columns in (
        ("proveedores", 11),
        ("clientes", 13),
        ("transacciones", 21),
        ("metricas_energia", 13),
        ("metricas_segmento", 11),
    )
)
# Over the raw texts, so apart from the typed and cleaned rows.
ORACLES["dq_source"] = _with(_RAW_SUPPLIERS, _RAW_CUSTOMERS, _RAW_TRANSACTIONS) + (
    "SELECT tabla, regla, filas_malas, filas_malas = 0 AS cumple FROM ("
    + " UNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{rule}' AS regla, COUNT(*) FILTER (WHERE {bad}) AS filas_malas "
        f"FROM {source}"
        for table, source, rule, bad in (
            ("proveedores", "raw_p", "tipo_energia_valido",
             "lower(trim(tipo_energia)) NOT IN ('eolica', 'hidroelectrica', 'nuclear')"),
            ("proveedores", "raw_p", "tipo_energia_no_nulo", "tipo_energia IS NULL"),
            ("proveedores", "raw_p", "nombre_no_nulo", "nombre_proveedor IS NULL"),
            ("clientes", "raw_c", "tipo_identificacion_valido",
             "upper(trim(tipo_identificacion)) NOT IN ('CC', 'NIT', 'CE', 'PP', 'TI')"),
            ("clientes", "raw_c", "tipo_identificacion_no_nulo", "tipo_identificacion IS NULL"),
            ("clientes", "raw_c", "identificacion_no_nula", "identificacion IS NULL"),
            ("transacciones", "raw_t", "id_no_nulo", "id_transaccion IS NULL"),
            ("transacciones", "raw_t", "tipo_energia_valido",
             "lower(trim(tipo_energia)) NOT IN ('eolica', 'hidroelectrica', 'nuclear')"),
            ("transacciones", "raw_t", "tipo_transaccion_valido",
             "lower(trim(tipo_transaccion)) NOT IN ('compra', 'venta')"),
        )
    )
    + ")"
)
