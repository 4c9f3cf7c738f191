"""Adapter: the driver's ``events`` table -> an ``interventions`` landing view.

The test tables carry no case records, so every query composes on a view
derived from ``events`` with arithmetic and CASE only.  The expressions are
written once, in the SQL subset shared by Spark SQL and DuckDB, so that the
Spark plans and the DuckDB oracle start from byte-identical inputs.  Work
grows with ``events``: one output row per event, no sampling.

Landing semantics: all text columns are strings as a spreadsheet export
would deliver them (coordinates with dot or comma decimals, ids as text);
``fecha_inicio`` is already typed; ``_seq`` is the file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casework.session import table_path

_VALID_ID = "CAST(30000000 + user_id AS STRING)"
_X = "((event_id * 7919) % 1000)"
_Y = "((event_id * 104729) % 600)"


def _decimal_text(v: str) -> str:
    return f"CAST(FLOOR({v} / 100) AS BIGINT) || '.' || lpad(CAST({v} % 100 AS STRING), 2, '0')"


# (column, expression) in the Spark/DuckDB common SQL subset
INTERVENTION_COLUMNS: list[tuple[str, str]] = [
    ("_seq", "event_id"),
    ("id_suceso", "CAST(CAST(FLOOR(event_id / 2) AS BIGINT) AS STRING)"),
    ("id_suceso_asociado",
     "CASE event_id % 33 WHEN 5 THEN CAST(event_id AS STRING) WHEN 6 THEN 'abc' "
     "WHEN 7 THEN NULL WHEN 8 THEN '0.0' ELSE '0' END"),
    ("fecha_inicio", "ts"),
    ("fecha_fin", "CASE WHEN event_type = 'error' THEN NULL ELSE ts + INTERVAL 1 HOUR END"),
    ("persona_dni",
     "CASE event_id % 23 "
     "WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'dni ilegible' WHEN 3 THEN 'xX.*' "
     "WHEN 4 THEN 'SD' WHEN 5 THEN '--' WHEN 6 THEN 'no brindo' "
     f"WHEN 7 THEN 'pasaporte ' || {_VALID_ID} "
     f"WHEN 8 THEN 'sin dni ' || {_VALID_ID} "
     f"WHEN 9 THEN substr({_VALID_ID}, 1, 2) || '.' || substr({_VALID_ID}, 3, 3) || '.' || substr({_VALID_ID}, 6, 3) "
     "WHEN 10 THEN '012345' WHEN 11 THEN '7777777' WHEN 12 THEN '12345678901' WHEN 13 THEN 'aaaab' "
     f"WHEN 14 THEN ' ' || {_VALID_ID} || ' ' "
     f"ELSE {_VALID_ID} END"),
    ("persona_nombre",
     "CASE user_id % 8 WHEN 0 THEN ' josé-maría  o''peña, ' WHEN 1 THEN 'Ana' || chr(9) || 'Paz' "
     "WHEN 2 THEN '123' WHEN 3 THEN NULL WHEN 4 THEN 'Zoë Ñandú' WHEN 5 THEN 'Jürgen.Straße' "
     "WHEN 6 THEN 'Renée' ELSE 'ÁNGEL' END"),
    ("persona_apellido",
     "CASE user_id % 6 WHEN 0 THEN 'Gómez' WHEN 1 THEN 'Müller' WHEN 2 THEN 'Núñez-Ibáñez' "
     "WHEN 3 THEN NULL WHEN 4 THEN 'François' ELSE 'Pérez' END"),
    ("latitud",
     f"CASE event_id % 13 WHEN 0 THEN NULL WHEN 1 THEN replace({_decimal_text(_Y)}, '.', ',') "
     f"ELSE {_decimal_text(_Y)} END"),
    ("longitud",
     f"CASE event_id % 13 WHEN 1 THEN replace({_decimal_text(_X)}, '.', ',') WHEN 2 THEN 'abc' "
     f"ELSE {_decimal_text(_X)} END"),
    ("agencia",
     "CASE event_id % 17 WHEN 0 THEN 'AREA OPERATIVA' WHEN 1 THEN 'SALUD MENTAL' WHEN 2 THEN NULL "
     "ELSE 'BAP ' || CAST(event_id % 4 AS STRING) END"),
    ("estado",
     "CASE WHEN event_type = 'error' THEN 'PENDIENTE' "
     "WHEN event_type = 'signup' AND event_id % 5 = 0 THEN ' pendiente ' ELSE 'CERRADO' END"),
    ("tipo_carta", "CASE event_id % 3 WHEN 0 THEN 'AUTOMATICA' WHEN 1 THEN 'MANUAL' ELSE ' manual ' END"),
    ("origen",
     "CASE event_id % 22 WHEN 0 THEN 'SIN TECHO' WHEN 1 THEN 'ESPONTANEO' WHEN 2 THEN 'VECINO' "
     "WHEN 3 THEN 'ONG' WHEN 4 THEN 'GESTION COLABORATIVA' WHEN 5 THEN '911' "
     "WHEN 6 THEN 'ORGANISMOS PUBLICOS' WHEN 7 THEN 'DESDE BAP/MDR' "
     "WHEN 8 THEN 'PUNTO POLITICO/INGRESO POR FUERA 108' WHEN 9 THEN 'SUBTE' "
     "WHEN 10 THEN 'ESPACIOS PUBLICOS' WHEN 11 THEN 'JUDICIALES' WHEN 12 THEN 'BOTI' "
     "WHEN 13 THEN 'MONITOREO 108' WHEN 14 THEN 'CAJEROS' WHEN 15 THEN 'seguimiento' "
     "WHEN 16 THEN 'ADICCIONES' WHEN 17 THEN 'NIÑA/NIÑO' WHEN 18 THEN 'CORTAN' "
     "WHEN 19 THEN ' equivocado ' WHEN 20 THEN NULL ELSE 'OTRA COSA' END"),
    ("resultado",
     "CASE event_id % 29 "
     "WHEN 0 THEN '01-Traslado efectivo a CIS' "
     "WHEN 1 THEN '12–No se contacta y no se observan pertenencias' "
     "WHEN 2 THEN '04-Traslado/acompañamiento a otros efectores' "
     "WHEN 3 THEN '02. Traslado efectivo a DIPA' "
     "WHEN 4 THEN '07. Se realiza entrevista y se retira del lugar' "
     "WHEN 5 THEN '13. Derivación a SAME por salud mental' "
     "WHEN 6 THEN '16. No se observan personas y hay pertenencias' "
     "WHEN 7 THEN '18. Mendicidad' WHEN 8 THEN '19. Sin cubrir' WHEN 9 THEN '20. Desestimado' "
     "WHEN 10 THEN 'POSITIVO' WHEN 11 THEN 'DERIVACION A RED' "
     "WHEN 12 THEN '17 DIPA - Derivación a CIS' "
     "WHEN 13 THEN '16 DIPA - Entrega de insumos/servicios, 7 POSITIVO - Entrega de insumos' "
     "WHEN 14 THEN 'Se activa protocolo de salud mental hoy' "
     "WHEN 15 THEN 'se llama a SAME' "
     "WHEN 16 THEN 'Rechaza entrevista y se retira del lugar' "
     "WHEN 17 THEN 'zzzz qqqq' "
     "WHEN 18 THEN 'Acepta CYS pero no hay vacante' "
     "WHEN 19 THEN 'NEGATIVO' WHEN 20 THEN 'SIN DATO' WHEN 21 THEN '-' WHEN 22 THEN NULL "
     "WHEN 23 THEN '14. Derivación a Seguridad' "
     "WHEN 24 THEN 'Mendicidad infantil en la esquina' "
     "WHEN 25 THEN 'Traslado efectivo a lugar de orgen' "
     "WHEN 26 THEN '09. Derivación al equipo de Umbral Cero de Primer Abordaje' "
     "WHEN 27 THEN '16-Desestimado (cartas 911 u otras áreas)' "
     "ELSE '05. Traslado efectivo a lugar de origen' END"),
    ("cierre_supervisor",
     "CASE WHEN event_id % 7 = 0 THEN CASE event_id % 5 "
     "WHEN 0 THEN '01. Traslado efectivo a CIS' WHEN 1 THEN 'N/A' "
     "WHEN 2 THEN '17. No se observan personas ni pertenencias' "
     "WHEN 3 THEN 'Se retira del lugar' ELSE '(Vacio)' END ELSE NULL END"),
]

# dates as exports write them, from events.ts (Spark/DuckDB common SQL subset)
LANDING_DATE_TEXT = (
    "CASE event_id % 7 "
    "WHEN 0 THEN CAST(month(ts) AS STRING) || '/' || CAST(day(ts) AS STRING) || '/' || CAST(year(ts) AS STRING) "
    "WHEN 1 THEN CAST(day(ts) AS STRING) || '/' || CAST(month(ts) AS STRING) || '/' || CAST(year(ts) AS STRING) "
    "|| ' ' || lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') "
    "WHEN 2 THEN CAST(CAST(ts AS DATE) AS STRING) "
    "WHEN 3 THEN lpad(CAST(day(ts) AS STRING), 2, '0') || '-' || lpad(CAST(month(ts) AS STRING), 2, '0') || '-' "
    "|| CAST(year(ts) AS STRING) WHEN 4 THEN '31/02/2026' WHEN 5 THEN 'sin fecha' ELSE NULL END")


def interventions_sql(source: str = "events") -> str:
    """The adapter as one SELECT (used by the DuckDB oracle)."""
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in INTERVENTION_COLUMNS)
    return f"SELECT\n  {cols}\nFROM {source}"


def interventions_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*[f"{expr} AS {name}" for name, expr in INTERVENTION_COLUMNS])


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work over a scan that one task would do alone one
    task per core.

    A table of one split, or of a few splits of which a single one holds all
    rows (a file of one row group), would run every regex and rule chain on one
    core, so it is dealt round-robin.  Tables of more splits than cores are
    never looked into, and those of two or more splits with rows never
    shuffled."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a remote session): keep the scan as is
        return df
    if 1 < splits <= target:  # no column is read: row counts come from the footers
        splits = df.select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    return df.repartition(target) if splits == 1 else df


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(table_path(sf_dir, name)))


def load_interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interventions_from_events(load_table(spark, sf_dir, "events"))
