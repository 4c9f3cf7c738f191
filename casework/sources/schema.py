"""Schema handling at the boundary.

Header drift is absorbed once, at ingestion: a fixed rename map, then a
normalised-name lookup (case, spaces and underscores ignored), then a
``select`` that aligns to the target schema with ``try_cast`` coercion.
All of it is projection only (no job, no shuffle).
"""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions.scalars import to_wall_clock
from casework.functions.text import strip_blanks
from casework.session import path_exists
from casework.sources import split_csv

# ---------------------------------------------------------------------------
# FIXED VALUES: source header renames
# ---------------------------------------------------------------------------
BATCH_HEADER_RENAMES = {
    "Id.Suceso": "Id Suceso",
    "Documento": "Persona DNI",
    "Nombre": "Persona Nombre",
    "Apellido": "Persona Apellido",
}
REPORT_HEADER_RENAMES = {
    "Resultado": "resultado",
    "Estado": "estado",
    "Agencia": "agencia",
    "Origen": "origen",
    "DNI_Categorizado": "DNI_categorizado",
    "Id Suceso": "id suceso",
}
LEGACY_TITLES = {
    "fecha_inicio": "Fecha Inicio",
    "fecha_fin": "Fecha Fin",
    "id_suceso": "Id Suceso",
    "persona_dni": "Persona DNI",
    "latitud": "Latitud",
    "longitud": "Longitud",
    "agencia": "Agencia",
    "tipo_carta": "Tipo Carta",
    "origen": "Origen",
    "tipo": "Tipo",
    "subtipo": "SubTipo",
    "recurso_fecha_liberado": "Recurso Fecha Liberado",
    "recurso_fecha_asignacion": "Recurso Fecha asignacion",
    "recurso_arribo": "Recurso Arribo",
    "comuna_calculada": "comuna_calculada",
    "dni_categorizado": "dni_categorizado",
}
# end of FIXED VALUES

# Canonical (snake_case) history schema used by this engine.
HISTORY_SCHEMA = T.StructType([
    T.StructField("_seq", T.LongType()),
    T.StructField("id_suceso", T.StringType()),
    T.StructField("id_suceso_asociado", T.StringType()),
    T.StructField("fecha_inicio", T.TimestampNTZType()),
    T.StructField("fecha_fin", T.TimestampNTZType()),
    T.StructField("persona_dni", T.StringType()),
    T.StructField("persona_nombre", T.StringType()),
    T.StructField("persona_apellido", T.StringType()),
    T.StructField("latitud", T.StringType()),
    T.StructField("longitud", T.StringType()),
    T.StructField("agencia", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("tipo_carta", T.StringType()),
    T.StructField("origen", T.StringType()),
    T.StructField("resultado", T.StringType()),
    T.StructField("cierre_supervisor", T.StringType()),
])

# What the weekly job keeps of a landing export: the above and the columns that no operator reads.
LANDING_SCHEMA = T.StructType(HISTORY_SCHEMA.fields + [
    T.StructField("tipo", T.StringType()),
    T.StructField("subtipo", T.StringType()),
    T.StructField("recurso_fecha_asignacion", T.TimestampNTZType()),
    T.StructField("recurso_fecha_liberado", T.TimestampNTZType()),
    T.StructField("recurso_arribo", T.TimestampNTZType()),
])


def norm_header(name: str) -> str:
    """Lower case without spaces and underscores (S06/S15 matching key)."""
    return re.sub(r"[ _]", "", name.lower())


def snake_case(name: str) -> str:
    """Legacy snake_case header form; only blanks change, other signs stay."""
    return "_".join(name.strip().lower().split(" "))


def title_case(name: str) -> str:
    """Legacy Title Case header form, from the fixed table where it has the name."""
    return LEGACY_TITLES.get(name) or name.replace("_", " ").title()


def rename_headers(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Fixed renames; names absent from the frame are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def _aligned(df: DataFrame, target: T.StructType, day_first: bool) -> list[tuple[T.StructField, str | None, Column]]:
    """Every target field, its source column, and its value."""
    by_norm: dict[str, str] = {}
    for c in df.columns:
        by_norm[norm_header(c)] = c
    out = []
    for f in target.fields:
        src = by_norm.get(norm_header(f.name))
        if src is None:
            value = F.lit(None).cast(f.dataType)
        elif df.schema[src].dataType == f.dataType:
            value = F.col(f"`{src}`")
        elif isinstance(f.dataType, T.TimestampNTZType) and isinstance(df.schema[src].dataType, T.StringType):
            value = to_wall_clock(F.col(f"`{src}`"), day_first)
        else:
            value = F.col(f"`{src}`").try_cast(f.dataType)
        out.append((f, src, value.alias(f.name)))
    return out


def align_to_schema(df: DataFrame, target: T.StructType, day_first: bool = False) -> DataFrame:
    """S06 + S09: match source columns to target fields on the normalised
    name (last source column wins a collision), missing -> typed null,
    extras dropped, target order, values coerced with ``try_cast``
    (unparsable -> null), dates written as text with ``to_wall_clock``."""
    return df.select(*[value for _, _, value in _aligned(df, target, day_first)])


CORRUPT = "_corrupt_record"  # where a reader puts a record that it can't part into columns


def split_landing(df: DataFrame, target: T.StructType, day_first: bool = False,
                  required: tuple[str, ...] = ("fecha_inicio",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landed rows as (accepted, rejected, notes); each row is accepted or
    rejected.  Rejected are malformed records, and rows without a usable value
    in a ``required`` column (an undated row can't be placed in a week, however
    valid its id): _seq, reasons, and the row as landed, as JSON.  ``notes``
    has a row (_seq, reason) for every other value that didn't parse and so is
    null in ``accepted`` (aligned to ``target``)."""
    reasons, unusable = [], F.lit(False)
    if CORRUPT in df.columns:
        unusable = F.col(CORRUPT).isNotNull()
        reasons.append(F.when(unusable, F.lit("malformed")))
    fields = _aligned(df.drop(CORRUPT), target, day_first)
    for f, src, value in fields:
        is_text = src is not None and isinstance(df.schema[src].dataType, T.StringType)
        blank = F.col(f"`{src}`").isNull() if src is not None else F.lit(True)
        if is_text:
            blank = blank | (strip_blanks(F.col(f"`{src}`")) == "")
        if not isinstance(f.dataType, T.StringType) and src is not None:
            reasons.append(F.when(~blank & value.isNull(), F.lit(f"{f.name}: not parsed")))
        if f.name in required:
            unusable = unusable | value.isNull()
            reasons.append(F.when(blank, F.lit(f"{f.name}: absent")))
    seq = F.col("_seq") if "_seq" in df.columns else F.lit(None).cast("long").alias("_seq")
    marked = df.withColumns({"_reasons": F.array_compact(F.array(*reasons)), "_unusable": unusable})
    landed = [F.col(f"`{c}`") for c in df.columns]
    rejected = marked.filter("_unusable").select(seq, F.col("_reasons").alias("reasons"), F.to_json(F.struct(*landed)).alias("row"))
    kept = marked.filter("NOT _unusable")
    return kept.select(*[value for _, _, value in fields]), rejected, kept.select(seq, F.explode("_reasons").alias("reason"))


def canonical_headers(df: DataFrame) -> DataFrame:
    """One rename of every header to snake_case after the fixed renames;
    of headers that become alike the last column stays."""
    df = rename_headers(df, BATCH_HEADER_RENAMES)
    names = [snake_case(c) for c in df.columns]
    last = {name: i for i, name in enumerate(names)}
    beaten = [i for i, name in enumerate(names) if last[name] != i]
    apart = df.toDF(*[f"_beaten_{i}" if i in beaten else name for i, name in enumerate(names)])
    return apart.drop(*[f"_beaten_{i}" for i in beaten])


def read_landing_csv(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True,
                     keep_malformed: bool = False) -> DataFrame:
    """Landing exports whose first line is a banner and whose next record
    is the header; every column arrives as a string.

    Banner and header of each file come with the pass that finds where records
    begin in each split (``split_csv``), one row a file.  Files with the same
    header are read together; files with other headers are joined to them by
    column name.  ``multiline`` keeps quoted fields with line breaks whole; a
    file is read by as many tasks as it has splits either way.
    ``keep_malformed`` adds a column with the text of records of too few or too
    many fields."""
    files, read = split_csv.read_files(spark, path, sep, multiline)
    groups: dict[str, list[str]] = {}
    for f in files:
        groups.setdefault(f.header, []).append(f.file)
    out = None
    for header, paths in groups.items():
        names = next(csv.reader(io.StringIO(header, newline=""), delimiter=sep))
        part = read(paths, len(names), CORRUPT)
        part = part.select(*[F.col(f"_c{i}").alias(n.strip()) for i, n in enumerate(names)], *([CORRUPT] if keep_malformed else []))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_history(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The history table (empty frame of the schema when absent)."""
    if schema is not None and not path_exists(spark, path):  # first load; any other failure is an error
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_history_with(spark: SparkSession, path: str, landing: T.StructType) -> DataFrame:
    """The stored history with every column of ``landing``: files written
    before a column was kept hold null for it.  File schemas are merged only
    if the plain read, which trusts one file, lacks a column."""
    hist = spark.read.parquet(path)
    if not {f.name for f in landing.fields} <= set(hist.columns):
        hist = spark.read.option("mergeSchema", "true").parquet(path)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in landing.fields if f.name not in hist.columns}
    return hist.withColumns(absent) if absent else hist
