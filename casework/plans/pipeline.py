"""Weekly incremental ETL composed as one lazy plan per step.

``clean_batch``: W01 exact dedup -> P02 blank strip -> G03 zone -> F03 id ->
F01 names -> P03 agency filter -> outcome columns (P04 P05 F02 C05 F09 F10).
``run_weekly``: P01 watermark -> J04 reconcile (full export) -> clean ->
W04-W07 + A04 against history -> S07 append.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions import rules
from casework.functions.identity import with_id_category
from casework.functions.scalars import week_start
from casework.functions.text import clean_name, strip_blanks
from casework.operators.categorize import outcome_columns
from casework.operators.dedup import drop_exact_duplicates
from casework.operators.evolution import (classify_batch, classify_batch_with_state, starts_after,
                                          update_person_state)
from casework.operators.geo import ZoneIndex, assign_zone
from casework.operators.history import (RECONCILE_COLUMNS, after_watermark, append_history,
                                        apply_keyed_update, overwrite_partitions, reconcile_updates)
from casework.operators.joins import materialize_checked
from casework.session import cut_lineage, write_table


def strip_all_strings(df: DataFrame) -> DataFrame:
    """P02 (keeping real nulls; see README deviations)."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[strip_blanks(F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def drop_internal_agencies(df: DataFrame, col: str = "agencia") -> DataFrame:
    """Exact match against the excluded set; null agency kept."""
    return df.filter(~F.coalesce(F.col(col).isin(rules.EXCLUDED_AGENCIES), F.lit(False)))


def identity_columns(df: DataFrame, mode: str = "parity") -> DataFrame:
    """F03 + F01 on the person columns."""
    out = with_id_category(df, "persona_dni", "dni_categorizado", "dni_categorizado_motivo", mode)
    return out.withColumns({"persona_nombre": clean_name(F.col("persona_nombre")),
                            "persona_apellido": clean_name(F.col("persona_apellido"))})


def clean_batch(raw: DataFrame, fuzzy: bool = True, id_mode: str = "parity", dedup: bool = True,
                zones: ZoneIndex | None = None) -> DataFrame:
    """C06 with geo: the cleaning half of the weekly run (``zones``: the index
    of ``geo.read_zones``, else the built-in layer)."""
    df = drop_exact_duplicates(raw) if dedup else raw
    df = strip_all_strings(df)
    df = assign_zone(df, zones=zones)
    df = identity_columns(df, id_mode)
    df = drop_internal_agencies(df)
    # the outcome texts come from the raw rows: a text more than once is no matter, so nothing is deduplicated for them
    texts = drop_internal_agencies(strip_all_strings(raw.select("cierre_supervisor", "resultado", "agencia")))
    return outcome_columns(df, fuzzy=fuzzy, texts=texts)


# FIXED VALUES: texts that count as a missing categorised id after a merge
BLANK_ID_TEXTS = ["none", "nan", "<na>", "", "null"]


def repair_blank_ids(df: DataFrame, mode: str = "parity") -> DataFrame:
    """Rows whose categorised id is null or a blank marker get F03
    recomputed from the raw id (the reason column is left as is)."""
    blank = F.col("dni_categorizado").isNull() | \
        F.lower(strip_blanks(F.col("dni_categorizado"))).isin(BLANK_ID_TEXTS)
    staged = with_id_category(df.withColumn("_blank", blank), "persona_dni", "_dni_fix", "_dni_fix_reason", mode)
    return (staged.withColumn("dni_categorizado",
                              F.when(F.col("_blank"), F.col("_dni_fix")).otherwise(F.col("dni_categorizado")))
                  .drop("_blank", "_dni_fix", "_dni_fix_reason"))


def snapshot_merge(prev: DataFrame, new: DataFrame) -> DataFrame:
    """S09 + U01 + P15: coerce the new rows to the snapshot's types, union by
    name (missing columns -> null) and repair ids left blank by the merge."""
    prev_types = {f.name: f.dataType for f in prev.schema.fields}
    coerced = new.select(*[
        (F.col(f.name) if f.dataType == prev_types[f.name] else F.col(f.name).try_cast(prev_types[f.name])).alias(f.name)
        if f.name in prev_types else F.col(f.name)
        for f in new.schema.fields])
    merged = prev.unionByName(coerced, allowMissingColumns=True)
    if "dni_categorizado" not in merged.columns:
        merged = merged.withColumn("dni_categorizado", F.lit(None).cast("string"))
    return repair_blank_ids(merged)


@dataclass
class WeeklyResult:
    batch: DataFrame          # classified new rows (appended)
    history: DataFrame        # history after reconcile; with a path the table as stored, batch included
    n_reconciled: int
    person_state: DataFrame | None = None   # merged state when the state path is used


def run_weekly(export: DataFrame, history: DataFrame, history_path: str | None = None,
               wm: Column | None = None, fuzzy: bool = True,
               person_state: DataFrame | None = None, zones: ZoneIndex | None = None) -> WeeklyResult:
    """T01 end to end.

    Reconciliation (J04) touches only pending rows of closed incidents, so
    only the week partitions holding them are rewritten: the update table is
    materialised (small), the touched weeks are found with a semi join, those
    partitions are rebuilt into a staging table and swapped in with dynamic
    partition overwrite - the history is never copied whole, and no plan
    reads and overwrites the same files.  The evolution labels only need
    districts and counts, which reconciliation never changes, so the batch is
    classified against the history as read (or against ``person_state``, the
    compact per-person table, whose merged version is returned; a batch that
    starts on a day the state already holds is classified by the history)."""
    if "week" not in history.columns:
        history = history.withColumn("week", week_start(F.col("fecha_inicio")))
    updates, small = materialize_checked(reconcile_updates(export, history.drop("week"), fuzzy=fuzzy))
    upd_keys = updates.select("id_suceso")
    touched_weeks = (history.filter(F.col("estado") == "PENDIENTE")
                            .join(F.broadcast(upd_keys) if small else upd_keys, "id_suceso", "left_semi")
                            .select(F.col("week").alias("_touched")).distinct())
    # rows without a date are a partition of their own, so the weeks are compared null-safe
    touched_weeks = write_table(touched_weeks, "touched_weeks")
    same_week = F.col("week").eqNullSafe(F.col("_touched"))
    part = history.join(touched_weeks, same_week, "left_semi")
    rebuilt = write_table(
        apply_keyed_update(part, updates, "id_suceso", RECONCILE_COLUMNS,
                           predicate=F.col("estado") == "PENDIENTE"), "reconciled_weeks")
    n = rebuilt.filter("_updated").count()

    new_rows = after_watermark(export, wm)
    cleaned = cut_lineage(clean_batch(new_rows, fuzzy=fuzzy, zones=zones))
    new_state = None
    base = history.drop("week")
    if person_state is not None:
        classified = (classify_batch_with_state(cleaned, person_state) if starts_after(cleaned, person_state)
                      else classify_batch(cleaned, base))
        new_state = write_table(update_person_state(person_state, cleaned), "person_state")
    else:
        classified = classify_batch(cleaned, base)
    # everything that reads the history is materialised before its files change
    classified = write_table(classified, "classified_batch")
    if history_path is not None:
        overwrite_partitions(rebuilt.drop("_updated"), history_path)
        append_history(classified, history_path)
        after = history.sparkSession.read.parquet(history_path).drop("week")
    else:
        after = history.join(touched_weeks, same_week, "left_anti").unionByName(rebuilt.drop("_updated")).drop("week")
    return WeeklyResult(batch=classified, history=after, n_reconciled=n, person_state=new_state)
