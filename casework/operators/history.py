"""History table operators: watermark, as-of state, keyed updates, sync,
and the Parquet write paths (S05, S07, S08, S10-S12, J01-J09, A01-A03).

The history is a Parquet table partitioned by ``week``.  Appends are plain
``mode("append")`` jobs (atomic per job, unlike chunked commits); keyed
updates rewrite only the touched week partitions through dynamic partition
overwrite, staged to a new path first because a plan must never read and
overwrite the same files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions import rules
from casework.functions.scalars import to_timestamp_lenient, week_start
from casework.operators.categorize import outcome_columns
from casework.operators.dedup import keep_first_per_key, keep_last_per_key
from casework.operators.joins import DEFAULT_BROADCAST_ROWS, materialize_checked
from casework.session import write_table

KEY = "dni_categorizado"
DISTRICT = "comuna_calculada"
TS = "fecha_inicio"
SEQ = "_seq"

RECONCILE_COLUMNS = ["estado", "fecha_fin", "cierre_texto", "texto_limpio",
                     "categoria_final", "nivel_contacto", "contacto", "brinda_datos"]


# -- watermark and stats (A01-A03) -------------------------------------------

def watermark(df: DataFrame, ts: str = TS) -> DataFrame:
    """Max date (null when empty); column-pruned scan."""
    return df.agg(F.max(ts).alias("watermark"))


def table_stats(df: DataFrame, ts: str = TS) -> DataFrame:
    """count/min/max."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def after_watermark(df: DataFrame, wm: Column | None, ts: str = TS, known: DataFrame | None = None,
                    key: list[str] | None = None) -> DataFrame:
    """Strictly after the watermark; a null watermark keeps
    everything; null dates are dropped when a watermark exists (parity:
    late rows are lost).  With ``known`` (the history) and ``key``, rows at
    or before the watermark whose key is absent from the history are kept
    too (late-arrival mode, an anti join on the key)."""
    if wm is None:
        return df
    fresh = df.filter(wm.isNull() | (F.col(ts) > wm))
    if known is None:
        return fresh
    late = df.filter(F.col(ts) <= wm).join(known.select(*key), key, "left_anti")
    return fresh.unionByName(late)


# -- as-of state (J01, J02) --------------------------------------------------

def day_bound(ts: Column) -> Column:
    """J01 parity: the bound is the calendar day of the batch minimum."""
    return F.date_trunc("day", ts)


def last_state_asof(history: DataFrame, bound: Column | None, key: str = KEY, value: str = DISTRICT,
                    ts: str = TS, seq: str = SEQ) -> DataFrame:
    """Last ``value`` per ``key`` from rows strictly before ``bound``
    (null dates excluded).  One aggregation, map-side combined."""
    h = history.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if bound is not None:
        h = h.filter(F.col(ts) < bound)
    return h.groupBy(key).agg(F.max_by(F.col(value), F.struct(ts, seq)).alias("last_" + value))


def last_state_legacy(history: DataFrame, key: str = KEY, value: str = DISTRICT, ts: str = TS,
                      seq: str = SEQ) -> DataFrame:
    """Latest row per key with no date bound, five anonymous labels
    excluded; a null date sorts first under DESC (so it wins), as in the
    source database."""
    h = history.filter(F.col(key).isNotNull() & ~F.col(key).isin(rules.ANONYMOUS_ID_LABELS + [rules.FOREIGN_ID]))
    order = F.struct(F.col(ts).isNull().alias("_null_first"), F.col(ts), F.col(seq))
    return h.groupBy(key).agg(F.max_by(F.col(value), order).alias("last_" + value))


# -- semi-join counts (J03) ----------------------------------------------------

def semi_join_counts(history: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """History counts for the given keys only (semi join first, so the
    history rows of other keys never reach the aggregation shuffle)."""
    return (history.select(key).join(keys.select(key).distinct(), key, "left_semi")
                   .groupBy(key).agg(F.count(F.lit(1)).alias("n_hist")))


# -- keyed updates (J04-J07) ---------------------------------------------------

def reconcile_updates(export: DataFrame, history: DataFrame, fuzzy: bool = True) -> DataFrame:
    """J04 source side: rows of the full export whose id is pending in the
    history and whose (trimmed) state is no longer PENDIENTE; derived outcome
    columns recomputed; first export row per id wins."""
    pending_ids = history.filter(F.col("estado") == "PENDIENTE").select("id_suceso").distinct()
    given = ["id_suceso", SEQ, "estado", "fecha_fin", "cierre_supervisor", "resultado"]
    closed = (export.filter(F.coalesce(F.trim(F.col("estado")), F.lit("")) != "PENDIENTE")
                    .select(*given).join(pending_ids, "id_suceso", "left_semi"))
    # the first row is known before its outcome is worked out, and read twice from there
    first = write_table(keep_first_per_key(closed, ["id_suceso"], [SEQ]), "closed_rows")
    first = outcome_columns(first, fuzzy=fuzzy).withColumn("fecha_fin", to_timestamp_lenient(F.col("fecha_fin")))
    return first.select(F.trim("id_suceso").alias("id_suceso"), *RECONCILE_COLUMNS)


def apply_keyed_update(target: DataFrame, updates: DataFrame, key: str, columns: list[str],
                       predicate: Column | None = None,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace ``columns`` of target rows whose ``key`` has an update (and
    which satisfy ``predicate``); nulls in the update do overwrite.  Adds a
    boolean ``_updated``.  The update table is materialised and counted:
    broadcast under the bound, shuffle join (AQE skew-split) above it."""
    upd, small = materialize_checked(
        updates.select(F.col(key).alias("_u_key"), *[F.col(c).alias("_u_" + c) for c in columns]),
        max_broadcast_rows)
    side = F.broadcast(upd) if small else upd
    joined = target.join(side, F.col(key) == F.col("_u_key"), "left")
    hit = F.col("_u_key").isNotNull()
    if predicate is not None:
        hit = hit & F.coalesce(predicate, F.lit(False))
    out = joined.withColumn("_updated", hit)
    return (out.withColumns({c: F.when(F.col("_updated"), F.col("_u_" + c)).otherwise(F.col(c)) for c in columns})
               .drop("_u_key", *["_u_" + c for c in columns]))


def reconcile_pending(history: DataFrame, export: DataFrame, fuzzy: bool = True) -> DataFrame:
    """History with pending rows closed from the export.  Every
    pending row of a matched id is updated; ``_updated`` marks them (the
    source's returned count is ``sum(_updated)``)."""
    updates = reconcile_updates(export, history, fuzzy=fuzzy)
    return apply_keyed_update(history, updates, "id_suceso", RECONCILE_COLUMNS,
                              predicate=F.col("estado") == "PENDIENTE")


def keyed_update(target: DataFrame, updates: DataFrame, key: str, columns: list[str],
                 order: list[str]) -> DataFrame:
    """Update by a non-unique id after a deterministic dedup (last by
    ``order``)."""
    dedup = keep_last_per_key(updates.select(key, *order, *columns), [key], order)
    return apply_keyed_update(target, dedup.select(key, *columns), key, columns)


def patch_from_lookup(target: DataFrame, lookup: DataFrame, key: str, columns: list[str],
                      order: list[str], keep_unmatched: bool = True) -> DataFrame:
    """Patch from a lookup keyed by id, last row per id wins.  With
    ``keep_unmatched=False`` (source parity) rows absent from the lookup get
    nulls in ``columns``."""
    dedup = keep_last_per_key(lookup.select(key, *order, *columns), [key], order).select(key, *columns)
    out = apply_keyed_update(target, dedup, key, columns)
    if not keep_unmatched:
        out = out.withColumns({c: F.when(F.col("_updated"), F.col(c)) for c in columns})
    return out


def catchup_delta(history: DataFrame, snapshot: DataFrame, ts: str = TS) -> DataFrame:
    """History rows newer than the snapshot's max date; a null max
    copies everything (fix of the source's ``> NULL`` quirk)."""
    snap_max = snapshot.select(F.max(ts)).scalar()
    return history.filter(snap_max.isNull() | (F.col(ts) > snap_max))


# -- write paths (S07, S08, S11, S12) ------------------------------------------

def append_history(df: DataFrame, path: str, ts: str = TS, max_records_per_file: int = 5_000_000) -> None:
    """Append, partitioned by Monday week, sorted by date inside
    each file (L01).  The rebalance hint brings the rows of a week together,
    so a first load doesn't write tasks x weeks small files, while adaptive
    execution splits a week that is larger than the advisory size over
    several tasks; the local sort keeps one open writer per task and gives
    row-group date statistics for pruning."""
    (df.withColumn("week", week_start(F.col(ts))).hint("rebalance", "week")
       .sortWithinPartitions("week", ts)
       .write.mode("append").option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("week").parquet(path))


def append_raw(df: DataFrame, path: str, ts: str = TS) -> None:
    """Bronze copy of the landing rows as received (before cleaning)."""
    append_history(df, path, ts)


def overwrite_partitions(df: DataFrame, path: str) -> None:
    """Rewrite only the week partitions present in ``df`` (dynamic partition
    overwrite).  ``df`` must not read from ``path``: stage it first."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("week").parquet(path))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Whole-table overwrite, snappy."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
