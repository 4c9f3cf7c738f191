"""Person evolution labels and cumulative appearances.

Plan shape (no per-row windows over a person key):

1. Batch rows with a valid id are reduced to one row per (id, week) by an
   aggregation (``max_by`` district of the latest row = the week's reference
   record, ``min`` of (ts, seq) = the week's first row).  Map-side combine
   makes a hot id cheap.
2. The as-of history state (one row per id, J01) is unioned in as "week 0"
   and a window over each id orders its handful of weekly rows: ``lag``
   gives the previous state (not ignoring nulls: a null district replaces
   the state), ``row_number`` gives first-seen.  Window partitions hold at
   most (#weeks + 1) rows whatever the row skew.
3. Labels and appearance counts are joined back to the rows on (id, week);
   invalid ids never enter steps 1-2 (the anonymous label would otherwise be
   one giant partition) and are unioned back as "No clasificable".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casework.functions.identity import is_valid_id
from casework.functions.scalars import week_start
from casework.operators.history import DISTRICT, KEY, SEQ, TS, day_bound


def weekly_reference(valid: DataFrame, key: str = KEY, district: str = DISTRICT, ts: str = TS,
                     seq: str = SEQ) -> DataFrame:
    """Per (id, week) the district of the latest row and the first row."""
    return (valid.groupBy(key, "_week")
                 .agg(F.max_by(F.col(district), F.struct(ts, seq)).alias("_ref"),
                      F.min(F.struct(ts, seq)).alias("_first"),
                      F.count(F.lit(1)).alias("_n_week")))


def history_summary(history: DataFrame, keys: DataFrame, bound: Column | None, key: str = KEY,
                    district: str = DISTRICT, ts: str = TS, seq: str = SEQ) -> DataFrame:
    """J01 + J03/A04 in one aggregation over the history rows of the batch's
    ids: the last district strictly before ``bound`` (null dates excluded),
    whether any such row exists ("seen"), and the row count over all dates."""
    h = history.join(keys, key, "left_semi")
    in_state = F.col(ts).isNotNull() if bound is None else (F.col(ts).isNotNull() & (F.col(ts) < bound))
    return h.groupBy(key).agg(
        F.max_by(F.col(district), F.when(in_state, F.struct(ts, seq))).alias("_ref"),
        F.count_if(in_state).alias("_n_state"),
        F.count(F.lit(1)).alias("n_hist"))


def label_weeks(weekly: DataFrame, summary: DataFrame, key: str = KEY) -> DataFrame:
    """W05 (+A04): label each (id, week) against the carried state in one
    window pass per id.  The summary row (one per id, "week 0") carries the
    state only if the id was seen before the bound; ``lag`` does not ignore
    nulls (a null district replaces the state); appearance counts are the
    history count plus the batch's rows."""
    hist = summary.select(key, F.lit(None).cast("date").alias("_week"), "_ref",
                          (F.col("_n_state") > 0).alias("_real"), F.col("n_hist").cast("long").alias("n_hist"),
                          F.lit(None).alias("_first"), F.lit(0).cast("long").alias("_n_week"))
    cur = weekly.select(key, "_week", "_ref", F.lit(True).alias("_real"), F.lit(0).cast("long").alias("n_hist"),
                        "_first", F.col("_n_week").cast("long"))
    by_key = Window.partitionBy(key)
    ordered = by_key.orderBy(F.col("_week").asc_nulls_first())
    seq = (hist.unionByName(cur)
               .withColumn("_prev", F.lag("_ref").over(ordered))
               .withColumn("_rank", F.sum(F.col("_real").cast("int")).over(
                   ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .withColumn("apariciones", F.sum("n_hist").over(by_key) + F.sum("_n_week").over(by_key)))
    label = (F.when(F.col("_rank") == 1, F.lit("Nuevos"))
              .when(F.col("_prev").isNull() | F.col("_ref").isNull(), F.lit("Recurrentes"))
              .when(F.col("_prev") == F.col("_ref"), F.lit("Recurrentes"))
              .otherwise(F.lit("Migratorios")))
    return seq.filter(F.col("_week").isNotNull()).select(key, "_week", label.alias("_label"), "_first",
                                                          "apariciones")


def classify_batch(batch: DataFrame, history: DataFrame, key: str = KEY, district: str = DISTRICT,
                   ts: str = TS, seq: str = SEQ, bound: str = "day",
                   with_appearances: bool = True) -> DataFrame:
    """W04-W07 (+A04): adds ``tipo_evolucion`` (and ``apariciones``) to the
    batch, deriving the carried state from the full history table in one
    aggregation over the batch ids' history rows.

    ``bound='day'`` keeps the source's truncation of the state bound to the
    calendar day of the batch minimum; ``'exact'`` uses the timestamp."""
    b = batch.withColumn("_valid", is_valid_id(F.col(key)))
    keys = b.filter("_valid").select(key).distinct()
    batch_min = batch.select(F.min(ts)).scalar()
    bound_col = day_bound(batch_min) if bound == "day" else batch_min
    summary = history_summary(history, keys, bound_col, key, district, ts, seq)
    return _label_batch(b, summary, with_appearances, key, district, ts, seq)


def classify_batch_with_state(batch: DataFrame, person_state: DataFrame, key: str = KEY,
                              district: str = DISTRICT, ts: str = TS, seq: str = SEQ) -> DataFrame:
    """Same labels from the compact person-state table (one row per id:
    last district, last (ts, seq), row count) instead of re-aggregating the
    whole history every run.  Equal to ``classify_batch`` whenever the batch
    ``starts_after`` the state; else the history has to be used."""
    b = batch.withColumn("_valid", is_valid_id(F.col(key)))
    keys = b.filter("_valid").select(key).distinct()
    summary = (person_state.join(keys, key, "left_semi")
                           .select(key, F.col("last_" + district).alias("_ref"),
                                   F.col("last_at").isNotNull().cast("int").alias("_n_state"),
                                   F.col("n_rows").alias("n_hist")))
    return _label_batch(b, summary, True, key, district, ts, seq)


def starts_after(batch: DataFrame, person_state: DataFrame, ts: str = TS) -> bool:
    """Whether the batch starts on a later calendar day than the state ends:
    the state then holds just what ``classify_batch`` takes from the history,
    whose bound is the day on which the batch starts."""
    begin = batch.agg(F.date_trunc("day", F.min(ts))).first()[0]
    end = person_state.agg(F.max(F.col("last_at")[ts])).first()[0]
    return begin is None or end is None or end < begin


def update_person_state(person_state: DataFrame | None, rows: DataFrame, key: str = KEY,
                        district: str = DISTRICT, ts: str = TS, seq: str = SEQ) -> DataFrame:
    """Merge a batch into the person-state table: latest district by
    (ts, seq), latest (ts, seq), row count.  Rows without a date count, but
    set no district.  One aggregation over the state plus the batch (map-side
    combined), never over the history."""
    at = F.when(F.col(ts).isNotNull(), F.struct(ts, seq))
    new = (rows.filter(F.col(key).isNotNull())
               .groupBy(key).agg(F.max_by(F.col(district), at).alias("last_" + district), F.max(at).alias("last_at"),
                                 F.count(F.lit(1)).alias("n_rows")))
    if person_state is None:
        return new
    return merge_person_state(person_state.select(key, "last_" + district, "last_at", "n_rows").unionByName(new), key, district)


def merge_person_state(parts: DataFrame, key: str = KEY, district: str = DISTRICT) -> DataFrame:
    """One row an id from a state and its deltas, in any order."""
    return parts.groupBy(key).agg(F.max_by(F.col("last_" + district), F.col("last_at")).alias("last_" + district),
                                  F.max("last_at").alias("last_at"),
                                  F.sum("n_rows").alias("n_rows"))


def _label_batch(b: DataFrame, summary: DataFrame, with_appearances: bool, key: str, district: str,
                 ts: str, seq: str) -> DataFrame:
    # labels of an earlier run give way to the new ones
    b = b.drop("tipo_evolucion", "apariciones").withColumn("_week", week_start(F.col(ts)))
    valid = b.filter("_valid")
    invalid = b.filter(~F.col("_valid"))
    labels = label_weeks(weekly_reference(valid, key, district, ts, seq), summary, key)
    out_valid = valid.join(labels, [key, "_week"], "left")
    is_first = F.struct(F.col(ts), F.col(seq)) == F.col("_first")
    out_valid = out_valid.withColumn(
        "tipo_evolucion",
        F.when((F.col("_label") == "Nuevos") & ~is_first, F.lit("Nuevo repetido")).otherwise(F.col("_label")))
    out_invalid = invalid.withColumn("tipo_evolucion", F.lit("No clasificable"))
    if with_appearances:
        out_valid = out_valid.withColumn("apariciones", F.col("apariciones").cast("bigint"))
        out_invalid = out_invalid.withColumn("apariciones", F.lit(0).cast("bigint"))
    else:
        out_valid = out_valid.drop("apariciones")
    drop = ["_week", "_valid", "_label", "_first"]
    return out_valid.drop(*drop).unionByName(out_invalid.drop(*drop))


def appearances_by_name(batch: DataFrame, history: DataFrame, key: str = KEY) -> DataFrame:
    """Appearance count by composite key: valid ids count by id;
    anonymous ids count by (upper/trim first name, last name)."""
    from casework.functions import rules

    def with_key(df: DataFrame) -> DataFrame:
        anon = F.col(key).isin(rules.ANONYMOUS_ID_LABELS)
        return df.withColumn(
            "_ckey",
            F.when(anon, F.concat(F.upper(F.trim("persona_nombre")), F.lit("|"),
                                    F.upper(F.trim("persona_apellido"))))
             .otherwise(F.col(key)))\
            .withColumn("_ckind", F.when(anon, F.lit("name")).otherwise(F.lit("dni")))

    b = with_key(batch)
    keys = b.select("_ckind", "_ckey").distinct()
    # only history rows of the batch's keys reach the aggregation shuffle (as J03)
    hist = with_key(history).select("_ckind", "_ckey").join(keys, ["_ckind", "_ckey"], "left_semi")
    counts = (hist.unionByName(b.select("_ckind", "_ckey"))
                  .groupBy("_ckind", "_ckey").agg(F.count(F.lit(1)).alias("apariciones")))
    return b.drop("apariciones").join(counts, ["_ckind", "_ckey"], "left").drop("_ckind", "_ckey")


def update_stored_appearances(stored: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """Stored rows whose person is in the batch get the appearance count
    over stored and new rows: by id, or for anonymous ids by upper/trimmed
    first and last name (a null name matches nothing); others stay.  Adds
    ``_updated``."""
    from casework.functions import rules

    def person(df: DataFrame) -> list[Column]:
        anon = F.col(key).isin(rules.ANONYMOUS_ID_LABELS)
        return [anon.cast("int").alias("_anon"),
                F.when(anon, F.upper(F.trim("persona_nombre"))).otherwise(F.col(key)).alias("_one"),
                F.when(anon, F.upper(F.trim("persona_apellido"))).otherwise(F.lit("")).alias("_two")]

    names = ["_anon", "_one", "_two"]
    new = batch.select(*person(batch)).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias("_n_new"))
    marked = stored.select("*", *person(stored))
    held = marked.join(new.select(*names), names, "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("_n_held"))
    total = new.join(held, names, "left").select(*names, (F.col("_n_new") + F.coalesce("_n_held", F.lit(0))).cast("long").alias("_n"))
    out = marked.join(total, names, "left").withColumn("_updated", F.col("_n").isNotNull())
    return out.withColumn("apariciones", F.coalesce("_n", "apariciones")).drop(*names, "_n")
