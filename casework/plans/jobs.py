"""Weekly run, snapshot sync and migration on a store with one commit.

``weekly`` (T01) reconciles, appends, adds to the person state, counts the
touched weeks anew and moves the snapshot on in one version.  The snapshot (S08, S12, J05) is the history as
committed, by reference; ``export_snapshot`` writes it out for other readers.
The person state (T04, J01) is a base and deltas a bucket of ids: a drop
writes the buckets of its ids only and reads those alone; ``compact_state``
folds buckets of many deltas.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from casework.functions import rules
from casework.functions.scalars import week_start
from casework.operators.categorize import distribution_diff, outcome_columns, remap_raw_outcomes
from casework.operators.evolution import (DISTRICT, KEY, TS, classify_batch, classify_batch_with_state, merge_person_state,
                                          update_person_state)
from casework.operators.geo import ZoneIndex
from casework.operators.history import (RECONCILE_COLUMNS, after_watermark, apply_keyed_update, catchup_delta, keyed_update,
                                        patch_from_lookup, reconcile_updates, watermark)
from casework.operators.joins import materialize_checked
from casework.plans import reports
from casework.plans.pipeline import clean_batch, snapshot_merge
from casework.session import write_table
from casework.sources.store import Staged, Store

BUCKETS = 64
MOST_DELTAS = 16


def _observed(seen: Observation, **of_nothing) -> dict:
    """What was observed; of a plan that Catalyst finds to be empty nothing is."""
    try:
        return dict(seen.get)
    except Py4JJavaError as e:
        if "assertion failed" not in str(e):
            raise
        return of_nothing


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _weekly_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("week", week_start(F.col(TS)))


def state_of(store: Store, rows: DataFrame | None = None, version: int | None = None) -> DataFrame | None:
    """The merged person state, or the part of it in the buckets of the ids of
    ``rows``; None if there is none."""
    if not store.has("state", version):
        return None
    parts = None
    if rows is not None:  # at most BUCKETS numbers
        parts = [str(r[0]) for r in rows.filter(F.col(KEY).isNotNull()).select(bucket(F.col(KEY))).distinct().collect()]
    return merge_person_state(store.read("state", version, parts).drop("bucket"))


def batch_counts() -> dict[str, Column]:
    """Counters of a batch, observed while it is written."""
    from casework.functions.identity import is_valid_id
    return {"n_rows": F.count(F.lit(1)), "n_valid_id": F.count_if(is_valid_id(F.col(KEY))),
            "n_no_match": F.count_if(F.col("categoria_final") == rules.NO_MATCH), "n_without_zone": F.count_if(F.col(DISTRICT).isNull()),
            "n_repeat": F.count_if(F.col("apariciones") > 1), "max_apariciones": F.max("apariciones")}


def weekly_drop(rows: DataFrame, store: Store, *, changes: list[Staged] | None = None, fuzzy: bool = True,
                zones: ZoneIndex | None = None, meta: dict | None = None, base: int | None = None) -> dict:
    """Clean and label new rows, and commit them, their part of the person
    state, the snapshot and further ``changes`` to version ``base`` (the
    latest).  Returns the version and the batch's counters, taken while it was
    written."""
    base = store.version() if base is None else base
    known = store.manifest(base)["meta"].get("until")
    cleaned = write_table(clean_batch(rows, fuzzy=fuzzy, zones=zones), "cleaned")
    begin = cleaned.agg(F.date_trunc("day", F.min(TS)).cast("string")).first()[0]
    if not store.has("history", base):
        classified = classify_batch(cleaned, cleaned.filter(F.lit(False)))
    elif begin is None or known is None or known < begin:
        classified = classify_batch_with_state(cleaned, state_of(store, cleaned, base))
    else:  # it starts on a day which the state already holds
        classified = classify_batch(cleaned, store.read("history", base).drop("week"))
    seen = Observation(f"batch-{uuid.uuid4().hex}")
    observed = _weekly_rows(classified).observe(seen, *[c.alias(k) for k, c in batch_counts().items()],
                                                F.max(TS).cast("string").alias("until"))
    staged = [*(changes or []), store.stage("history", observed, "week", sort=TS),
              store.stage("state", update_person_state(None, cleaned).withColumn("bucket", bucket(F.col(KEY))), "bucket")]
    staged.append(weekly_counts(store, base, staged))
    counts = _observed(seen, **{k: 0 for k in batch_counts()} | {"max_apariciones": None, "until": None})
    ends = [u for u in (known, counts.pop("until")) if u]
    version = store.commit(base, staged, mirror={"snapshot": "history"}, meta={**(meta or {}), "until": max(ends, default=None)})
    return {"version": version, **counts}


def weekly_counts(store: Store, base: int, staged: list[Staged]) -> Staged:
    """The report's counts by week, anew for the weeks that the staged
    changes touch, from the rows that these weeks will have (so rows that a
    reconciliation changed are counted as they now are, and no longer as they
    were)."""
    weeks = sorted({p.split("=", 1)[1] for s in staged if s.table == "history" for p in s.parts})
    rows = store.read("history", store.planned(base, staged), weeks)
    fine = reports.fine_counts(reports.prepare_weekly(rows)).withColumn("week", F.col(reports.WEEK))
    return store.stage("counts", fine, "week", replace=True, cleared=weeks)


def hierarchy(store: Store, version: int | None = None) -> DataFrame:
    """R06 from the kept counts: no row of the history is read."""
    return reports.roll_up(store.read("counts", version).drop("week"))


def weekly(export: DataFrame, store: Store, *, wm: Column | None = None, fuzzy: bool = True,
           zones: ZoneIndex | None = None) -> dict:
    """T01 in one commit: J04 closes pending rows in the weeks that hold them,
    then the rows beyond the watermark are added (``weekly_drop``)."""
    base = store.version()
    if not store.has("history", base):
        return {"n_reconciled": 0, **weekly_drop(export, store, fuzzy=fuzzy, zones=zones, base=base)}
    history = store.read("history", base)
    updates, small = materialize_checked(reconcile_updates(export, history.drop("week"), fuzzy=fuzzy))
    ids = updates.select("id_suceso")
    touched = write_table(history.filter(F.col("estado") == "PENDIENTE")
                          .join(F.broadcast(ids) if small else ids, "id_suceso", "left_semi")
                          .select(F.col("week").alias("_touched")).distinct(), "touched_weeks")
    changes, n = [], 0
    if not touched.isEmpty():
        part = history.join(touched, F.col("week").eqNullSafe(F.col("_touched")), "left_semi")
        rebuilt = apply_keyed_update(part, updates, "id_suceso", RECONCILE_COLUMNS, predicate=F.col("estado") == "PENDIENTE")
        seen = Observation(f"reconciled-{uuid.uuid4().hex}")
        rebuilt = rebuilt.observe(seen, F.count_if("_updated").alias("n")).drop("_updated")
        changes = [store.stage("history", rebuilt, "week", replace=True, sort=TS)]
        n = _observed(seen, n=0)["n"]
    rows = after_watermark(export, watermark(history).scalar() if wm is None else wm)
    return {"n_reconciled": n, **weekly_drop(rows, store, changes=changes, fuzzy=fuzzy, zones=zones, base=base)}


def compact_state(store: Store, most: int = MOST_DELTAS) -> int | None:
    """Fold the buckets of more than ``most`` folders into one each; the new
    version, or None if there was nothing to fold."""
    base = store.version()
    parts = store.manifest(base)["tables"].get("state", {"parts": {}})["parts"]
    many = [p.split("=", 1)[1] for p, commits in parts.items() if len(commits) > most]
    if not many:
        return None
    merged = merge_person_state(store.read("state", base, many).drop("bucket")).withColumn("bucket", bucket(F.col(KEY)))
    return store.commit(base, [store.stage("state", merged, "bucket", replace=True)])


def export_snapshot(store: Store, path: str, version: int | None = None) -> str:
    """The snapshot as one Parquet folder of its own, named by its
    version; a copy that was not finished has no _SUCCESS file."""
    version = version or store.version()
    out = f"{path.rstrip('/')}/v={version:012d}"
    store.read("snapshot", version).drop("week").write.mode("overwrite").option("compression", "snappy").parquet(out)
    return out


def sync_snapshot(history: DataFrame, store: Store, table: str = "snapshot") -> dict:
    """J09 + S09: append what a history kept elsewhere holds beyond the
    snapshot's latest date, in the snapshot's types."""
    base = store.version()
    if not store.has(table, base):
        delta = history
    else:
        held = store.read(table, base).drop("week")
        fresh = catchup_delta(history, held)
        # merged over the snapshot's columns; the rows kept are the new ones
        delta = snapshot_merge(held.filter(F.lit(False)), fresh)
    seen = Observation(f"sync-{uuid.uuid4().hex}")
    rows = _weekly_rows(delta).observe(seen, F.count(F.lit(1)).alias("n"))
    staged = store.stage(table, rows, "week", sort=TS)
    return {"version": store.commit(base, [staged]), "appended": _observed(seen, n=0)["n"]}


MIGRATED = ["cierre_texto", "texto_limpio", "categoria_final", "nivel_contacto", "contacto", "brinda_datos"]


def migrate(store: Store, *, lookup: DataFrame | None = None, fuzzy: bool = True) -> dict:
    """One-time migration in one commit: C08 renames of raw outcomes, C07 + J06
    derived columns anew by incident id, J07 a patch from a lookup, and C09
    the value counts before and after.  Only weeks with a changed row are
    written."""
    base = store.version()
    before = store.read("history", base)
    columns = before.columns
    renamed = remap_raw_outcomes(before)
    source = outcome_columns(renamed.drop(*MIGRATED), fuzzy=fuzzy, apply_placeholders=False)
    after = keyed_update(renamed, source, "id_suceso", MIGRATED, ["_seq"]).drop("_updated")
    if lookup is not None:
        after = patch_from_lookup(after, lookup, "id_suceso", ["categoria_final", "nivel_contacto"], ["_seq"]).drop("_updated")
    after = write_table(after.select(*columns), "migrated")
    # rows keep their number and incident; a week in which the two tables differ in any value is written
    mark = F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("mark")
    old, new = before.groupBy("week").agg(mark), after.groupBy(F.col("week").alias("w")).agg(mark.alias("mark_after"))
    changed = write_table(old.join(new, F.col("week").eqNullSafe(F.col("w")))
                          .filter(F.col("mark") != F.col("mark_after")).select(F.col("week").alias("_changed")), "changed-weeks")
    diff = distribution_diff(before, after, "resultado")
    n = changed.count()
    if not n:
        return {"version": base, "weeks": 0, "diff": diff}
    rows = after.join(changed, F.col("week").eqNullSafe(F.col("_changed")), "left_semi")
    staged = [store.stage("history", rows, "week", replace=True, sort=TS)]
    staged.append(weekly_counts(store, base, staged))
    return {"version": store.commit(base, staged, mirror={"snapshot": "history"}), "weeks": n, "diff": diff}
