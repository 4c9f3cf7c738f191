"""Command line for the weekly job and the report datasets.

    python -m casework weekly  --landing PATH [--format csv|parquet] --history PATH [--zones PATH [--kml PATH=DISTRICT]]
        [--state PATH] [--day-first] [--no-fuzzy]
    python -m casework weekly  --landing PATH --store ROOT [as above]
    python -m casework reports (--history PATH | --store ROOT) --out DIR [--dedup-incident]
    python -m casework sync    --store ROOT --history PATH [--table snapshot]
    python -m casework migrate --store ROOT [--lookup PATH] [--no-fuzzy]

``weekly`` is the incremental run (T01): landing export -> header alignment
-> watermark -> reconcile late closures -> clean -> evolution labels and
appearances -> append to the week-partitioned Parquet history.  With
``--state`` it keeps one row a person there and labels from it, without
aggregating the history again.  ``reports``
writes the report datasets (R01-R08) as Parquet tables under DIR.
Submit with spark-submit on a cluster; the session's configuration (and its
``spark.checkpoint.dir``) is used as given.
"""

from __future__ import annotations

import argparse
import json
import os
import re

from pyspark.sql import functions as F


def _landing(spark, path: str, fmt: str, day_first: bool = False, rejects: str | None = None):
    from casework.session import write_table
    from casework.sources import schema
    raw = schema.read_landing_csv(spark, path, keep_malformed=rejects is not None) if fmt == "csv" else spark.read.parquet(path)
    canon = schema.canonical_headers(raw)
    if "_seq" not in canon.columns:
        # file order: ids increase with the row order inside each split
        # written once, as every later use would number the rows anew
        canon = write_table(canon.withColumn("_seq", F.monotonically_increasing_id()), "landing")
    if not rejects:
        return schema.align_to_schema(canon, schema.LANDING_SCHEMA, day_first)
    accepted, rejected, notes = schema.split_landing(canon, schema.LANDING_SCHEMA, day_first)
    rejected.write.mode("overwrite").parquet(os.path.join(rejects, "rows"))
    notes.write.mode("overwrite").parquet(os.path.join(rejects, "values"))
    return accepted


def _zones(spark, args):
    """The index of --zones, with the KML layers ahead of it."""
    from casework.operators import geo
    if not args.zones:
        return None
    rings = geo.read_rings(spark, args.zones)
    for spec in args.kml:  # PATH=DISTRICT
        path, _, district = spec.rpartition("=")
        rings = rings.unionByName(geo.read_kml(spark, path, float(district), -1))
    return geo.zone_index(rings)


def on_store(args) -> dict:
    """``weekly --store``, ``sync`` and ``migrate``."""
    from casework.plans import jobs
    from casework.session import get_session, ship_package
    from casework.sources.store import Store
    spark = get_session()
    ship_package(spark)
    store = Store(spark, args.store)
    if args.cmd == "weekly":
        done = jobs.weekly(_landing(spark, args.landing, args.format, args.day_first, getattr(args, "rejects", None)), store, fuzzy=args.fuzzy, zones=_zones(spark, args))
        jobs.compact_state(store)
        return done
    if args.cmd == "sync":
        return jobs.sync_snapshot(spark.read.parquet(args.history), store, args.table)
    done = jobs.migrate(store, lookup=spark.read.parquet(args.lookup) if args.lookup else None, fuzzy=args.fuzzy)
    return {**done, "diff": [r.asDict() for r in done["diff"].collect()]}  # the top 30 values


def _state_path(root: str, history) -> str:
    """Where the person state of just this history lies.  A run that ended
    between history and state leaves none, and the next one rebuilds it."""
    s = history.agg(F.count(F.lit(1)).alias("n"), F.max("fecha_inicio").cast("string").alias("until")).first()
    return f"{root}/rows-{s.n}-until-{re.sub('[^0-9]', '', s.until or '')}"


def weekly(args) -> dict:
    from casework.operators import evolution, history
    from casework.plans import pipeline
    from casework.session import get_session, path_exists, ship_package, write_table
    from casework.sources import schema
    spark = get_session()
    ship_package(spark)
    export = _landing(spark, args.landing, args.format, args.day_first, getattr(args, "rejects", None))
    zones = _zones(spark, args)
    exists = path_exists(spark, args.history)
    if not exists:  # first load: everything is new
        cleaned = write_table(pipeline.clean_batch(export, fuzzy=args.fuzzy, zones=zones), "first_load")
        labelled = evolution.classify_batch(cleaned, cleaned.filter(F.lit(False)))
        history.append_history(labelled, args.history)
        stored = spark.read.parquet(args.history)
        if args.state:
            evolution.update_person_state(None, stored).write.mode("overwrite").parquet(_state_path(args.state, stored))
        return {"mode": "first_load", "appended": stored.count()}
    hist = schema.read_history_with(spark, args.history, schema.LANDING_SCHEMA)
    wm = history.watermark(hist).scalar()
    state = None
    if args.state:
        kept = _state_path(args.state, hist)
        state = (spark.read.parquet(kept) if path_exists(spark, f"{kept}/_SUCCESS")
                 else write_table(evolution.update_person_state(None, hist), "person_state"))
    res = pipeline.run_weekly(export, hist, args.history, wm=wm, fuzzy=args.fuzzy, zones=zones, person_state=state)
    appended = res.batch.count()
    if args.state:
        res.person_state.write.mode("overwrite").parquet(_state_path(args.state, spark.read.parquet(args.history)))
    return {"mode": "incremental", "reconciled": res.n_reconciled, "appended": appended}


def reports(args) -> dict:
    from casework.plans import reports as R
    from casework.session import get_session
    from casework.sources import schema
    from casework.sources.store import Store
    spark = get_session()
    stored = Store(spark, args.store).read("snapshot") if getattr(args, "store", None) else spark.read.parquet(args.history)
    hist = schema.canonical_headers(schema.rename_headers(stored, schema.REPORT_HEADER_RENAMES))
    weekly_base, dash_base = R.prepare_weekly(hist, args.dedup_incident), R.prepare_dashboard(hist)
    outputs = {
        "kpi_table": R.kpi_table(dash_base),
        "dni_evolution_dashboard": R.dni_evolution(dash_base, R.dashboard_zones(), rest_zone="resto"),
        "outcome_breakdown": R.outcome_breakdown(dash_base),
        "hierarchy": R.hierarchy_with_pct(weekly_base),
        "contact_breakdown": R.contact_breakdown(weekly_base),
        "contact_breakdown_dashboard": R.contact_breakdown_dashboard(dash_base),
        "dni_evolution_report": R.dni_evolution(weekly_base, R.report_zones(), rest_zone="resto"),
    }
    outputs["chart_payload"] = R.chart_payload(outputs["dni_evolution_dashboard"])
    written = {}
    for name, df in outputs.items():
        path = os.path.join(args.out, name)
        df.write.mode("overwrite").parquet(path)
        written[name] = path
    return written


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="casework")
    sub = p.add_subparsers(dest="cmd", required=True)
    w = sub.add_parser("weekly")
    w.add_argument("--landing", required=True)
    w.add_argument("--format", choices=["csv", "parquet"], default="csv")
    to = w.add_mutually_exclusive_group(required=True)
    to.add_argument("--history", help="week-partitioned Parquet folder")
    to.add_argument("--store", help="store of history, snapshot and person state with one commit a run")
    w.add_argument("--zones", help="Parquet zone layer, one ring per row")
    w.add_argument("--kml", action="append", default=[], metavar="PATH=DISTRICT", help="KML layer of a sub-zone, ahead of --zones")
    w.add_argument("--state", help="folder of the person-state table")
    w.add_argument("--rejects", help="folder for rejected rows, and for values that did not parse")
    w.add_argument("--day-first", action="store_true", help="read 4/5/2026 as 4 May, not 5 April")
    w.add_argument("--no-fuzzy", dest="fuzzy", action="store_false")
    r = sub.add_parser("reports")
    of = r.add_mutually_exclusive_group(required=True)
    of.add_argument("--history")
    of.add_argument("--store")
    r.add_argument("--out", required=True)
    r.add_argument("--dedup-incident", action="store_true", help="first row of each incident only")
    y = sub.add_parser("sync")
    y.add_argument("--store", required=True)
    y.add_argument("--history", required=True, help="Parquet history to catch up with")
    y.add_argument("--table", default="snapshot")
    m = sub.add_parser("migrate")
    m.add_argument("--store", required=True)
    m.add_argument("--lookup", help="Parquet table that patches categories by incident id")
    m.add_argument("--no-fuzzy", dest="fuzzy", action="store_false")
    args = p.parse_args(argv)
    if args.cmd == "reports":
        result = reports(args)
    else:
        result = on_store(args) if args.store else weekly(args)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
