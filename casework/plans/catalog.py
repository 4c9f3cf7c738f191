"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read the driver's tables (through the ``interventions`` adapter
over ``events``, or ``orders`` / ``documents`` directly) and run over the
whole tables.  The history / batch split used by the incremental operators
is data-derived: the batch is the last two observed weeks (``batch_start`` =
latest Monday minus 7 days, a scalar subquery), the history everything
before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.functions.identity import is_valid_id, with_id_category
from casework.functions.scalars import (dashboard_contact_class, district_key, interview_class, manual_group,
                                        origin_group, outcome_bucket, report_level, to_wall_clock, week_start)
from casework.functions.text import clean_name, clean_outcome_text
from casework.operators import categorize as cat
from casework.operators import dedup, evolution, geo, history
from casework.plans import pipeline, reports
from casework.sources import schema
from casework.session import ensure_checkpoint_dir, table_path, table_version, write_table
from casework.sources.adapter import LANDING_DATE_TEXT, load_interventions, load_table

Query = Callable[[SparkSession, str], DataFrame]


# -- shared derivations ----------------------------------------------------------

def batch_start(i: DataFrame) -> Column:
    """Monday of the latest observed week minus 7 days (scalar subquery)."""
    return F.date_sub(i.select(F.max(week_start(F.col("fecha_inicio")))).scalar(), 7)


# Derived tables shared by several queries are materialised once per session
# as reliable checkpoints in the shared checkpoint folder (the role the
# written history table plays in production); later queries read them.
_MEMO: dict[tuple, DataFrame] = {}


def materialized(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
                 partition: str | None = None) -> DataFrame:
    # the version makes the copy go out of use when its source table changes
    key = (spark.sparkContext.applicationId, sf_dir, name, table_version(spark, table_path(sf_dir, "events")))
    if key not in _MEMO:
        import os
        import time
        t = time.time()
        _MEMO[key] = write_table(build(), name, partition)
        if os.environ.get("CASEWORK_TRACE"):
            import sys
            print(f"materialized {name} in {time.time() - t:.2f}s", file=sys.stderr, flush=True)
    return _MEMO[key]


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    i = load_interventions(spark, sf_dir)
    bs = batch_start(i)
    return i, i.filter(F.col("fecha_inicio") < bs), i.filter(F.col("fecha_inicio") >= bs)


def cleaned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned history and batch.  Cleaning is row-wise apart
    from the exact-duplicate step, and exact duplicates share their date, so
    cleaning everything once and splitting at the cutoff equals cleaning the
    two parts separately; the cleaned table is materialised once and both
    parts are pruned reads of it."""
    i = load_interventions(spark, sf_dir)
    bs = batch_start(i)
    allc = materialized(spark, sf_dir, "clean_all", lambda: pipeline.clean_batch(i))
    return allc.filter(F.col("fecha_inicio") < bs), allc.filter(F.col("fecha_inicio") >= bs)


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two weekly runs: first load of the history, then the batch against it;
    the union is the labelled history table the reports read."""
    def build() -> DataFrame:
        ch, cb = cleaned(spark, sf_dir)
        first_load = evolution.classify_batch(ch, ch.filter(F.lit(False)))
        both = first_load.unionByName(evolution.classify_batch(cb, ch))
        return both.withColumn(reports.PARTITION, week_start(F.col("fecha_inicio"))).hint("rebalance", reports.PARTITION)
    return materialized(spark, sf_dir, "labeled_history", build, reports.PARTITION)


def reexport(i: DataFrame) -> DataFrame:
    """The next export of the same incidents: two thirds of the pending ones
    are now closed with an outcome."""
    closing = (F.col("estado") == "PENDIENTE") & (F.col("_seq") % 3 != 0)
    return (i.withColumn("resultado", F.when(closing & (F.col("_seq") % 2 == 0), F.lit("19. Sin cubrir"))
                                       .when(closing, F.lit("Se retira del lugar")).otherwise(F.col("resultado")))
             .withColumn("estado", F.when(closing, F.lit("CERRADO")).otherwise(F.col("estado"))))


# -- queries -----------------------------------------------------------------------

def q_weekly_totals_by_zone(spark, sf_dir):
    i = geo.assign_zone(load_interventions(spark, sf_dir)).withColumn(
        reports.WEEK, week_start(F.col("fecha_inicio")))
    wmin = reports.first_of_last_weeks(i)
    counts = (i.filter(F.col(reports.WEEK) >= wmin)
               .withColumn("zone", reports.dashboard_zone(F.col("comuna_calculada")))
               .groupBy(reports.WEEK, "zone").agg(F.count(F.lit(1)).alias("n")))
    sp = reports.spine(reports.last_weeks(i), zone=["c2", "c13", "c14", "zona1a", "resto"])
    return reports.reindex_counts(counts, sp, [reports.WEEK, "zone"])


def q_last_n_weeks_spine(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders").select(week_start(F.col("o_orderdate")).alias(reports.WEEK))
    return reports.last_weeks(o)


def q_orders_weekly_reindex(spark, sf_dir):
    o = load_table(spark, sf_dir, "orders").withColumn(reports.WEEK, week_start(F.col("o_orderdate")))
    wmin = reports.first_of_last_weeks(o)
    counts = (o.filter(F.col(reports.WEEK) >= wmin)
               .groupBy(reports.WEEK, F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n")))
    sp = reports.spine(reports.last_weeks(o), status=["F", "O", "P"])
    return reports.reindex_counts(counts, sp, [reports.WEEK, "status"])


def q_watermark_filter(spark, sf_dir):
    i, h, _ = split(spark, sf_dir)
    wm = history.watermark(h).scalar()
    return history.after_watermark(i, wm).select("_seq", "id_suceso", "fecha_inicio")


def q_table_stats(spark, sf_dir):
    return history.table_stats(load_interventions(spark, sf_dir))


def q_catchup_delta(spark, sf_dir):
    i, h, _ = split(spark, sf_dir)
    return history.catchup_delta(i, h).select("_seq", "id_suceso", "fecha_inicio")


def _person_view(i: DataFrame) -> DataFrame:
    return i.select("_seq", "persona_nombre", "persona_apellido", "persona_dni", "estado", "tipo_carta")


def q_drop_exact_duplicates(spark, sf_dir):
    return dedup.drop_exact_duplicates(_person_view(load_interventions(spark, sf_dir)))


def q_keep_first_per_key(spark, sf_dir):
    i = load_interventions(spark, sf_dir).select("_seq", "id_suceso", "fecha_inicio", "resultado")
    return dedup.keep_first_per_key(i, ["id_suceso"], ["_seq"])


def q_keep_last_per_key(spark, sf_dir):
    i = load_interventions(spark, sf_dir).select("_seq", "id_suceso", "fecha_inicio", "resultado")
    return dedup.keep_last_per_key(i, ["id_suceso"], ["fecha_inicio", "_seq"])


def q_clean_person_names(spark, sf_dir):
    i = load_interventions(spark, sf_dir)
    return i.select("_seq", clean_name(F.col("persona_nombre")).alias("nombre"),
                    clean_name(F.col("persona_apellido")).alias("apellido"))


def q_clean_names_documents(spark, sf_dir):
    d = load_table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_name(F.col("text")).alias("clean"))


def q_clean_outcome_text(spark, sf_dir):
    i = load_interventions(spark, sf_dir)
    return i.select("_seq", clean_outcome_text(F.coalesce("cierre_supervisor", "resultado")).alias("texto_limpio"))


def q_clean_outcome_documents(spark, sf_dir):
    d = load_table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_outcome_text(F.col("text")).alias("texto_limpio"))


def q_dni_category(spark, sf_dir):
    i = with_id_category(load_interventions(spark, sf_dir), "persona_dni", "dni_categorizado", "dni_motivo")
    return i.select("_seq", "dni_categorizado", "dni_motivo")


def q_dni_category_intended(spark, sf_dir):
    i = with_id_category(load_interventions(spark, sf_dir), "persona_dni", "dni_categorizado", "dni_motivo",
                         mode="intended")
    return i.select("_seq", "dni_categorizado", "dni_motivo")


def q_dni_valid(spark, sf_dir):
    i = with_id_category(load_interventions(spark, sf_dir), "persona_dni", "dni_categorizado", "dni_motivo")
    return i.select("_seq", "dni_categorizado", is_valid_id(F.col("dni_categorizado")).alias("valid"))


def _distinct_texts(spark, sf_dir) -> DataFrame:
    i = load_interventions(spark, sf_dir)
    return i.select(clean_outcome_text(F.coalesce("cierre_supervisor", "resultado")).alias("texto_limpio")).distinct()


def q_category_rules(spark, sf_dir):
    t = _distinct_texts(spark, sf_dir)
    return cat.categorize(t, "texto_limpio", "categoria_final", fuzzy=False)


def q_category_fuzzy(spark, sf_dir):
    t = _distinct_texts(spark, sf_dir)
    return cat.categorize(t, "texto_limpio", "categoria_final", scorer_col="scorer")


def q_category_levels(spark, sf_dir):
    i = cat.outcome_columns(load_interventions(spark, sf_dir))
    i = with_id_category(i, "persona_dni", "_dni", "_dni_motivo")
    c = F.col("_dni")
    return i.select("_seq", "cierre_texto", "texto_limpio", "categoria_final", "nivel_contacto", "contacto",
                    "brinda_datos", outcome_bucket(F.col("categoria_final")).alias("bucket"),
                    interview_class(F.col("categoria_final"), c).alias("entrevista"))


def q_value_remap_audit(spark, sf_dir):
    i = cat.remap_raw_outcomes(load_interventions(spark, sf_dir))
    return cat.value_distribution(i, "resultado", top=30).select("value", "n")


def q_value_distribution(spark, sf_dir):
    i = with_id_category(load_interventions(spark, sf_dir), "persona_dni", "dni_categorizado", "motivo")
    return cat.value_distribution(i.select("motivo"), "motivo")


def q_geo_zone(spark, sf_dir):
    return geo.assign_zone(load_interventions(spark, sf_dir)).select("_seq", "comuna_calculada", "zone_id")


#: one ring per row; rect_a has a hole, rect_b two parts, rect_c lies under both
LAYER_RINGS = [
    ("rect_a", 1.0, 0, 0, [(0, 0), (6, 0), (6, 6), (0, 6)]), ("rect_a", 1.0, 0, 0, [(2, 1), (4, 1), (4, 4), (2, 4)]),
    ("rect_b", 2.0, 0, 1, [(7, 0), (9, 0), (9, 2), (7, 2)]), ("rect_b", 2.0, 0, 1, [(7, 3), (9, 3), (9, 5), (7, 5)]),
    ("rect_c", 12.0, 1, 0, [(3, 1), (10, 1), (10, 4), (3, 4)]),
]


def q_geo_zone_layer(spark, sf_dir):
    """A zone layer given as a ring table, with a hole and two parts."""
    import os
    import uuid
    schema_ = "zone_id string, comuna double, priority int, ord int, ring array<struct<x: double, y: double>>"
    rows = [(*r[:4], [(float(x), float(y)) for x, y in r[4]]) for r in LAYER_RINGS]
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"zone-layer-{uuid.uuid4().hex}")
    spark.createDataFrame(rows, schema_).write.parquet(path)
    zones = geo.read_zones(spark, path)
    return geo.assign_zone(load_interventions(spark, sf_dir), zones=zones).select("_seq", "comuna_calculada", "zone_id")


def q_geo_zone_kml(spark, sf_dir):
    """The same layer from KML files, one a zone, ahead of each other by
    priority; read through the XML source, indexed and joined like any layer."""
    import os
    import uuid
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"zone-kml-{uuid.uuid4().hex}")
    rings = None
    for priority, (name, comuna) in enumerate((("rect_a", 1.0), ("rect_b", 2.0), ("rect_c", 12.0))):
        found = [r[4] for r in LAYER_RINGS if r[0] == name]
        corners = [" ".join(f"{x},{y},0" for x, y in (*ring, ring[0])) for ring in found]
        boundary = "<LinearRing><coordinates>\n{}\n</coordinates></LinearRing>"
        if name == "rect_a":  # the second ring is a hole
            shape = (f"<Polygon><outerBoundaryIs>{boundary.format(corners[0])}</outerBoundaryIs>"
                     f"<innerBoundaryIs>{boundary.format(corners[1])}</innerBoundaryIs></Polygon>")
        else:
            shape = "<MultiGeometry>" + "".join(f"<Polygon><outerBoundaryIs>{boundary.format(c)}</outerBoundaryIs></Polygon>"
                                                for c in corners) + "</MultiGeometry>"
        text = (f'<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>{name}</name>'
                f"<Placemark><name>{name}</name>{shape}</Placemark></Document></kml>")
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/{name}")
        part = geo.read_kml(spark, f"{root}/{name}", comuna, priority)
        rings = part if rings is None else rings.unionByName(part)
    zones = geo.zone_index(rings)
    return geo.assign_zone(load_interventions(spark, sf_dir), zones=zones).select("_seq", "comuna_calculada", "zone_id")


def q_asof_last_state(spark, sf_dir):
    ch, cb = cleaned(spark, sf_dir)
    bound = history.day_bound(cb.select(F.min("fecha_inicio")).scalar())
    return history.last_state_asof(ch, bound)


def q_last_state_row_number(spark, sf_dir):
    ch, _ = cleaned(spark, sf_dir)
    return history.last_state_legacy(ch)


def q_evolution_labels(spark, sf_dir):
    return labeled(spark, sf_dir).select("_seq", "dni_categorizado", "comuna_calculada", "tipo_evolucion",
                                         "apariciones")


def q_evolution_labels_state(spark, sf_dir):
    """The flagship through the compact person-state path (state merged
    after the first run, second run labelled from it)."""
    ch, cb = cleaned(spark, sf_dir)
    first_load = evolution.classify_batch(ch, ch.filter(F.lit(False)))
    state = evolution.update_person_state(None, ch)
    second = evolution.classify_batch_with_state(cb, state)
    return first_load.unionByName(second).select("_seq", "dni_categorizado", "comuna_calculada",
                                                 "tipo_evolucion", "apariciones")


def q_appearance_summary(spark, sf_dir):
    ch, cb = cleaned(spark, sf_dir)
    b = evolution.classify_batch(cb, ch)
    return b.agg(F.max("apariciones").alias("max_apariciones"),
                 F.round(F.avg("apariciones"), 6).alias("mean_apariciones"),
                 F.count_if(F.col("apariciones") > 1).alias("n_repeat"))


def q_semi_join_counts(spark, sf_dir):
    ch, cb = cleaned(spark, sf_dir)
    keys = cb.filter(is_valid_id(F.col("dni_categorizado"))).select("dni_categorizado")
    return history.semi_join_counts(ch, keys)


def q_appearances_composite_key(spark, sf_dir):
    ch, cb = cleaned(spark, sf_dir)
    return evolution.appearances_by_name(cb, ch).select("_seq", "dni_categorizado", "apariciones")


def q_reconcile_pending(spark, sf_dir):
    i, _, _ = split(spark, sf_dir)
    ch, _ = cleaned(spark, sf_dir)
    out = history.reconcile_pending(ch, reexport(i))
    return out.select("_seq", "id_suceso", *history.RECONCILE_COLUMNS, "_updated")


def q_keyed_update(spark, sf_dir):
    """C07 + J06: recompute derived outcome columns (no placeholder step) on
    the slice from the second week on, update by incident id, last wins."""
    i, _, _ = split(spark, sf_dir)
    ch, _ = cleaned(spark, sf_dir)
    cutoff = F.date_add(i.select(F.min(week_start(F.col("fecha_inicio")))).scalar(), 7)
    src = cat.outcome_columns(reexport(i).filter(F.col("fecha_inicio") >= cutoff),
                              apply_placeholders=False)
    cols = ["cierre_texto", "texto_limpio", "categoria_final", "nivel_contacto", "contacto", "brinda_datos"]
    out = history.keyed_update(ch, src, "id_suceso", cols, ["_seq"])
    return out.select("_seq", "id_suceso", *cols, "_updated")


def q_patch_from_lookup(spark, sf_dir):
    i, _, _ = split(spark, sf_dir)
    ch, _ = cleaned(spark, sf_dir)
    lookup = cat.outcome_columns(reexport(i).filter(F.col("estado") == "CERRADO"))
    out = history.patch_from_lookup(ch, lookup, "id_suceso", ["categoria_final", "nivel_contacto"], ["_seq"],
                                    keep_unmatched=False)
    return out.select("_seq", "id_suceso", "categoria_final", "nivel_contacto", "_updated")


def q_contact_class(spark, sf_dir):
    lab = labeled(spark, sf_dir)
    return lab.select("_seq",
                      report_level(F.col("nivel_contacto"), F.col("categoria_final"), F.col("estado"),
                                   F.col("comuna_calculada"), F.col("cierre_texto")).alias("nivel_norm"),
                      dashboard_contact_class(F.col("nivel_contacto"), F.col("categoria_final"), F.col("estado"),
                                              F.col("comuna_calculada"), F.col("cierre_texto"),
                                              F.col("resultado")).alias("clase_contacto"))


def q_report_prepare(spark, sf_dir):
    p = reports.prepare_weekly(labeled(spark, sf_dir))
    return p.select("_seq", reports.WEEK, "grupo_origen", "grupo_manual", "nivel_norm", "tipo_carta_norm",
                    "comuna_key")


def q_dashboard_prepare(spark, sf_dir):
    p = reports.prepare_dashboard(labeled(spark, sf_dir))
    return p.select("_seq", reports.WEEK, "categoria_final", "comuna_calculada")


def q_origin_groups(spark, sf_dir):
    lab = labeled(spark, sf_dir)
    return lab.select("_seq", origin_group(F.col("origen")).alias("grupo_origen"),
                      manual_group(F.col("origen")).alias("grupo_manual"),
                      district_key(F.col("comuna_calculada")).alias("comuna_key"),
                      reports.report_zone(district_key(F.col("comuna_calculada"))).alias("zone"))


def q_kpi_table(spark, sf_dir):
    return reports.kpi_table(reports.prepare_dashboard(labeled(spark, sf_dir)))


def q_hierarchy_counts(spark, sf_dir):
    return reports.hierarchy_with_pct(reports.prepare_weekly(labeled(spark, sf_dir)))


def q_contact_breakdown(spark, sf_dir):
    return reports.contact_breakdown(reports.prepare_weekly(labeled(spark, sf_dir)))


def q_contact_breakdown_dashboard(spark, sf_dir):
    return reports.contact_breakdown_dashboard(reports.prepare_dashboard(labeled(spark, sf_dir)))


def q_outcome_breakdown(spark, sf_dir):
    return reports.outcome_breakdown(reports.prepare_dashboard(labeled(spark, sf_dir)))


def q_evolution_weekly(spark, sf_dir):
    base = reports.prepare_dashboard(labeled(spark, sf_dir))
    return reports.dni_evolution(base, reports.dashboard_zones(), rest_zone="resto")


def q_evolution_report(spark, sf_dir):
    base = reports.prepare_weekly(labeled(spark, sf_dir))
    return reports.dni_evolution(base, reports.report_zones(), rest_zone="resto")


def q_chart_payload(spark, sf_dir):
    base = reports.prepare_dashboard(labeled(spark, sf_dir))
    return reports.chart_payload(reports.dni_evolution(base, reports.dashboard_zones(), rest_zone="resto"))


def q_batch_quality(spark, sf_dir):
    ch, cb = cleaned(spark, sf_dir)
    d = F.col("comuna_calculada")
    return cb.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col("categoria_final") == "sin_match").alias("n_sin_match"),
                  F.count_if(d == 1.5).alias("n_subzone"),
                  F.count_if(d.between(1, 15)).alias("n_district"),
                  F.count_if(d.isNull()).alias("n_no_zone"))


_DRIFTED = {"id_suceso": "Id.Suceso", "persona_dni": "Documento", "persona_nombre": "Nombre",
            "persona_apellido": "Apellido", "latitud": "LATITUD", "resultado": "Resultado",
            "cierre_supervisor": "Cierre Supervisor", "fecha_inicio": "Fecha Inicio"}


def q_schema_align(spark, sf_dir):
    i = load_interventions(spark, sf_dir)
    drifted = i.withColumnsRenamed(_DRIFTED).withColumn("extra_col", F.lit("x")).drop("agencia")
    canon = schema.rename_headers(drifted, schema.BATCH_HEADER_RENAMES)
    canon = canon.withColumnsRenamed({"Persona DNI": "persona dni", "Persona Nombre": "Persona_Nombre",
                                      "Persona Apellido": "persona apellido"})
    aligned = schema.align_to_schema(canon, schema.HISTORY_SCHEMA)
    return aligned.select("_seq", "id_suceso", "fecha_inicio", "persona_dni", "persona_nombre", "latitud",
                          "agencia", "resultado", "cierre_supervisor")


def q_legacy_headers(spark, sf_dir):
    """S04 + S15: a legacy export with Title Case headers is brought back to
    the canonical snake_case names in one projection."""
    i = load_interventions(spark, sf_dir).drop("_seq").withColumn("_seq", F.col("id_suceso"))
    legacy = i.toDF(*[schema.title_case(c) if c != "_seq" else c for c in i.columns])
    canon = schema.canonical_headers(legacy)
    return canon.select("id_suceso", "fecha_inicio", "persona_dni", "tipo_carta", "cierre_supervisor")


def q_landing_dates(spark, sf_dir):
    """F07 on every event: ISO and numbered date texts, both ways round."""
    e = load_table(spark, sf_dir, "events").selectExpr("event_id", f"{LANDING_DATE_TEXT} AS fecha_texto")
    return e.select("event_id", "fecha_texto", to_wall_clock(F.col("fecha_texto")).alias("month_first"),
                    to_wall_clock(F.col("fecha_texto"), day_first=True).alias("day_first"))


def q_header_collisions(spark, sf_dir):
    """Two headers that become alike; the last column stays."""
    i = load_interventions(spark, sf_dir)
    landed = i.select("_seq", F.lit("first").alias("Id Suceso"), F.col("id_suceso").alias("Id.Suceso"),
                      F.col("persona_nombre").alias("Documento"), F.col("persona_dni").alias("Persona DNI"),
                      F.col("fecha_fin").cast("string").alias("Recurso Arribo"), F.col("origen").alias("SubTipo"))
    return schema.align_to_schema(schema.canonical_headers(landed), schema.LANDING_SCHEMA).select(
        "_seq", "id_suceso", "persona_dni", "subtipo", "recurso_arribo", "recurso_fecha_liberado")


def q_union_by_name(spark, sf_dir):
    ch, cb = cleaned(spark, sf_dir)
    prev = ch.select("_seq", "id_suceso", "fecha_inicio", "categoria_final")
    new = cb.select("_seq", "fecha_inicio", "categoria_final", "comuna_calculada")
    return prev.unionByName(new, allowMissingColumns=True)


def q_reconcile_summary(spark, sf_dir):
    """J04 count + A06: rows updated and distinct incidents closed."""
    i, _, _ = split(spark, sf_dir)
    ch, _ = cleaned(spark, sf_dir)
    out = history.reconcile_pending(ch, reexport(i)).filter("_updated")
    # every update id is a pending id, so the distinct updated ids are the closed incidents
    return out.agg(F.count(F.lit(1)).alias("n_rows_updated"), F.count_distinct("id_suceso").alias("n_incidents"))


def q_snapshot_merge(spark, sf_dir):
    """S09 + U01 + P15: an older snapshot without the categorised id column
    merged with the new cleaned batch; blank ids are recomputed."""
    ch, cb = cleaned(spark, sf_dir)
    prev = ch.drop("dni_categorizado", "dni_categorizado_motivo")
    return pipeline.snapshot_merge(prev, cb).select("_seq", "persona_dni", "dni_categorizado", "categoria_final")


def q_report_week_range(spark, sf_dir):
    """The weekly table restricted to [second, fourth] observed week."""
    p = reports.prepare_weekly(labeled(spark, sf_dir))
    weeks = p.select(reports.WEEK).distinct()
    w2 = weeks.orderBy(reports.WEEK).limit(2).agg(F.max(reports.WEEK)).scalar()
    w4 = weeks.orderBy(reports.WEEK).limit(4).agg(F.max(reports.WEEK)).scalar()
    return reports.hierarchy_counts(reports.week_range(p, w2, w4))


def q_late_arrivals(spark, sf_dir):
    """Export rows after the watermark plus rows at/before it that the
    history never received (anti join on the row key)."""
    i, _, _ = split(spark, sf_dir)
    ch, _ = cleaned(spark, sf_dir)
    wm = history.watermark(ch).scalar()
    return history.after_watermark(i, wm, known=ch, key=["_seq"]).select("_seq", "id_suceso", "fecha_inicio")


def q_evolution_stream(spark, sf_dir):
    """T04 as Structured Streaming: the landing drop labelled against the
    stream's person state (one micro-batch per drop)."""
    from casework.streaming.evolution import evolution_stream
    return evolution_stream(spark, sf_dir).select("_seq", "dni_categorizado", "comuna_calculada",
                                                  "tipo_evolucion", "apariciones")


_STORES: dict[tuple, tuple] = {}


def _two_weekly_runs(spark, sf_dir):
    """A store after two weekly runs (the history, then the next export of all
    incidents), and what the runs returned; made once a session, like the
    other shared derivations."""
    import os
    import uuid
    from casework.plans import jobs
    from casework.sources.store import Store
    key = (spark.sparkContext.applicationId, sf_dir, table_version(spark, table_path(sf_dir, "events")))
    if key not in _STORES:
        i, h, _ = split(spark, sf_dir)
        root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"store-{uuid.uuid4().hex}")
        store = Store(spark, root)
        _STORES[key] = root, jobs.weekly(h, store), jobs.weekly(reexport(i), store)
    root, first, second = _STORES[key]
    return Store(spark, root), first, second


def q_store_versions(spark, sf_dir):
    """S07, J04, S08, T04 in one commit: the history as of both versions, and the mirrored snapshot."""
    store, first, second = _two_weekly_runs(spark, sf_dir)
    columns = ["_seq", "estado", "categoria_final", "tipo_evolucion", "apariciones"]
    return (store.read("history", first["version"]).select(F.lit("first").alias("version"), *columns)
            .unionByName(store.read("history", second["version"]).select(F.lit("second").alias("version"), *columns))
            .unionByName(store.read("snapshot").select(F.lit("snapshot").alias("version"), *columns)))


def q_weekly_counters(spark, sf_dir):
    """Counters of the second weekly run, observed within its writes."""
    _, _, second = _two_weekly_runs(spark, sf_dir)
    names = ["n_reconciled", "n_rows", "n_valid_id", "n_no_match", "n_without_zone", "n_repeat", "max_apariciones"]
    return spark.createDataFrame([tuple(second[n] for n in names)], ", ".join(f"{n} long" for n in names))


def q_hierarchy_maintained(spark, sf_dir):
    """A11, A12, R06 from the counts that two weekly runs kept by week, with
    the rows that the second run reconciled counted anew."""
    from casework.plans import jobs
    store, _, _ = _two_weekly_runs(spark, sf_dir)
    return jobs.hierarchy(store)


def q_appearances_stored(spark, sf_dir):
    """The stored history's counts after the batch."""
    ch, cb = cleaned(spark, sf_dir)
    stored = evolution.classify_batch(ch, ch.filter(F.lit(False)))
    return evolution.update_stored_appearances(stored, cb).select("_seq", "dni_categorizado", "apariciones", "_updated")


def q_clean_outcome_scripts(spark, sf_dir):
    """outcome texts spelled with Greek and Cyrillic letters."""
    i = load_interventions(spark, sf_dir)
    text = F.lower(F.coalesce("cierre_supervisor", "resultado"))
    greek = F.upper(F.translate(text, "abgdezhiklmnopqrstuvwxyáé", "αβγδεζθικλμνοπξρστυφψχωάέ"))
    cyrillic = F.upper(F.translate(text, "abvgdejziyklmnoprstufhcqwxñ", "абвгдежзийклмнопрстуфхцчшщю"))
    return i.select("_seq", clean_outcome_text(greek).alias("griego"), clean_outcome_text(cyrillic).alias("cirilico"))


def q_landing_quoted(spark, sf_dir):
    """Exports whose fields hold separators, quotes and line breaks, written and read again."""
    import os
    import uuid
    from casework.session import ensure_checkpoint_dir
    events = load_table(spark, sf_dir, "events")
    note = F.concat("event_type", F.lit("\n"), F.coalesce("props", F.lit("")), F.lit(', "'), F.col("user_id").cast("string"), F.lit('"'))
    record = F.concat_ws(",", F.col("event_id").cast("string"), F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"')),
                         "event_type")

    def with_banner(batches):
        import pyarrow as pa
        yield pa.record_batch([pa.array(["Exported events, by part", "id,nota,tipo"])], names=["value"])
        for batch in batches:
            yield pa.record_batch([batch.column(0).cast(pa.string())], names=["value"])

    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"landing-{uuid.uuid4().hex}")
    lines = events.filter("event_id IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL").select(record.alias("value"))
    lines.mapInArrow(with_banner, "value string").write.text(path)
    return schema.read_landing_csv(spark, path).select(F.col("id").cast("long").alias("id"), "nota", "tipo")


def q_landing_rejects(spark, sf_dir):
    """What becomes of every landed row whose texts don't all parse."""
    i = load_interventions(spark, sf_dir)
    text = F.date_format("fecha_inicio", "yyyy-MM-dd HH:mm:ss")
    n = F.col("_seq") % 50
    landed = i.select(
        "_seq", "id_suceso", "persona_dni",
        F.when(n == 0, F.lit("sin fecha")).when(n == 1, F.lit(None)).when(n == 2, F.lit("  ")).otherwise(text).alias("fecha_inicio"),
        F.when(n == 3, F.lit("32/13/2024")).when(n == 4, F.lit("")).otherwise(text).alias("fecha_fin"),
        F.when(n == 5, F.lit('"half,a record')).alias("_corrupt_record"))
    accepted, rejected, notes = schema.split_landing(landed, schema.HISTORY_SCHEMA)
    return (accepted.select("_seq", F.lit("accepted").alias("status"), F.lit(None).cast("string").alias("reason"))
            .unionByName(rejected.select("_seq", F.lit("rejected").alias("status"), F.array_join("reasons", ",").alias("reason")))
            .unionByName(notes.select("_seq", F.lit("noted").alias("status"), "reason")))


def q_value_remap_diff(spark, sf_dir):
    """Value counts before and after the C08 renames, side by side."""
    i = load_interventions(spark, sf_dir)
    return cat.distribution_diff(i, cat.remap_raw_outcomes(i), "resultado")


def q_weekly_stream_counts(spark, sf_dir):
    from casework.streaming.incremental import weekly_counts_stream
    return weekly_counts_stream(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "weekly_totals_by_zone": q_weekly_totals_by_zone,
    "last_n_weeks_spine": q_last_n_weeks_spine,
    "orders_weekly_reindex": q_orders_weekly_reindex,
    "watermark_filter": q_watermark_filter,
    "table_stats": q_table_stats,
    "catchup_delta": q_catchup_delta,
    "drop_exact_duplicates": q_drop_exact_duplicates,
    "keep_first_per_key": q_keep_first_per_key,
    "keep_last_per_key": q_keep_last_per_key,
    "clean_person_names": q_clean_person_names,
    "clean_names_documents": q_clean_names_documents,
    "clean_outcome_text": q_clean_outcome_text,
    "clean_outcome_documents": q_clean_outcome_documents,
    "dni_category": q_dni_category,
    "dni_category_intended": q_dni_category_intended,
    "dni_valid": q_dni_valid,
    "category_rules": q_category_rules,
    "category_fuzzy": q_category_fuzzy,
    "category_levels": q_category_levels,
    "value_remap_audit": q_value_remap_audit,
    "value_remap_diff": q_value_remap_diff,
    "store_versions": q_store_versions,
    "weekly_counters": q_weekly_counters,
    "hierarchy_maintained": q_hierarchy_maintained,
    "appearances_stored": q_appearances_stored,
    "landing_rejects": q_landing_rejects,
    "landing_quoted": q_landing_quoted,
    "clean_outcome_scripts": q_clean_outcome_scripts,
    "value_distribution": q_value_distribution,
    "geo_zone": q_geo_zone,
    "geo_zone_layer": q_geo_zone_layer,
    "geo_zone_kml": q_geo_zone_kml,
    "asof_last_state": q_asof_last_state,
    "last_state_row_number": q_last_state_row_number,
    "evolution_labels": q_evolution_labels,
    "evolution_labels_state": q_evolution_labels_state,
    "appearance_summary": q_appearance_summary,
    "semi_join_counts": q_semi_join_counts,
    "appearances_composite_key": q_appearances_composite_key,
    "reconcile_pending": q_reconcile_pending,
    "keyed_update": q_keyed_update,
    "patch_from_lookup": q_patch_from_lookup,
    "contact_class": q_contact_class,
    "report_prepare": q_report_prepare,
    "dashboard_prepare": q_dashboard_prepare,
    "origin_groups": q_origin_groups,
    "kpi_table": q_kpi_table,
    "hierarchy_counts": q_hierarchy_counts,
    "contact_breakdown": q_contact_breakdown,
    "contact_breakdown_dashboard": q_contact_breakdown_dashboard,
    "outcome_breakdown": q_outcome_breakdown,
    "evolution_weekly": q_evolution_weekly,
    "evolution_report": q_evolution_report,
    "chart_payload": q_chart_payload,
    "batch_quality": q_batch_quality,
    "schema_align": q_schema_align,
    "union_by_name": q_union_by_name,
    "legacy_headers": q_legacy_headers,
    "landing_dates": q_landing_dates,
    "header_collisions": q_header_collisions,
    "weekly_stream_counts": q_weekly_stream_counts,
    "evolution_stream": q_evolution_stream,
    "reconcile_summary": q_reconcile_summary,
    "snapshot_merge": q_snapshot_merge,
    "report_week_range": q_report_week_range,
    "late_arrivals": q_late_arrivals,
}
