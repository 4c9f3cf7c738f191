"""Geo, evolution, appearances, reconcile and dedup operators on hand-made
rows (FIXTURES sections 4, 7, 9)."""

import datetime as dt

from pyspark.sql import functions as F

from casework.operators import dedup, evolution, geo, history

T0 = dt.datetime(2024, 1, 1, 10, 0)


def test_zone_fixture_points(spark):
    rows = [(1, "1", "1"), (2, "1", "2"), (3, "1", "5"), (4, "2", "6"), (5, "0", "0"), (6, "20", "20"),
            (7, "1", None), (8, "1,0", "1,0"), (9, "5", "6"), (10, "4.5", "7.5"), (11, "5", "8.5")]
    df = spark.createDataFrame(rows, "id int, latitud string, longitud string")
    got = {r.id: r.comuna_calculada for r in geo.assign_zone(df).collect()}
    assert got == {1: 1.5, 2: 1.0, 3: 1.0, 4: None, 5: None, 6: None, 7: None, 8: 1.5, 9: 14.0,
                   10: None, 11: None}  # 10: on the concave dent's edge; 11: inside the dent


def test_zone_cells_are_a_bounded_index():
    cells = geo.zone_cells(geo.SYNTHETIC_ZONES, 1.0)
    assert len(cells) < 200
    for _, _, zones in cells:
        keys = [(z[2], z[3]) for z in zones]
        assert keys == sorted(keys)


def _ts(h):
    return T0 + dt.timedelta(hours=h)


def test_evolution_fixture(spark):
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"
    w1, w2 = 0, 24 * 7
    hist = spark.createDataFrame([
        ("30000001", 2.0, _ts(-100), 1), ("30000001", 2.0, _ts(-90), 2), ("30000001", 2.0, _ts(-80), 3),
        ("30000002", None, _ts(-100), 4), ("30000003", 14.0, _ts(-100), 5), ("30000003", 14.0, _ts(-99), 6)], schema)
    batch = spark.createDataFrame([
        ("30000001", 2.0, _ts(w1 + 1), 10), ("30000002", 5.0, _ts(w1 + 1), 11), ("30000003", 13.0, _ts(w1 + 1), 12),
        ("30000004", 3.0, _ts(w1 + 1), 13), ("30000004", 4.0, _ts(w1 + 2), 14), ("30000004", 3.0, _ts(w2 + 3), 15),
        ("30000003", None, _ts(w2 + 3), 16), ("NO BRINDO/NO VISIBLE", 2.0, _ts(w1 + 1), 17)], schema)
    out = {r._seq: (r.tipo_evolucion, r.apariciones) for r in evolution.classify_batch(batch, hist).collect()}
    assert out == {10: ("Recurrentes", 4), 11: ("Recurrentes", 2), 12: ("Migratorios", 4), 13: ("Nuevos", 3),
                   14: ("Nuevo repetido", 3), 15: ("Migratorios", 3), 16: ("Recurrentes", 4),
                   17: ("No clasificable", 0)}


def test_split_batches_equal_single_batch_at_week_cut(spark):
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"
    rows = [("3000000%d" % (i % 5), float(i % 3), _ts(i * 20), i) for i in range(60)]
    all_rows = spark.createDataFrame(rows, schema)
    empty = all_rows.filter(F.lit(False))
    single = {r._seq: r.tipo_evolucion for r in evolution.classify_batch(all_rows, empty).collect()}
    cut = dt.datetime(2024, 1, 8)  # a Monday: batches cut at a week boundary
    first = all_rows.filter(F.col("fecha_inicio") < cut)
    second = all_rows.filter(F.col("fecha_inicio") >= cut)
    split = {r._seq: r.tipo_evolucion for r in evolution.classify_batch(first, empty).collect()}
    split.update({r._seq: r.tipo_evolucion for r in evolution.classify_batch(second, first).collect()})
    assert split == single
    # invariant: at most one "Nuevos" per id overall
    news = [s for s, lab in single.items() if lab == "Nuevos"]
    assert len(news) == 5


def test_reconcile_fixture(spark):
    schema = ("id_suceso string, _seq long, estado string, fecha_fin timestamp_ntz, cierre_texto string, "
              "texto_limpio string, categoria_final string, nivel_contacto string, contacto string, brinda_datos string")
    hist = spark.createDataFrame([
        ("S1", 1, "PENDIENTE", _ts(5), None, "", "sin_match", "Sin dato", "x", ""),
        ("S1", 2, "PENDIENTE", _ts(5), None, "", "sin_match", "Sin dato", "x", ""),
        ("S2", 3, "PENDIENTE", None, None, "", "sin_match", "Sin dato", "x", ""),
        ("S3", 4, "CERRADO", None, None, "", "sin_match", "Sin dato", "x", "")], schema)
    export = spark.createDataFrame([
        ("S1", 10, "CERRADO", "19. Sin cubrir", None, None), ("S1", 11, "CERRADO", "20. Desestimado", None, None),
        ("S2", 12, "PENDIENTE", None, None, None), ("S3", 13, "CERRADO", "18. Mendicidad", None, None),
        ("S9", 14, "CERRADO", "18. Mendicidad", None, None)],
        "id_suceso string, _seq long, estado string, resultado string, cierre_supervisor string, fecha_fin string")
    out = history.reconcile_pending(hist, export, fuzzy=False)
    got = {r._seq: (r.estado, r.categoria_final, r.fecha_fin, r._updated) for r in out.collect()}
    assert got == {1: ("CERRADO", "19. Sin cubrir", None, True), 2: ("CERRADO", "19. Sin cubrir", None, True),
                   3: ("PENDIENTE", "sin_match", None, False), 4: ("CERRADO", "sin_match", None, False)}
    again = history.reconcile_pending(out.drop("_updated"), export, fuzzy=False)
    assert again.filter("_updated").count() == 0


def test_keep_first_last_and_exact_dedup(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("b", 2, "z")],
                               "k string, _seq int, v string")
    assert {(r.k, r.v) for r in dedup.keep_first_per_key(df, ["k"], ["_seq"]).collect()} == {("a", "y"), ("b", "z")}
    assert {(r.k, r.v) for r in dedup.keep_last_per_key(df, ["k"], ["_seq"]).collect()} == {("a", "x"), ("b", "z")}
    assert dedup.drop_exact_duplicates(df).count() == 3


def test_asof_state_day_bound(spark):
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"
    h = spark.createDataFrame([("1", 1.0, dt.datetime(2024, 1, 1, 8), 1), ("1", 2.0, dt.datetime(2024, 1, 2, 8), 2),
                               ("1", 3.0, None, 3)], schema)
    bound = history.day_bound(F.lit(dt.datetime(2024, 1, 2, 20)).cast("timestamp_ntz"))
    assert history.last_state_asof(h, bound).first().last_comuna_calculada == 1.0
    assert history.last_state_legacy(h).first().last_comuna_calculada == 3.0  # null date sorts first under DESC


def test_person_state_path_equals_history_path(spark):
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"
    rows = [("3000000%d" % (i % 7), None if i % 11 == 0 else float(i % 4), _ts(i * 13), i) for i in range(120)]
    df = spark.createDataFrame(rows, schema)
    cut1, cut2 = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15)
    b1 = df.filter(F.col("fecha_inicio") < cut1)
    b2 = df.filter((F.col("fecha_inicio") >= cut1) & (F.col("fecha_inicio") < cut2))
    b3 = df.filter(F.col("fecha_inicio") >= cut2)
    empty = df.filter(F.lit(False))
    # path 1: full history each run
    h1 = evolution.classify_batch(b1, empty)
    h2 = evolution.classify_batch(b2, b1)
    h3 = evolution.classify_batch(b3, b1.unionByName(b2))
    want = {r._seq: (r.tipo_evolucion, r.apariciones) for d in (h1, h2, h3) for r in d.collect()}
    # path 2: compact person state merged after each run
    s1 = evolution.update_person_state(None, b1)
    g2 = evolution.classify_batch_with_state(b2, s1)
    s2 = evolution.update_person_state(s1, b2)
    g3 = evolution.classify_batch_with_state(b3, s2)
    got = {r._seq: (r.tipo_evolucion, r.apariciones) for d in (h1, g2, g3) for r in d.collect()}
    assert got == want
    assert evolution.update_person_state(s2, b3).count() == 7


def test_keyed_update_shuffle_fallback_equals_broadcast_path(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), (None, 4, "w")],
                                   "k string, _seq int, v string")
    updates = spark.createDataFrame([("a", "A"), ("c", "C")], "k string, v string")
    small = sorted(map(tuple, history.apply_keyed_update(target, updates, "k", ["v"]).collect()), key=str)
    large = sorted(map(tuple, history.apply_keyed_update(target, updates, "k", ["v"],
                                                         max_broadcast_rows=0).collect()), key=str)
    assert small == large
    assert {r[1]: r[2] for r in small} == {1: "A", 2: "A", 3: "z", 4: "w"}


def test_state_bound_day_vs_exact(spark):
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"
    hist = spark.createDataFrame([("30000001", 2.0, dt.datetime(2024, 1, 8, 6), 1)], schema)
    batch = spark.createDataFrame([("30000001", 5.0, dt.datetime(2024, 1, 8, 9), 2)], schema)
    day = evolution.classify_batch(batch, hist).first()
    exact = evolution.classify_batch(batch, hist, bound="exact").first()
    # day bound: the same-day history row is invisible to the state -> first seen
    assert (day.tipo_evolucion, day.apariciones) == ("Nuevos", 2)
    assert (exact.tipo_evolucion, exact.apariciones) == ("Migratorios", 2)


def test_patch_from_lookup_modes_and_week_labels(spark):
    from casework.functions.scalars import week_label
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, _seq int, v string")
    lookup = spark.createDataFrame([("a", 5, "old"), ("a", 9, "new")], "k string, _seq int, v string")
    safe = {r.k: r.v for r in history.patch_from_lookup(target, lookup, "k", ["v"], ["_seq"]).collect()}
    parity = {r.k: r.v for r in history.patch_from_lookup(target, lookup, "k", ["v"], ["_seq"],
                                                          keep_unmatched=False).collect()}
    assert safe == {"a": "new", "b": "y"} and parity == {"a": "new", "b": None}
    d = spark.sql("select date'2024-01-08' w").select(
        week_label(F.col("w"), "dm").alias("a"), week_label(F.col("w"), "dmon").alias("b"),
        week_label(F.col("w"), "iso").alias("c")).first()
    assert (d.a, d.b, d.c) == ("08/01", "08 Jan", "2024-01-08")


def test_labelled_rows_can_be_labelled_again(spark):
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"
    batch = spark.createDataFrame([("30111222", 1.0, _ts(0), 0), ("30111222", 2.0, _ts(200), 1), ("NO VISIBLE", 1.0, _ts(1), 2)], schema)
    once = evolution.classify_batch(batch, batch.filter(F.lit(False)))
    again = evolution.classify_batch(once, batch.filter(F.lit(False)))
    assert again.columns == once.columns
    assert sorted(map(tuple, again.collect()), key=lambda r: r[3]) == sorted(map(tuple, once.collect()), key=lambda r: r[3])
