"""Brute-force models on small random fixtures:

* the week-by-week evolution loop with carried per-person state, run in
  plain Python, against the window/aggregation plan - with one id holding a
  third of all rows;
* point-in-polygon by plain ray casting over every zone, against the
  grid-cell equi-join plan."""

import datetime as dt
import random

from pyspark.sql import functions as F

from casework.operators import evolution, geo

T0 = dt.datetime(2024, 1, 1)  # a Monday


def _monday(ts):
    return (ts - dt.timedelta(days=ts.weekday())).date()


def _model_labels(batch, history):
    """The source's loop: state = last district per id before the batch day,
    weekly reference = last row of the (week, id), labels carried week by week."""
    day = min(r[2] for r in batch).replace(hour=0, minute=0, second=0, microsecond=0)
    state, seen = {}, set()
    for dni, com, ts, seq in sorted(history, key=lambda r: (r[2], r[3])):
        if ts < day:
            state[dni] = com
            seen.add(dni)
    valid = [r for r in batch if r[0].isdigit()]
    ref = {}
    for dni, com, ts, seq in sorted(valid, key=lambda r: (r[2], r[3])):
        ref[(_monday(ts), dni)] = com
    labels = {}
    for week in sorted({w for w, _ in ref}):
        block = [(d, c) for (w, d), c in ref.items() if w == week]
        for dni, com in block:
            if dni not in seen:
                lab = "Nuevos"
            else:
                prev = state.get(dni)
                lab = "Recurrentes" if prev is None or com is None or prev == com else "Migratorios"
            labels[(week, dni)] = lab
        for dni, com in block:
            state[dni] = com
            seen.add(dni)
    first = {}
    for dni, com, ts, seq in sorted(valid, key=lambda r: (r[2], r[3])):
        first.setdefault((_monday(ts), dni), seq)
    hist_n = {}
    for r in history:
        hist_n[r[0]] = hist_n.get(r[0], 0) + 1
    batch_n = {}
    for r in valid:
        batch_n[r[0]] = batch_n.get(r[0], 0) + 1
    out = {}
    for dni, com, ts, seq in batch:
        if not dni.isdigit():
            out[seq] = ("No clasificable", 0)
            continue
        lab = labels[(_monday(ts), dni)]
        if lab == "Nuevos" and first[(_monday(ts), dni)] != seq:
            lab = "Nuevo repetido"
        out[seq] = (lab, hist_n.get(dni, 0) + batch_n[dni])
    return out


def test_evolution_matches_loop_model_with_hot_id(spark):
    rnd = random.Random(7)
    ids = ["3000000%d" % i for i in range(8)]
    schema = "dni_categorizado string, comuna_calculada double, fecha_inicio timestamp_ntz, _seq long"

    def row(seq, start_days, span_days):
        hot = rnd.random() < 1 / 3
        dni = ids[0] if hot else rnd.choice(ids[1:] + ["NO BRINDO/NO VISIBLE"])
        com = None if rnd.random() < 0.15 else float(rnd.choice([1, 2, 13, 14, 1.5]))
        ts = T0 + dt.timedelta(days=start_days + rnd.random() * span_days)
        return (dni, com, ts, seq)

    history = [row(i, 0, 21) for i in range(300)]
    batch = [row(1000 + i, 21, 20) for i in range(600)]
    got = {r._seq: (r.tipo_evolucion, r.apariciones) for r in
           evolution.classify_batch(spark.createDataFrame(batch, schema),
                                    spark.createDataFrame(history, schema)).collect()}
    assert got == _model_labels(batch, history)


def _model_zone(x, y, zones):
    if x is None or y is None:
        return None
    for z in sorted(zones, key=lambda z: (z.priority, z.ord)):
        inside, on_edge = False, False
        for x1, y1, x2, y2 in z.edges():
            x1, y1, x2, y2 = float(x1), float(y1), float(x2), float(y2)
            if ((y1 > y) != (y2 > y)) and (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1):
                inside = not inside
            if ((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0 and min(x1, x2) <= x <= max(x1, x2)
                    and min(y1, y2) <= y <= max(y1, y2)):
                on_edge = True
        if inside and not on_edge:
            return z.comuna
    return None


def test_grid_join_matches_bruteforce_raycast(spark):
    rnd = random.Random(11)
    pts = []
    for i in range(1500):
        kind = rnd.random()
        if kind < 0.3:   # integer grid: vertices, edges and cell boundaries
            x, y = float(rnd.randint(-1, 11)), float(rnd.randint(-1, 7))
        elif kind < 0.5:  # half steps, on many edges and midpoints
            x, y = rnd.randint(-2, 22) / 2, rnd.randint(-2, 14) / 2
        else:
            x, y = round(rnd.uniform(-1, 11), 2), round(rnd.uniform(-1, 7), 2)
        pts.append((i, str(y), str(x)))
    df = spark.createDataFrame(pts, "id int, latitud string, longitud string")
    for cell in (1.0, 0.5, 3.0):
        got = {r.id: r.comuna_calculada for r in geo.assign_zone(df, cell=cell).collect()}
        want = {i: _model_zone(float(x), float(y), geo.SYNTHETIC_ZONES) for i, y, x in pts}
        assert got == want, cell


def test_zone_index_matches_bruteforce_on_random_layers(spark):
    """Random layers of several rings a zone (crossing ones too), against all edges."""
    schema = "zone_id string, comuna double, priority int, ord int, ring array<struct<x: double, y: double>>"
    for seed, cell, max_bytes in ((1, None, 1 << 28), (2, 0.7, 1 << 28), (3, 5.0, 0)):
        rnd = random.Random(seed)
        rows, zones = [], []
        for k in range(12):
            rings = []
            for _ in range(rnd.randint(1, 4)):
                on_grid = rnd.random() < 0.5
                corner = lambda: ((float(rnd.randint(0, 9)), float(rnd.randint(0, 9))) if on_grid
                                  else (round(rnd.uniform(0, 9), 3), round(rnd.uniform(0, 9), 3)))
                ring = [corner() for _ in range(rnd.randint(3, 9))]
                rings.append(ring + ring[:1] * rnd.randint(0, 1))
            zone = geo.Zone(f"z{k}", float(k), k % 3, k, tuple(rings[0]), tuple(tuple(r) for r in rings[1:]))
            zones.append(zone)
            rows += [(zone.zone_id, zone.comuna, zone.priority, zone.ord, ring) for ring in rings]
        rows += [("short", 99.0, 0, 0, [(0.0, 0.0), (1.0, 1.0)]), ("none", 99.0, 0, 0, None)]
        index = geo.zone_index(spark.createDataFrame(rows, schema).repartition(3), cell, max_bytes)
        assert index.small == (max_bytes > 0)
        pts = [(i, str(y), str(x)) for i, (x, y) in enumerate(
            [(float(rnd.randint(-1, 10)), float(rnd.randint(-1, 10))) for _ in range(300)]
            + [(round(rnd.uniform(-1, 10), 2), round(rnd.uniform(-1, 10), 2)) for _ in range(900)])]
        df = spark.createDataFrame(pts, "id int, latitud string, longitud string")
        got = {r.id: r.comuna_calculada for r in geo.assign_zone(df, zones=index).collect()}
        want = {i: _model_zone(float(x), float(y), zones) for i, y, x in pts}
        assert got == want, [(pts[i], got[i], want[i]) for i in got if got[i] != want[i]][:5]
        most = index.cells(spark).select(F.max(F.aggregate("_zones", F.lit(0), lambda a, z: a + F.size(z["ys"])))).first()[0]
        assert most <= 60  # heights of neighbouring edges cancel out
