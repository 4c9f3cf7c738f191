"""Faults that a job's user would meet: paths, headers, settings, undated rows."""

import csv

from pyspark.sql import functions as F

from casework import session
from casework.functions.scalars import to_district
from casework.sources import schema


def landing(folder, name, banner, header, *rows):
    with open(folder / name, "w", newline="") as f:
        f.write(banner + "\n")
        csv.writer(f, lineterminator="\n").writerows([header, *rows])


def test_blank_banner_and_moved_columns(spark, tmp_path):
    landing(tmp_path, "a.csv", "Export", ["id", "name"], ["1", "a"], ["2", "b"])
    landing(tmp_path, "b.csv", "", ["id", "name"], ["3", "c"], ["4", "d"])
    landing(tmp_path, "c.csv", "Export", ["name", "id", "more"], ["e", "5", "x"])
    for multiline in (True, False):
        got = schema.read_landing_csv(spark, str(tmp_path), multiline=multiline)
        assert sorted((r["id"], r["name"], r["more"]) for r in got.collect()) == [
            ("1", "a", None), ("2", "b", None), ("3", "c", None), ("4", "d", None), ("5", "e", "x")]


def test_paths_are_looked_up_where_they_are(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert session.path_exists(spark, f"file:{tmp_path}/t") and not session.path_exists(spark, f"file:{tmp_path}/u")
    before = session.table_version(spark, str(tmp_path / "t"))
    spark.range(3).write.mode("append").parquet(str(tmp_path / "t"))
    assert session.table_version(spark, str(tmp_path / "t")) != before


def test_unreadable_history_is_an_error(spark, tmp_path):
    import pytest
    path = tmp_path / "h"
    path.mkdir()
    (path / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        schema.read_history(spark, str(path), spark.range(1).schema).collect()
    assert schema.read_history(spark, str(tmp_path / "absent"), spark.range(1).schema).count() == 0


def test_submitted_settings_win(monkeypatch):
    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--master yarn --conf spark.sql.shuffle.partitions=4000 pyspark-shell")
    assert session.submitted_conf() == {"spark.master": "yarn", "spark.sql.shuffle.partitions": "4000"}
    assert not session.is_local("yarn") and session.is_local("local[8]") and not session.is_local("local-cluster[3,2,1000]")


def test_literal_suffixes_are_no_numbers(spark):
    rows = spark.createDataFrame([(v,) for v in ("12d", "0f", "12", " 1,5 ", "1e2", "x", "")], "v string")
    assert [r[0] for r in rows.select(to_district(F.col("v"))).collect()] == [None, None, 12.0, 1.5, 100.0, None, None]


def test_zone_table_with_parts_and_holes(spark, tmp_path):
    from casework.operators import geo
    rings = [("z", 2.0, 0, 0, [(0., 0.), (4., 0.), (4., 4.), (0., 4.)]), ("z", 2.0, 0, 0, [(1., 1.), (3., 1.), (3., 3.), (1., 3.)]),
             ("z", 2.0, 0, 0, [(5., 0.), (6., 0.), (6., 1.), (5., 1.)]), ("bad", 9.0, 0, 0, None), ("bad", 9.0, 0, 0, [(0., 0.)])]
    spark.createDataFrame(rings, "zone_id string, comuna double, priority int, ord int, ring array<struct<x: double, y: double>>") \
        .write.parquet(str(tmp_path / "zones"))
    zones = geo.read_zones(spark, f"file:{tmp_path}/zones")
    cells = zones.cells(spark).select(F.explode("_zones").alias("z")).select("z.*")
    assert {r["zone_id"] for r in cells.collect()} == {"z"}
    points = [("0.5", "0.5"), ("2", "2"), ("1", "2"), ("0.5", "5.5"), ("0.5", "4.5"), ("4", "4"), (None, "1"), ("1e9", "1e9")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, latitud string, longitud string")
    got = {r["i"]: r["comuna_calculada"] for r in geo.assign_zone(rows, zones=zones).collect()}
    assert got == {0: 2.0, 1: None, 2: None, 3: 2.0, 4: None, 5: None, 6: None, 7: None}


def test_weekly_job_run_twice_on_a_uri(spark, tmp_path):
    from argparse import Namespace
    from casework import __main__ as job
    from casework.sources.adapter import load_interventions
    load_interventions(spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "landing"))
    spark.createDataFrame([("all", 7.0, 0, 0, [(-500., -500.), (500., -500.), (500., 500.), (-500., 500.)])],
                          "zone_id string, comuna double, priority int, ord int, ring array<struct<x: double, y: double>>") \
        .write.parquet(str(tmp_path / "zones"))
    args = Namespace(landing=f"file:{tmp_path}/landing", format="parquet", history=f"file:{tmp_path}/history",
                     zones=f"file:{tmp_path}/zones", kml=[], fuzzy=False, day_first=False, state=None)
    first = job.weekly(args)
    assert first["mode"] == "first_load" and first["appended"] > 0
    stored = spark.read.parquet(args.history)
    assert {r[0] for r in stored.select("comuna_calculada").distinct().collect()} - {None} == {7.0}
    second = job.weekly(args)
    assert second["mode"] == "incremental" and second["appended"] == 0
    assert spark.read.parquet(args.history).count() == first["appended"]
    out = job.reports(Namespace(history=args.history, out=f"file:{tmp_path}/reports", dedup_incident=True))
    assert "contact_breakdown_dashboard" in out and spark.read.parquet(out["kpi_table"]).count() > 0


def test_numbered_dates(spark):
    from datetime import datetime

    from casework.functions.scalars import to_wall_clock
    texts = ["4/5/2026", " 04/05/2026 10:00 ", "13/05/2026 9:30:15", "5.4.2026", "2026-05-04 10:00:00", "31/02/2026", "x", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = rows.orderBy("i").select(to_wall_clock(F.col("v")), to_wall_clock(F.col("v"), day_first=True)).collect()
    april, may = datetime(2026, 4, 5), datetime(2026, 5, 4)
    assert [r[0] for r in got] == [april, april.replace(hour=10), datetime(2026, 5, 13, 9, 30, 15), may, may.replace(hour=10),
                                   None, None, None, None]
    assert [r[1] for r in got] == [may, may.replace(hour=10), datetime(2026, 5, 13, 9, 30, 15), april, may.replace(hour=10),
                                   None, None, None, None]


def test_headers_alike_and_unknown_ones(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], ["Id Suceso", "Id.Suceso", "Teléfono", "teléfono "])
    got = schema.canonical_headers(df)
    assert got.columns == ["id_suceso", "teléfono"] and tuple(got.first()) == ("b", "d")
    assert schema.title_case("persona_dni") == "Persona DNI" and schema.title_case("nota_final") == "Nota Final"


def test_history_of_before_a_column_was_kept(spark, tmp_path):
    path = str(tmp_path / "h")
    old = spark.createDataFrame([(1, "a")], "_seq long, id_suceso string")
    old.write.parquet(path)
    assert schema.read_history_with(spark, path, schema.LANDING_SCHEMA).select("recurso_arribo", "tipo").first() == (None, None)
    old.withColumn("tipo", F.lit("t")).write.mode("append").parquet(path)
    rows = schema.read_history_with(spark, path, schema.LANDING_SCHEMA).select("tipo").collect()
    assert sorted(str(r[0]) for r in rows) == ["None", "t"]


def test_signs_are_spelled_out(spark):
    from casework.functions.text import clean_outcome_text
    df = spark.createDataFrame([("Nº 5 – 1ª 20° m²",)], "v string")
    assert df.select(clean_outcome_text(F.col("v"))).first()[0] == "no 5 1a 20deg m2"


def test_weekly_job_with_and_without_person_state(spark, tmp_path):
    """Three drops, the second of which starts in the middle of a day."""
    from argparse import Namespace

    from casework import __main__ as job
    from casework.sources.adapter import load_interventions
    rows = load_interventions(spark, "/root/testdata/sf0.001")
    times = [r[0] for r in rows.select("fecha_inicio").orderBy("fecha_inicio").collect()]
    cuts = [times[len(times) // 3], times[2 * len(times) // 3].replace(hour=0, minute=0, second=0, microsecond=0), times[-1]]
    for i, cut in enumerate(cuts):
        rows.filter(F.col("fecha_inicio") <= F.lit(cut)).write.parquet(str(tmp_path / f"landing{i}"))
    states = []
    for name, state in (("plain", None), ("kept", f"file:{tmp_path}/state")):
        for i in range(3):
            job.weekly(Namespace(landing=f"file:{tmp_path}/landing{i}", format="parquet", history=f"file:{tmp_path}/{name}",
                                 zones=None, kml=[], fuzzy=False, day_first=False, state=state))
        states.append(sorted(map(str, spark.read.parquet(f"file:{tmp_path}/{name}").select(
            "_seq", "id_suceso", "tipo_evolucion", "apariciones").collect())))
    assert states[0] == states[1] and len(states[0]) > 0
    assert len(list((tmp_path / "state").iterdir())) == 3


def test_landed_rows_are_accepted_or_rejected(spark, tmp_path):
    from casework import __main__ as job
    lines = ["Reporte semanal,,", "Id Suceso,Fecha Inicio,Fecha Fin", "1,2024-01-01 10:00:00,2024-01-02 10:00:00", "2,,x",
             "3,2024-01-01 11:00:00,nunca", "4,ayer,", "5,2024-01-03 10:00:00,2024-01-04 10:00:00,too,many"]
    (tmp_path / "landing.csv").write_text("\n".join(lines) + "\n")
    accepted = job._landing(spark, f"file:{tmp_path}/landing.csv", "csv", False, f"file:{tmp_path}/rejects")
    rows = {r["id_suceso"]: r["fecha_fin"] for r in accepted.collect()}
    assert set(rows) == {"1", "3"} and rows["3"] is None
    rejected = spark.read.parquet(f"file:{tmp_path}/rejects/rows")
    got = {r["row"].split('"')[3]: r["reasons"] for r in rejected.collect()}
    assert got["2"] == ["fecha_inicio: absent", "fecha_fin: not parsed"] and got["4"] == ["fecha_inicio: not parsed"]
    assert got["5"][0] == "malformed" and len(got) + len(rows) == 5
    notes = spark.read.parquet(f"file:{tmp_path}/rejects/values").collect()
    assert [r["reason"] for r in notes] == ["fecha_fin: not parsed"]
