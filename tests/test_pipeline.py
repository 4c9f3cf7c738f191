"""End-to-end weekly runs against a Parquet history."""

import os
import tempfile

from pyspark.sql import functions as F

from casework.operators import history
from casework.plans import catalog, pipeline
from casework.session import write_table  # noqa: F401
from casework.sources import schema

SF = "/root/testdata/sf0.001"


def test_two_weekly_runs(spark):
    i, h, _ = catalog.split(spark, SF)
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "history")
    empty = (pipeline.clean_batch(h.limit(0), fuzzy=False)
             .withColumn("tipo_evolucion", F.lit(None).cast("string"))
             .withColumn("apariciones", F.lit(None).cast("bigint")))
    first = pipeline.run_weekly(h, empty, path, wm=None, fuzzy=True)
    assert first.n_reconciled == 0
    n_first = spark.read.parquet(path).count()
    assert n_first == pipeline.clean_batch(h, fuzzy=False).count()

    before = write_table(spark.read.parquet(path), "before_second_run")  # a copy only to compare against
    n_pending_before = before.filter("estado = 'PENDIENTE'").count()
    hist = spark.read.parquet(path)
    wm = history.watermark(hist).scalar()
    second = pipeline.run_weekly(catalog.reexport(i), hist, path, wm=wm, fuzzy=True)
    n_batch = second.batch.count()
    out = spark.read.parquet(path)
    assert second.n_reconciled > 0
    assert out.count() == n_first + n_batch
    old = out.join(before.select("_seq"), "_seq", "left_semi")
    assert old.filter("estado = 'PENDIENTE'").count() == n_pending_before - second.n_reconciled
    # reconciled rows equal the reconcile operator applied to the whole history
    want = history.reconcile_pending(before.drop("week"), catalog.reexport(i), fuzzy=True)
    got = {r._seq: (r.estado, r.categoria_final) for r in old.collect()}
    assert got == {r._seq: (r.estado, r.categoria_final) for r in want.collect()}
    # a person is "Nuevos" at most once across both runs
    news = out.filter("tipo_evolucion = 'Nuevos'").groupBy("dni_categorizado").count()
    assert news.filter("count > 1").count() == 0


def test_schema_alignment_and_landing_csv(spark, tmp_path):
    p = tmp_path / "export.csv"
    p.write_text("Exported by a report tool\nId.Suceso,Documento,LATITUD,Extra\n1,30111222,\"1,5\",x\n2,,2.0,y\n",
                 encoding="utf-8")
    raw = schema.read_landing_csv(spark, str(p))
    assert raw.columns == ["Id.Suceso", "Documento", "LATITUD", "Extra"]
    canon = schema.rename_headers(raw, schema.BATCH_HEADER_RENAMES)
    aligned = schema.align_to_schema(canon, schema.HISTORY_SCHEMA)
    rows = aligned.orderBy("id_suceso").collect()
    assert aligned.columns == [f.name for f in schema.HISTORY_SCHEMA.fields]
    assert [(r.id_suceso, r.persona_dni, r.latitud, r.agencia) for r in rows] == [
        ("1", "30111222", "1,5", None), ("2", None, "2.0", None)]
    assert schema.snake_case("Recurso Fecha asignacion") == "recurso_fecha_asignacion"
    assert schema.title_case("fecha_inicio") == "Fecha Inicio"


def test_report_header_renames(spark):
    df = spark.createDataFrame([("a", "b", "c")], "Resultado string, Estado string, Otra string")
    out = schema.rename_headers(df, schema.REPORT_HEADER_RENAMES)
    assert out.columns == ["resultado", "estado", "Otra"]


def test_cli_weekly_and_reports(spark, tmp_path):
    from casework.__main__ import main
    i, h, b = catalog.split(spark, SF)
    first = str(tmp_path / "landing1")
    second = str(tmp_path / "landing2")
    h.write.parquet(first)
    catalog.reexport(i).write.parquet(second)
    hist = str(tmp_path / "history")
    main(["weekly", "--landing", first, "--format", "parquet", "--history", hist, "--no-fuzzy"])
    n1 = spark.read.parquet(hist).count()
    main(["weekly", "--landing", second, "--format", "parquet", "--history", hist, "--no-fuzzy"])
    n2 = spark.read.parquet(hist).count()
    assert n2 > n1
    out = str(tmp_path / "reports")
    main(["reports", "--history", hist, "--out", out])
    assert spark.read.parquet(os.path.join(out, "hierarchy")).count() > 0
    assert spark.read.parquet(os.path.join(out, "kpi_table")).count() > 0


def test_incident_dedup_option_and_write_paths(spark, tmp_path):
    from casework.plans import reports
    lab = catalog.labeled(spark, SF)
    plain = reports.prepare_weekly(lab)
    dedup = reports.prepare_weekly(lab, dedup_incident=True)
    assert dedup.count() == plain.select("id_suceso").distinct().count() < plain.count()
    first = dedup.join(plain.groupBy("id_suceso").agg(F.min_by("_seq", F.struct("fecha_inicio", "_seq")).alias("_seq")),
                       ["id_suceso", "_seq"], "left_anti")
    assert first.count() == 0  # the earliest row of each incident is kept
    snap = str(tmp_path / "snapshot")
    history.write_snapshot(lab, snap)
    history.write_snapshot(lab.limit(5), snap)  # whole-table overwrite
    assert spark.read.parquet(snap).count() == 5
    raw = str(tmp_path / "bronze")
    history.append_raw(catalog.split(spark, SF)[2], raw)
    history.append_raw(catalog.split(spark, SF)[2], raw)
    assert spark.read.parquet(raw).count() == 2 * catalog.split(spark, SF)[2].count()


def test_cli_weekly_from_banner_csv(spark, tmp_path):
    from casework.__main__ import main
    _, h, _ = catalog.split(spark, SF)
    cols = [c for c in h.columns if c != "_seq"]
    headers = [schema.title_case(c) for c in cols]
    body = h.orderBy("_seq").select(F.to_csv(F.struct(*[F.col(c).cast("string") for c in cols])).alias("value"))
    lead = spark.createDataFrame([("Exported report - weekly interventions",), (",".join(headers),)], "value string")
    landing = str(tmp_path / "csv_landing")
    (lead.withColumn("_o", F.lit(0)).unionByName(body.withColumn("_o", F.lit(1)))
         .coalesce(1).sortWithinPartitions("_o").drop("_o").write.text(landing))
    hist = str(tmp_path / "history_csv")
    main(["weekly", "--landing", landing, "--format", "csv", "--history", hist, "--no-fuzzy"])
    out = spark.read.parquet(hist)
    assert out.count() == pipeline.clean_batch(h, fuzzy=False).count()
    assert out.filter("fecha_inicio IS NULL").count() == 0
    assert out.filter("tipo_evolucion IS NULL").count() == 0


def test_landing_csv_keeps_quoted_line_breaks(spark, tmp_path):
    p = tmp_path / "multi.csv"
    p.write_text('Banner line, exported\nId.Suceso,Resultado\n1,"Se retira\ndel lugar"\n2,"18. Mendicidad"\n',
                 encoding="utf-8")
    rows = schema.read_landing_csv(spark, str(p)).orderBy("`Id.Suceso`").collect()
    assert [(r["Id.Suceso"], r["Resultado"]) for r in rows] == [("1", "Se retira\ndel lugar"), ("2", "18. Mendicidad")]


def test_read_history_first_load_is_empty_typed_frame(spark, tmp_path):
    df = schema.read_history(spark, str(tmp_path / "missing"), schema.HISTORY_SCHEMA)
    assert df.count() == 0 and df.schema == schema.HISTORY_SCHEMA
