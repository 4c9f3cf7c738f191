"""Unit rows for the scalar rules (FIXTURES sections 5, 6, 8)."""

from pyspark.sql import functions as F

from casework.functions.identity import categorize_id, is_valid_id, with_id_category
from casework.functions.scalars import (dashboard_contact_class, district_key, is_target_district,
                                        origin_group, manual_group, pct_cell, pct_of_parent, report_level,
                                        to_district, week_start)
from casework.functions.text import clean_name, clean_outcome_text

ID_ROWS = [
    (None, "NO BRINDO/NO VISIBLE", "nan", False),
    ("  ", "NO BRINDO/NO VISIBLE", "empty", False),
    ("dni ilegible", "NO BRINDO/NO VISIBLE", "patron_no_brindo_genericos", False),
    ("xX.*", "NO BRINDO/NO VISIBLE", "simbolos_o_letras_cortas", False),
    ("SD", "NO BRINDO/NO VISIBLE", "simbolos_o_letras_cortas", False),
    ("--", "NO BRINDO/NO VISIBLE", "texto_o_corto", False),
    ("aaaab", "NO BRINDO/NO VISIBLE", "solo_letras_repetidas", False),
    ("no brindo", "NO BRINDO/NO VISIBLE", "texto_o_corto", False),
    ("pasaporte 30111222", "CONTACTO EXTRANJERO", "patron_extranjero", False),
    ("sin dni 30111222", "30111222", "dni_valido", True),
    ("30.111.222", "30111222", "dni_valido", True),
    ("012345", "12345", "dni_valido", False),
    ("7777777", "7777777", "dni_valido", False),
    ("12345678901", "NO BRINDO/NO VISIBLE", "resto_no_brindo", False),
    ("12345678901a", "NO BRINDO/NO VISIBLE", "texto_o_corto", False),
    ("no\\sbrindo", "NO BRINDO/NO VISIBLE", "patron_no_brindo_genericos", False),
    ("\\", "NO BRINDO/NO VISIBLE", "simbolos_o_letras_cortas", False),
]


def test_id_rules_parity(spark):
    df = spark.createDataFrame([(r[0],) for r in ID_ROWS], "dni string")
    out = with_id_category(df, "dni", "cat", "reason").withColumn("valid", is_valid_id(F.col("cat")))
    got = {(r.dni, r.cat, r.reason, r.valid) for r in out.collect()}
    assert got == set(ID_ROWS)


def test_id_column_api_matches_dataframe_step(spark):
    df = spark.createDataFrame([(r[0],) for r in ID_ROWS], "dni string")
    a = df.select("dni", categorize_id(F.col("dni")).alias("c")).select("dni", "c.category", "c.reason")
    b = with_id_category(df, "dni", "category", "reason")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_id_rules_intended_mode(spark):
    df = spark.createDataFrame([("no brindo",), ("sin dni 30111222",)], "dni string")
    out = with_id_category(df, "dni", "cat", "reason", mode="intended").collect()
    assert {r.reason for r in out} == {"patron_no_brindo_genericos"}


def test_clean_name(spark):
    rows = [(" josé-maría  o'peña, ", "JOSE MARIA OPENA"), ("123", None), ("Ana\tPaz", "ANAPAZ"),
            (None, None), ("Jürgen.Straße", "JURGEN STRASSE")]
    df = spark.createDataFrame([(a,) for a, _ in rows], "s string")
    got = [r.c for r in df.select(clean_name(F.col("s")).alias("c")).collect()]
    assert got == [b for _, b in rows]


def test_clean_outcome_text(spark):
    rows = [("12–No se contacta y no se observan pertenencias", "12 no se contacta y no se observan pertenencias"),
            ("04-Traslado/acompañamiento", "04 traslado acompanamiento"),
            (None, ""), ("  Cost 5€ _x_ ", "cost 5 x"), ("Æsop straße", "aesop strasse")]
    df = spark.createDataFrame([(a,) for a, _ in rows], "s string")
    got = [r.c for r in df.select(clean_outcome_text(F.col("s")).alias("c")).collect()]
    assert got == [b for _, b in rows]


def test_district_and_week(spark):
    df = spark.createDataFrame([("1,5",), (" 14 ",), ("NaN",), ("x",), (None,), ("14.5",)], "c string")
    out = df.select(to_district(F.col("c")).alias("d")).select("d", district_key(F.col("d")).alias("k")).collect()
    assert [(r.d, r.k) for r in out] == [(1.5, "1.5"), (14.0, "14"), (None, None), (None, None), (None, None),
                                         (14.5, "14")]
    w = spark.sql("select timestamp_ntz'2026-01-04 10:00:00' as t").select(week_start(F.col("t")).alias("w"))
    assert str(w.first().w) == "2025-12-29"


def test_target_district_string_fallback(spark):
    df = spark.createDataFrame([("PALERMO NORTE",), ("14,5",), ("13",), ("belgrano",)], "c string")
    got = [r.t for r in df.select(is_target_district(F.col("c"), 14.5).alias("t")).collect()]
    assert got == [True, True, False, False]


CONTACT_ROWS = [
    ("PENDIENTE", 5.0, "Sin dato", "sin_match", None, "Sin cubrir", "Sin cubrir"),
    ("PENDIENTE", 2.0, "Sin dato", "sin_match", None, "Seguimiento", "Sin dato"),
    ("PENDIENTE", None, "Sin dato", "sin_match", None, "Sin cubrir", "Sin cubrir"),
    ("CERRADO", 2.0, "Sin dato", "sin_match", None, "Sin cubrir", "Sin cubrir"),
    ("CERRADO", 2.0, "Sin dato", "sin_match", "POSITIVO", "Seguimiento", "Sin dato"),
    ("CERRADO", 5.0, "Desestimado", "20. Desestimado", "x", "Desestimado", "No se contacta"),
    (" pendiente ", 5.0, "Se contacta", "18. Mendicidad", "x", "Sin cubrir", "Se contacta"),
]


def test_contact_classes(spark):
    df = spark.createDataFrame([r[:5] for r in CONTACT_ROWS],
                               "estado string, comuna double, nivel string, cat string, cierre string")
    out = df.select(
        report_level(F.col("nivel"), F.col("cat"), F.col("estado"), F.col("comuna"), F.col("cierre")).alias("a"),
        dashboard_contact_class(F.col("nivel"), F.col("cat"), F.col("estado"), F.col("comuna"), F.col("cierre"),
                                F.lit("otra cosa")).alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [(r[5], r[6]) for r in CONTACT_ROWS]


def test_origin_groups(spark):
    df = spark.createDataFrame([("vecino ",), (None,), (" Cortan",), ("Nueva",), ("NIÑA/NIÑO",)], "o string")
    out = df.select(origin_group(F.col("o")).alias("g"), manual_group(F.col("o")).alias("m")).collect()
    assert [(r.g, r.m) for r in out] == [
        ("Vecino / ONG / PST", "Llamados 108"), ("Sin origen", "Otros"), ("__excluir__", "Otros"),
        ("Otro (Nueva)", "Otros"), ("Gobierno Ciudad (Coop.)", "Casos particulares")]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 8), (5, 0), (0, 3), (1, 40), (3, 40)], "n long, t long")
    out = df.select(pct_cell(F.col("n"), F.col("t")).alias("c"), pct_of_parent(F.col("n"), F.col("t")).alias("p"))
    # 1/8 = 12.5% -> 12 (half-even); 1/40 = 2.5% -> 2; 3/40 = 7.5% -> 8; parent percent half-up
    assert [(r.c, r.p) for r in out.collect()] == [("12% (1)", 13), ("500% (5)", None), ("0% (0)", None),
                                                   ("2% (1)", 3), ("8% (3)", 8)]
