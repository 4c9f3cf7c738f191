"""Row work of the cleaning pass: what it may cost, and that it gives what the plain steps give."""
import re

from pyspark.sql import functions as F

from casework.functions import text
from casework.functions.identity import with_id_category
from casework.operators import categorize as cat
from casework.operators import history
from casework.plans import pipeline

TEXTS = [None, "", " ", "Traslado  efectivo_a-CIS", "Derivación a SAME", "niño\tcon\nÑandú", "Straße º 5°", "Σίσυφος και щука",
         "été à", "x⃐y z︠w", "日本 abc", "(c) ® ²³", "ĳssel æther þorn", "a b", "--_--", "😀 a😀b"]
NAMES = [None, "", "  josé-maría  o'peña, ", "Ana\tPaz", "Zoë Ñandú", "Jürgen.Straße", "JOSÉ", "ÁNGEL", "a-b.c,d", "123", "x⃐y", "  A  B  "]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plain_outcome(c):
    """F02 step by step."""
    low = F.lower(c)
    table = F.split(F.lit("\ue000".join(text.romanised())), "\ue000")
    looked = F.transform(F.split(low, ""), lambda ch: F.coalesce(F.get(table, F.ascii(ch) - 0x80), ch))
    looked = F.regexp_replace(F.array_join(looked, ""), r"\p{Mn}", "")
    s = F.when(F.octet_length(low) == F.char_length(low), low).otherwise(looked)
    s = F.regexp_replace(F.regexp_replace(s, r"[_-]", " "), r"[^a-z0-9\s]", " ")
    return F.coalesce(F.trim(F.regexp_replace(s, r"\s+", " ")), F.lit(""))


def plain_name(c):
    """F01 step by step."""
    s = F.regexp_replace(text.fold_accents(F.upper(c)), r"[-.,]", " ")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, r"[^A-Z ]", ""), r" +", " "))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.nullif(s, F.lit("")))


def test_normalisers_equal_their_steps(spark):
    out = spark.createDataFrame([(t,) for t in TEXTS + NAMES], "t string")
    rows = out.select("t", text.clean_outcome_text(F.col("t")).alias("a"), plain_outcome(F.col("t")).alias("b"),
                      text.clean_name(F.col("t")).alias("c"), plain_name(F.col("t")).alias("d")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]
    assert [(r.t, r.c) for r in rows] == [(r.t, r.d) for r in rows]


def test_normalisers_take_few_regex_passes(spark):
    df = spark.createDataFrame([("a",)], "t string")
    passes = {f.__name__: len(re.findall("regexp_replace", _plan(df.select(f(F.col("t")).alias("o")))))
              for f in (text.clean_outcome_text, text.clean_name)}
    assert passes["clean_outcome_text"] <= 2 and passes["clean_name"] <= 4, passes  # a column may be named twice (nullif)


def test_near_match_texts_are_not_sorted(spark):
    df = spark.createDataFrame([("traslado efectivo a cys",), ("zzz",), (None,)], "t string")
    table = cat.fuzzy_table(cat.with_rules(df, "t"))
    assert "SortAggregate" not in _plan(table)
    assert {r._fz_text for r in table.collect()} <= {"traslado efectivo a cys", "zzz"}


def test_near_match_texts_may_come_from_other_rows(spark):
    schema = "_seq long, cierre_supervisor string, resultado string"
    df = spark.createDataFrame([(1, None, "Traslado efectivo a lugar de orgen"), (2, "N/A", "zzzz qqqq"), (3, None, None)], schema)
    texts = df.unionByName(df).unionByName(spark.createDataFrame([(9, "Mendicidad infantl", None)], schema))
    plain = cat.outcome_columns(df).orderBy("_seq").collect()
    assert cat.outcome_columns(df, texts=texts).orderBy("_seq").collect() == plain


def test_cleaning_deduplicates_once(spark, monkeypatch):
    """The pass for the near-match texts reads no deduplicated rows."""
    seen = []
    real = cat.materialize_checked
    monkeypatch.setattr(cat, "materialize_checked", lambda df, n: (seen.append(_plan(df)), real(df, n))[1])
    raw = spark.createDataFrame([(1, "a", "2", "Se retira", None, "BAP", "1.5", "2.5", "x", "y")],
                                "_seq long, id_suceso string, persona_dni string, resultado string, cierre_supervisor string, "
                                "agencia string, latitud string, longitud string, persona_nombre string, persona_apellido string")
    assert pipeline.clean_batch(raw).count() == 1
    assert len(seen) == 1 and "min(_seq" not in seen[0]


def test_plain_digits_keep_their_category(spark):
    ids = ["30000001", "030000001", "12345", "12345678901", "1234567", " 30000001 ", "٣٠٠٠٠٠٠١", "xx", "30.000.001", "000000"]
    df = spark.createDataFrame([(i,) for i in ids], "d string")
    got = {r.d: (r.c, r.m) for r in with_id_category(df, "d", "c", "m").collect()}
    assert got["30000001"] == ("30000001", "dni_valido") and got["030000001"] == ("30000001", "dni_valido")
    assert got["000000"] == ("0", "dni_valido") and got[" 30000001 "] == ("30000001", "dni_valido")
    assert got["12345"][1] == "texto_o_corto" and got["12345678901"][1] == "resto_no_brindo"


def test_first_closed_row_is_known_before_its_outcome(spark, monkeypatch):
    """Outcomes are worked out for one row an incident, not for every closed row."""
    rows = []
    real = history.outcome_columns
    monkeypatch.setattr(history, "outcome_columns", lambda df, **k: (rows.append(df.count()), real(df, **k))[1])
    schema = "id_suceso string, _seq long, estado string, fecha_fin string, cierre_supervisor string, resultado string"
    export = spark.createDataFrame([("a", 5, "CERRADO", "2024-01-02", None, "Mendicidad"), ("a", 2, " cerrado", None, None, "zzz"),
                                    ("a", 1, "PENDIENTE", None, None, "x"), ("b", 3, "CERRADO", None, None, "y")], schema)
    past = spark.createDataFrame([("a", "PENDIENTE"), ("b", "CERRADO")], "id_suceso string, estado string")
    out = history.reconcile_updates(export, past).collect()
    assert rows == [1] and [(r.id_suceso, r.estado, r.cierre_texto) for r in out] == [("a", " cerrado", "zzz")]


def test_each_step_of_a_row_is_in_the_plan_once(spark):
    """Spark works out an expression as often as it stands in branches and lambdas."""
    from casework.operators.geo import assign_zone
    df = spark.createDataFrame([("a", "1.5", "2.5")], "t string, longitud string, latitud string")
    names = _plan(df.select(text.clean_name(F.col("t")).alias("o")))
    assert names.count("translate(") == 1 and names.count("regexp_replace(") == 2
    outcome = _plan(cat.with_clean_outcome(df, "t", "o"))
    assert outcome.count("translate(") == 1 and outcome.count("lower(") == 1
    assert _plan(assign_zone(df)).count("filter(_zones") == 1


def test_outcome_step_equals_the_column(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS + NAMES], "t string")
    rows = cat.with_clean_outcome(df, "t", "a").select("t", "a", plain_outcome(F.col("t")).alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]


def test_numbers_are_read_once(spark):
    from casework.functions.scalars import to_district
    given = ["1.5", " 2,5 ", "NaN", "nan", "+nan", "-inf", "Infinity", "12d", "1e400", "", " ", "abc", None]
    df = spark.createDataFrame([(g,) for g in given], "t string").select("t", to_district(F.col("t")).alias("d"))
    inf = float("inf")
    assert [r.d for r in df.collect()] == [1.5, 2.5, None, None, None, -inf, inf, None, inf, None, None, None, None]
    assert _plan(df).count("try_cast(") == 1
    assert spark.range(1).select(to_district(F.lit(float("nan")))).first()[0] is None
