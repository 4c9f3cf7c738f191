"""Outcome categorisation tiers (FIXTURES section 6) and the fuzzy scorer."""

from pyspark.sql import functions as F

from casework.functions import fuzzy
from casework.operators.categorize import categorize, outcome_columns, remap_raw_outcomes, value_distribution

TIER_ROWS = [
    ("01 traslado efectivo a cis", "01. Traslado efectivo a CIS"),
    ("positivo", "sin_match"),
    ("derivacion a red", "error de soflex"),
    ("17 dipa derivacion a cis", "01. Traslado efectivo a CIS"),
    ("16 dipa entrega de insumos servicios 7 positivo entrega de insumos", "sin_match"),
    ("se activa protocolo de salud mental hoy", "13. Derivación a SAME por salud mental"),
    ("se llama a same", "12. Derivación a SAME por deterioro físico visible"),
    ("rechaza entrevista y se retira del lugar", "07. Se realiza entrevista y se retira del lugar"),
    ("", "sin_match"),
    # " same" (leading space) misses text starting with "same"; the fuzzy
    # tier then accepts it through the shared token (85.5 >= 80)
    ("same llamado", "12. Derivación a SAME por deterioro físico visible"),
    ("zzzz qqqq", "sin_match"),
    ("traslado efectivo a lugar de orgen", "05. Traslado efectivo a lugar de origen"),
]


def test_tiers_with_fuzzy(spark):
    df = spark.createDataFrame([(a,) for a, _ in TIER_ROWS], "texto_limpio string")
    got = {r.texto_limpio: r.categoria_final for r in categorize(df).collect()}
    assert got == dict(TIER_ROWS)


def test_tiers_without_fuzzy(spark):
    df = spark.createDataFrame([("traslado efectivo a lugar de orgen",), ("salud mental",), ("same llamado",)],
                               "texto_limpio string")
    got = {r.texto_limpio: r.categoria_final for r in categorize(df, fuzzy=False).collect()}
    assert got == {"traslado efectivo a lugar de orgen": "sin_match", "same llamado": "sin_match",
                   "salud mental": "13. Derivación a SAME por salud mental"}


def test_outcome_columns_supervisor_first_and_placeholders(spark):
    df = spark.createDataFrame([("N/A", "15-Sin cubrir"), ("18. Mendicidad", "19. Sin cubrir"), ("-", None)],
                               "cierre_supervisor string, resultado string")
    out = outcome_columns(df, fuzzy=False).collect()
    assert [(r.cierre_texto, r.categoria_final, r.nivel_contacto, r.contacto) for r in out] == [
        ("15-Sin cubrir", "19. Sin cubrir", "Sin cubrir", "Sin cubrir"),
        ("18. Mendicidad", "18. Mendicidad", "Se contacta", "Contacta"),
        (None, "sin_match", "Sin dato", "Derivaciones/seguimientos")]


def test_remap_and_audit(spark):
    df = spark.createDataFrame(
        [("NEGATIVO", "2025-12-31 10:00:00"), ("NEGATIVO", "2026-01-02 10:00:00"), ("15-Sin cubrir", "2025-01-01 00:00:00")],
        "resultado string, f string").withColumn("fecha_inicio", F.col("f").cast("timestamp_ntz"))
    out = remap_raw_outcomes(df).collect()
    assert [r.resultado for r in out] == ["NEGATIVO", None, "19. Sin cubrir"]
    dist = {r.value: (r.n, r.share) for r in value_distribution(df, "resultado").collect()}
    assert dist == {"NEGATIVO": (2, round(2 / 3, 6)), "15-Sin cubrir": (1, round(1 / 3, 6))}


def test_fuzzy_scorer_basics():
    assert fuzzy.ratio("abc", "abc") == 100.0
    assert round(fuzzy.ratio("kitten", "sitting"), 4) == round(200 * 4 / 13, 4)
    assert fuzzy.partial_ratio("vacio", "13 derivacion a same") == 100.0
    assert fuzzy.token_set_ratio("a b c", "c b a") == 100.0
    # a shared token gives partial_token_ratio 100 -> 0.95 * 0.9 * 100 for a long label
    assert round(fuzzy.weighted_ratio("ab mendicidad", "18 mendicidad infantil en la via publica"), 2) == 85.5
    assert fuzzy.weighted_ratio("", "x") == 0.0
    i, s = fuzzy.best_match("zzzz qqqq", ["01 traslado efectivo a cis", "18 mendicidad"])
    assert s < 80


def test_fuzzy_join_fallback_equals_broadcast_path(spark):
    df = spark.createDataFrame([(a,) for a, _ in TIER_ROWS] * 3, "texto_limpio string")
    small = sorted(map(tuple, categorize(df).collect()))
    large = sorted(map(tuple, categorize(df, max_broadcast_rows=0).collect()))
    assert small == large


def test_fuzzy_scorer_documented_examples():
    # examples from the public documentation of the weighted-ratio scorer
    assert round(fuzzy.ratio("this is a test", "this is a test!"), 6) == round(96.55172413793103, 6)
    assert fuzzy.partial_ratio("this is a test", "this is a test!") == 100.0
    assert fuzzy.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100.0
    assert fuzzy.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100.0
    assert round(fuzzy.weighted_ratio("this is a test", "this is a new test!!!"), 6) == 85.5


def _near_texts(n, seed=1):
    import random
    from casework.operators.categorize import CLEAN_LABELS
    draw, out = random.Random(seed), []
    words = sorted({w for lab in CLEAN_LABELS for w in lab.split()})
    for _ in range(n):
        text = list(draw.choice(CLEAN_LABELS))
        for _ in range(draw.randint(0, 9)):
            at = draw.randrange(len(text) + 1)
            text[at:at + draw.randint(0, 1)] = draw.choice(["", "a", " ", "x", "ab"])
        out += [" ".join("".join(text).split()), " ".join(draw.choice(words) for _ in range(draw.randint(1, 9))),
                "".join(draw.choice("abcde  ") for _ in range(draw.randint(0, 30)))]
    return out


def test_near_match_bound_is_never_below_the_score():
    from casework.operators.categorize import CLEAN_LABELS
    for text in _near_texts(60):
        for lab in CLEAN_LABELS:
            assert fuzzy.weighted_bound(text, lab) >= fuzzy.weighted_ratio(text, lab) - 1e-9, (text, lab)


def test_batch_scoring_equals_one_by_one():
    from casework.operators.categorize import CLEAN_LABELS
    texts = _near_texts(50, seed=2)
    want = [fuzzy.best_match(t, CLEAN_LABELS) for t in texts]
    assert fuzzy.best_matches(texts, CLEAN_LABELS, 80.0, fuzzy.SCORERS["weighted/1"]) == [w if w[1] >= 80 else (-1, 0.0) for w in want]
    assert 20 < sum(w[1] >= 80 for w in want) < len(want)


def test_lcs_of_many_pairs():
    import random
    draw = random.Random(3)
    word = lambda signs: "".join(draw.choice(signs) for _ in range(draw.choice([0, 1, 5, 63, 64, 65, 90])))
    pairs = [(word("abé"), word("abcd漢")) for _ in range(800)]
    assert fuzzy.lcs_many(pairs) == [fuzzy._lcs(a, b) for a, b in pairs]


def test_scorer_is_swappable_and_named(spark):
    df = spark.createDataFrame([("traslado efectivo a lugar de orgen",), ("vacio",), ("19 sin cubrir",)], "texto_limpio string")
    got = {r.texto_limpio: (r.categoria_final, r.s) for r in categorize(df, scorer_col="s").collect()}
    assert got["vacio"][1] == "weighted/1" and got["19 sin cubrir"][1] is None
    plain = {r.texto_limpio: (r.categoria_final, r.s) for r in categorize(df, scorer="indel/1", scorer_col="s").collect()}
    assert plain["vacio"] == ("sin_match", None)
    assert plain["traslado efectivo a lugar de orgen"] == ("05. Traslado efectivo a lugar de origen", "indel/1")
