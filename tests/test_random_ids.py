"""Ids: rows written by hand from the rule table, and properties that hold for
random ids, many to a Spark job."""

import random

import pytest
from pyspark.sql import functions as F

from casework.functions import rules
from casework.functions.identity import is_valid_id, with_id_category

ROWS = [
    (None, rules.NO_ID, "nan"),
    ("", rules.NO_ID, "empty"),
    (" \t ", rules.NO_ID, "empty"),
    ("xx", rules.NO_ID, "simbolos_o_letras_cortas"),
    ("aaab", rules.NO_ID, "solo_letras_repetidas"),
    ("30.111.222", "30111222", "dni_valido"),
    ("00123456", "123456", "dni_valido"),
    ("dni 30111222", "30111222", "dni_valido"),
    ("12345", rules.NO_ID, "texto_o_corto"),
    ("12345678901", rules.NO_ID, "resto_no_brindo"),
]


def categorised(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    out = with_id_category(df, "v", "cat", "reason").withColumn("ok", is_valid_id(F.col("cat")))
    return sorted(out.select("i", "v", "cat", "reason", "ok").collect())


def test_rows_of_the_rule_table(spark):
    got = categorised(spark, [v for v, _, _ in ROWS])
    assert [(r.v, r.cat, r.reason) for r in got] == ROWS


@pytest.mark.parametrize("seed", range(3))
def test_random_numbers_keep_their_digits(spark, seed):
    draw = random.Random(seed)
    values = ["".join(draw.choice("0123456789.- ") for _ in range(draw.randint(1, 16))) for _ in range(3000)]
    for r in categorised(spark, values):
        digits = "".join(c for c in r.v if c.isdigit())
        if r.reason == "dni_valido":
            assert 6 <= len(digits) <= 10 and r.cat == (digits.lstrip("0") or "0")
        else:
            assert r.cat == rules.NO_ID and not r.ok
            assert not 6 <= len(digits) <= 10 or r.reason == "simbolos_o_letras_cortas"


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_stay_within_the_vocabulary(spark, seed):
    draw = random.Random(100 + seed)
    values = ["".join(draw.choice("0123456789 .-xXaAbs*/nopreiadvlucm") for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    for r in categorised(spark, values):
        assert r.cat in (rules.NO_ID, rules.FOREIGN_ID) or (r.cat.isdigit() and len(r.cat) <= 10)
        if r.ok:
            assert len(r.cat) >= 6 and len(set(r.cat)) > 1 and r.cat not in rules.INVALID_ID_TEXTS
