"""Outcome categorisation (C01-C09) as Spark plans.

Tiers 0-2 are evaluated inline per row as native expressions: two literal
map lookups (exact tiers) and one ordered ``when`` chain of ``contains``
(substring tier).  No join, no shuffle, inside codegen.

Tier 3 (fuzzy) is the only Python: it runs on the *distinct* texts left
unmatched by tiers 0-2 (dictionary encoding of the work), through an Arrow
``pandas_udf`` that scores a whole batch at once, and is joined back.  The scored table is materialised to
the checkpoint folder and counted; it is broadcast only under a row bound,
otherwise the unmatched rows alone take a shuffle join.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions import rules
from casework.functions.fuzzy import DEFAULT_SCORER, SCORERS, best_matches, clean_label
from casework.functions.scalars import contact_and_data, contact_level, lookup
from casework.functions.text import placeholder_to_null, strip_blanks, with_clean_outcome
from casework.operators.joins import DEFAULT_BROADCAST_ROWS, materialize_checked

CLEAN_LABELS = [clean_label(c) for c in rules.CANONICAL_CATEGORIES]


def exact_tier(text: Column) -> Column:
    """C01 + C02: tier 0 map, then tier 1 map."""
    return F.coalesce(lookup(rules.TIER0_EXACT, text), lookup(rules.TIER1_EXACT, text))


def substring_tier(text: Column) -> Column:
    """Ordered substring rules, first hit wins; null when none hits."""
    expr = None
    for pattern, category in rules.TIER2_SUBSTRING:
        cond = text.contains(pattern)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr


def rule_category(t: Column) -> Column:
    """C05 without the fuzzy tier over an already stripped text: blank ->
    sin_match, tiers 0-2, else null."""
    return (F.when(t.isNull() | (t == ""), F.lit(rules.NO_MATCH))
            .otherwise(F.coalesce(exact_tier(t), substring_tier(t))))


def fuzzy_category(scorer: str = DEFAULT_SCORER):
    """Best canonical label by the named scorer, accepted at >= 80."""
    @F.pandas_udf(T.StringType())
    def categories(texts: pd.Series) -> pd.Series:
        found = best_matches(texts.tolist(), CLEAN_LABELS, rules.FUZZY_ACCEPT_SCORE, SCORERS[scorer])
        return pd.Series([rules.CANONICAL_CATEGORIES[i] if i >= 0 else rules.NO_MATCH for i, _ in found], dtype=object)
    return categories


def fuzzy_table(ruled: DataFrame, scorer: str = DEFAULT_SCORER) -> DataFrame:
    """Distinct texts unmatched by tiers 0-2 with their fuzzy category.

    Whether a tier matched is carried through the distinct as an aggregate
    value so that the "unmatched" filter stays above the aggregation: a filter
    on the grouping key would be pushed down to every input row with the whole
    text-cleaning expression inlined into each rule branch.  It is a flag, not
    the category: an aggregate that holds a text would sort all rows."""
    return (ruled.groupBy(F.col("_t").alias("_fz_text"))
                 .agg(F.max(F.col("_rule").isNull()).alias("_open"))
                 .filter("_open")
                 .select("_fz_text", fuzzy_category(scorer)("_fz_text").alias("_fz_cat")))


def with_rules(df: DataFrame, text_col: str) -> DataFrame:
    """The stripped text ``_t`` and what tiers 0-2 make of it, ``_rule``."""
    return (df.select("*", strip_blanks(F.col(text_col)).alias("_t"))
              .select("*", rule_category(F.col("_t")).alias("_rule")))


def categorize(df: DataFrame, text_col: str = "texto_limpio", out_col: str = "categoria_final",
               fuzzy: bool = True, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               scorer: str = DEFAULT_SCORER, scorer_col: str | None = None, texts: DataFrame | None = None) -> DataFrame:
    """Tiers 0-3 over ``text_col`` (already cleaned by F02).  ``scorer``
    names the near-match scorer; ``scorer_col`` adds its name, with version,
    to the rows that it decided (null elsewhere).  ``texts``: rows whose
    ``text_col`` takes every value of ``df``'s, where these cost less to read
    than ``df``; tier 3 takes its distinct texts from there."""
    ruled = with_rules(df, text_col)
    if not fuzzy:
        return ruled.withColumn(out_col, F.coalesce("_rule", F.lit(rules.NO_MATCH))).drop("_rule", "_t")
    open_texts = ruled if texts is None else with_rules(texts.select(text_col).distinct(), text_col)
    table, small = materialize_checked(fuzzy_table(open_texts, scorer), max_broadcast_rows)
    key = F.col("_t")
    if small:
        joined = ruled.join(F.broadcast(table), key == F.col("_fz_text"), "left")
    else:
        matched = ruled.filter(F.col("_rule").isNotNull())
        rest = ruled.filter(F.col("_rule").isNull()).join(table, key == F.col("_fz_text"), "left")
        joined = matched.unionByName(rest, allowMissingColumns=True)
    if scorer_col:
        decided = F.col("_rule").isNull() & (F.col("_fz_cat") != rules.NO_MATCH)
        joined = joined.withColumn(scorer_col, F.when(decided, F.lit(scorer)))
    return (joined.withColumn(out_col, F.coalesce("_rule", "_fz_cat", F.lit(rules.NO_MATCH)))
            .drop("_rule", "_t", "_fz_text", "_fz_cat"))


def outcome_columns(df: DataFrame, fuzzy: bool = True, apply_placeholders: bool = True,
                    texts: DataFrame | None = None) -> DataFrame:
    """Outcome half of C06 (also C07 when ``apply_placeholders`` is False):
    P04 placeholders, P05 supervisor-else-result, F02, C05, F09, F10.
    ``texts``: rows with both outcome texts of every row of ``df``, where these
    cost less to read (see ``categorize``)."""
    sup, res = F.col("cierre_supervisor"), F.col("resultado")
    if apply_placeholders:
        sup = placeholder_to_null(sup, rules.PLACEHOLDER_VALUES)
        res = placeholder_to_null(res, rules.PLACEHOLDER_VALUES)
    chosen = F.coalesce("cierre_supervisor", "resultado")
    out = df.withColumns({"cierre_supervisor": sup, "resultado": res}).withColumn("cierre_texto", chosen)
    out = with_clean_outcome(out, "cierre_texto", "texto_limpio")
    if texts is not None:  # each raw text is cleaned once
        texts = (texts.select(sup.alias("cierre_supervisor"), res.alias("resultado"))
                      .select(chosen.alias("cierre_texto")).distinct())
        texts = with_clean_outcome(texts, "cierre_texto", "texto_limpio")
    out = categorize(out, "texto_limpio", "categoria_final", fuzzy=fuzzy, texts=texts)
    pair = contact_and_data(F.col("categoria_final"))
    return out.withColumns({"nivel_contacto": contact_level(F.col("categoria_final")),
                            "contacto": pair["contacto"], "brinda_datos": pair["brinda_datos"]})


# -- one-time migration (C08, C09) ------------------------------------------

def remap_raw_outcomes(df: DataFrame, date_col: str = "fecha_inicio", col: str = "resultado",
                       nullify_from: str = rules.REMAP_NULLIFY_FROM) -> DataFrame:
    """Rename legacy raw values everywhere; values mapped to None are
    nulled only for rows on/after the cutoff date."""
    renames = {k: v for k, v in rules.RAW_OUTCOME_REMAP.items() if v is not None}
    nullify = [k for k, v in rules.RAW_OUTCOME_REMAP.items() if v is None]
    c = F.col(col)
    return df.withColumn(
        col,
        F.when(c.isin(nullify) & (F.col(date_col) >= F.lit(nullify_from).cast("timestamp_ntz")),
               F.lit(None).cast("string"))
         .otherwise(F.coalesce(lookup(renames, c), c)))


def value_distribution(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Count per value with share of the total, descending;
    ``top`` keeps the head of the audit (the feature itself)."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()  # scalar subquery, no single-partition window
    out = counts.withColumn("share", F.round(F.col("n") / total, 6))
    if top is not None:
        out = out.orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(top)
    return out


def distribution_diff(before: DataFrame, after: DataFrame, col: str, top: int = 30) -> DataFrame:
    """Counts per value before and after, side by side; the ``top``
    values by the larger count (the feature itself)."""
    was = before.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n_before"))
    now = after.groupBy(F.col(col).alias("value_after")).agg(F.count(F.lit(1)).alias("n_after"))
    both = was.join(now, F.col("value").eqNullSafe(F.col("value_after")), "full")
    n_before, n_after = F.coalesce("n_before", F.lit(0)), F.coalesce("n_after", F.lit(0))
    # a null value of one side alone has a count there and none here
    value = F.when(F.col("n_before").isNotNull(), F.col("value")).otherwise(F.col("value_after"))
    return (both.select(value.alias("value"), n_before.cast("long").alias("n_before"), n_after.cast("long").alias("n_after"))
            .withColumn("change", F.col("n_after") - F.col("n_before"))
            .orderBy(F.desc(F.greatest("n_before", "n_after")), F.asc_nulls_first("value")).limit(top))
