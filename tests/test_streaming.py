"""Structured Streaming runs: one landing drop per micro-batch."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from casework.plans import catalog
from casework.sources.adapter import load_table
from casework.streaming.evolution import evolution_stream

SF = "/root/testdata/sf0.001"


def test_two_drops_equal_two_weekly_runs(spark):
    events = load_table(spark, SF, "events")
    cut = events.select(F.date_sub(F.max(F.date_trunc("week", "ts")).cast("date"), 7)).first()[0]
    landing = tempfile.mkdtemp(prefix="run-landing-")
    events.filter(F.col("ts") < F.lit(cut)).coalesce(1).write.parquet(os.path.join(landing, "d1"))
    time.sleep(1.1)  # the second drop lands later
    events.filter(F.col("ts") >= F.lit(cut)).coalesce(1).write.parquet(os.path.join(landing, "d2"))
    out = evolution_stream(spark, landing + "/*", source_file="*.parquet", files_per_trigger=1,
                           schema=events.schema)
    got = {r._seq: (r.tipo_evolucion, r.apariciones) for r in out.collect()}
    want = {r._seq: (r.tipo_evolucion, r.apariciones) for r in catalog.labeled(spark, SF).collect()}
    assert got == want


def test_restart_with_same_checkpoint_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="run-stream-root-")
    first = {r._seq: (r.tipo_evolucion, r.apariciones) for r in evolution_stream(spark, SF, root=root).collect()}
    again = evolution_stream(spark, SF, root=root)  # same checkpoint: no new files, same output
    assert {r._seq: (r.tipo_evolucion, r.apariciones) for r in again.collect()} == first
    assert again.count() == len(first)


def test_stream_runs_every_tier(spark):
    from casework.functions import rules
    from casework.functions.fuzzy import best_match
    from casework.operators.categorize import CLEAN_LABELS
    out = evolution_stream(spark, SF)
    got = {(r.texto_limpio, r.categoria_final) for r in out.select("texto_limpio", "categoria_final").distinct().collect()}
    by_rules = {r.texto_limpio: r.categoria_final for r in catalog.q_category_rules(spark, SF).collect()}
    near = 0
    for text, category in got:
        if text and by_rules.get(text) == rules.NO_MATCH and text not in {**rules.TIER0_EXACT, **rules.TIER1_EXACT}:
            i, score = best_match(text, CLEAN_LABELS)
            assert category == (rules.CANONICAL_CATEGORIES[i] if score >= rules.FUZZY_ACCEPT_SCORE else rules.NO_MATCH)
            near += category != rules.NO_MATCH
    assert near > 0
