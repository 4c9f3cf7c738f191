"""The report plans prune the week partitions of a stored history."""

import pytest
from pyspark.sql import functions as F

from casework.plans import catalog, reports

SF = "/root/testdata/sf0.001"
PRUNED = ["kpi_table", "contact_breakdown", "contact_breakdown_dashboard", "outcome_breakdown", "evolution_weekly",
          "evolution_report", "chart_payload", "report_week_range"]


@pytest.mark.parametrize("name", PRUNED)
def test_counts_read_only_the_weeks_of_the_axis(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert any("PartitionFilters" in s and "week" in s and ">=" in s.split("PartitionFilters")[1] for s in scans), plan


def test_partition_week_is_the_computed_week(spark):
    hist = catalog.labeled(spark, SF)
    stored = reports.prepare_dashboard(hist).select("_seq", reports.WEEK)
    computed = reports.prepare_dashboard(hist.drop("week")).select("_seq", reports.WEEK)
    assert stored.count() > 0
    assert stored.exceptAll(computed).isEmpty() and computed.exceptAll(stored).isEmpty()


def test_base_without_labels_gives_zeros(spark):
    base = reports.prepare_dashboard(catalog.labeled(spark, SF)).drop("tipo_evolucion")
    out = reports.dni_evolution(base, reports.dashboard_zones(), rest_zone="resto")
    row = out.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("nuevos") + F.col("recurrentes") + F.col("migratorios")).alias("s")).first()
    assert row["n"] > 0 and row["s"] == 0


def test_counts_above_the_int_range_format(spark):
    from casework.functions.scalars import pct_cell
    n = F.lit(3_000_000_000)
    assert spark.range(1).select(pct_cell(n, n)).first()[0] == "100% (3000000000)"
