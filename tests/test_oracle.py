"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    import __spark_entry__ as entry
    from tests_support import duck
    return entry.queries(), entry.oracle_sql(), duck(SF)


def _names():
    import __spark_entry__ as entry
    return sorted(entry.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, oracle, name):
    from tests_support import frame_hash, to_pandas_spark
    qs, sql, con = oracle
    got = to_pandas_spark(qs[name](spark, SF))
    if name not in sql:
        assert len(got) > 0 and not got.isna().all(axis=None)
        return
    want = con.execute(sql[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want.astype(object).where(want.notna(), None))


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert "tipo_evolucion" in df.columns


@pytest.mark.parametrize("name", ["weekly_totals_by_zone", "weekly_stream_counts", "watermark_filter",
                                  "orders_weekly_reindex"])
def test_week_buckets_ignore_session_time_zone(spark, oracle, name):
    from tests_support import frame_hash, to_pandas_spark
    qs, sql, con = oracle
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Argentina/Buenos_Aires")
    try:
        got = to_pandas_spark(qs[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = con.execute(sql[name]).df()
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want.astype(object).where(want.notna(), None))
