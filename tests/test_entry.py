"""The driver contract."""

import __spark_entry__ as entry


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["seg_id", "command_ha", "health", "bc_norm", "priority", "rank"] and df.count() > 0


def test_queries_and_sql_belong_together():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 140
