"""The feed of the stored overview is written by as many tasks as the session's shuffles have."""

from datetime import datetime, timedelta
from pathlib import Path

from checks import registry


def test_feed_is_spread_over_tasks(spark, tmp_path, monkeypatch):
    days = [datetime(1995, 12, 20) + timedelta(days=k) for k in range(40)]
    lines = [(k, 1, 1, 5.0, 100.0, 0.01, day) for k, day in enumerate(days, start=1)]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double"
    spark.createDataFrame(lines, f"{names}, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k, "1-URGENT") for k in range(1, 41)]
    schema = "o_orderkey long, o_custkey long, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(registry, "new_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    found = registry.queries()["daily_overview_stored"](spark, str(tmp_path)).collect()
    assert [(r["date"], r["sessions"]) for r in found] == [(day.date(), 1) for day in reversed(days[-10:])]
    files = list(Path(f"{tmp_path}/stored-overview/feed").glob("*.parquet"))
    assert len(files) == 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
