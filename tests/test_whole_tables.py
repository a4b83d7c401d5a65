"""Queries whose rows of the input all count."""

from datetime import datetime

from ledgerscope.plans import registry


def test_orders_of_any_date_are_in_a_window(spark, tmp_path):
    days = [datetime(1990, 3, 1), datetime(1995, 6, 1), datetime(2001, 8, 1, 23), datetime(2005, 12, 31), None]
    spark.createDataFrame([(i, d, 1.5) for i, d in enumerate(days)], "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    rows = sorted(registry.date_windows_rollup(spark, str(tmp_path)).collect())
    assert rows[0]["window_start"] == "1990-03-01" and rows[-1]["window_end"] == "2005-12-31"
    assert sum(r["orders"] for r in rows) == 4 and sum(r["total"] for r in rows) == 6.0


def test_every_event_is_merged(spark, tmp_path):
    rows = [(i, f"e{i}", i, float(i)) for i in range(-2, 12)] + [(99, "e", i, float(i)) for i in range(20, 26)]
    spark.createDataFrame(rows, "user_id long, event_type string, event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(r["event_id"] for r in registry.upsert_all_events(spark, str(tmp_path)).collect())
    assert got == [*range(-2, 12), 25]


def test_every_line_item_is_subtracted(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(1, 30)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i) for i in range(1, 29)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [r["o_orderkey"] for r in registry.order_gaps(spark, str(tmp_path)).collect()] == [29]


def test_payload_pages_are_bounded(spark, tmp_path, monkeypatch):
    spark.range(20_000).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    pages = []
    whole = registry.scope.active_modalities
    monkeypatch.setattr(registry.scope, "active_modalities", lambda payload: pages.append(payload) or whole(payload))
    assert sorted(r["id"] for r in registry.active_modalities(spark, str(tmp_path)).collect()) == [i for i in range(25) if i % 5]
    sizes = [r["payload"].count('"id"') for r in pages[0].collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 100
