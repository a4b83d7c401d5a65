import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import concentration, merge
from ledgerscope.schemas import TABLES, Table

T = Table((("k", "text"), ("req", "text"), ("v", "int")), ("k",), ("req",))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, req string, v long, seq long")


def values(df):
    return sorted(((r["k"], r["req"], r["v"]) for r in df.collect()), key=repr)


def test_first_wins_keeps_the_earliest_and_all_null_keys(spark):
    new = frame(spark, [("a", "x", 2, 2), ("a", "x", 1, 1), (None, "x", 5, 3), (None, "x", 5, 4), ("b", None, 9, 0)])
    assert values(merge.first_wins(new, T, "seq")) == [("a", "x", 1), (None, "x", 5), (None, "x", 5)]


def test_first_wins_prefers_stored_rows(spark):
    stored = frame(spark, [("a", "old", 0, 0), (None, "old", 0, 0)]).drop("seq")
    new = frame(spark, [("a", "x", 1, 1), ("b", "x", 2, 2), (None, "x", 3, 3)])
    assert values(merge.first_wins(new, T, "seq", stored)) == [("a", "old", 0), ("b", "x", 2), (None, "old", 0), (None, "x", 3)]


def test_last_wins_replaces_whole_rows(spark):
    stored = frame(spark, [("a", "old", 7, 0), ("c", "old", 8, 0)]).drop("seq")
    new = frame(spark, [("a", "x", 1, 1), ("a", "y", None, 2), (None, "x", 3, 3)])
    assert values(merge.last_wins(new, T, "seq", stored)) == [("a", "y", None), ("c", "old", 8), (None, "x", 3)]


def test_last_wins_fails_without_a_required_column(spark):
    with pytest.raises(Exception, match="NOT NULL constraint: req"):
        merge.last_wins(frame(spark, [("a", None, 1, 1)]), T, "seq").collect()


def test_empty_tables(spark):
    none = frame(spark, [])
    assert merge.first_wins(none, T, "seq", none.drop("seq")).count() == 0
    assert merge.last_wins(none, T, "seq").count() == 0


def test_distinct_seen_falls_back_to_the_whole_row(spark):
    rows = frame(spark, [("n1", "x", 1, 1), ("n1", "y", 2, 0), ("", "x", 1, 2), ("", "x", 1, 3), (None, "x", 1, 4), ("", "z", 1, 5)])
    got = values(merge.distinct_seen(rows, "k", "seq").drop("seq"))
    assert got == [("", "x", 1), ("", "z", 1), ("n1", "y", 2), (None, "x", 1)]


def test_quarantine(spark):
    good, bad = merge.quarantine(frame(spark, [("a", "x", 1, 1), ("b", None, -1, 2)]), {"req": F.col("req").isNotNull(), "v": F.col("v") > 0})
    assert good.count() == 1 and bad.first()["failed"] == ["req", "v"]


def contracts(spark, rows):
    return spark.createDataFrame(rows, "city_slug string, supplier_document string, supplier_name string, global_value double")


def test_concentration(spark):
    rows = [("c", "1", "A", 75.0), ("c", "2", "B", 25.0), ("d", "1", "A", 1.0)]
    first = concentration.of_city(contracts(spark, rows), "c").collect()
    assert [(r["supplier_name"], r["share_of_known_value"]) for r in first] == [("A", 0.75), ("B", 0.25)]
    assert first[0]["label"] == "descriptive_concentration_not_irregularity"


def test_concentration_edges(spark):
    rows = [("c", None, "?", 50.0), ("c", "1", "A", 30.0), ("c", "1", "A2", 20.0), ("c", "3", "C", None)]
    got = [(r["supplier_name"], r["share_of_known_value"]) for r in concentration.of_city(contracts(spark, rows), "c").collect()]
    assert got == [("A", 0.3), ("A2", 0.2)]
    zero = concentration.of_city(contracts(spark, [("c", "1", "A", 5.0), ("c", "2", "B", -5.0)]), "c").collect()
    assert [r["share_of_known_value"] for r in zero] == [None, None]
    assert concentration.ranked(concentration.by_city(contracts(spark, rows))).filter("rank = 2").first()["running_share"] == 0.5


def test_schemas_have_their_keys():
    for name, table in TABLES.items():
        assert set(table.key) | set(table.required) <= set(table.names), name
    assert len(TABLES["procurements"].names) == 27 and len(TABLES["contracts"].names) == 36 and len(TABLES["expense_events"].names) == 28
