"""Merges by bucket, versions made at the same time, and what is left of old ones."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerscope.operators.merge import first_wins, last_wins
from ledgerscope.plans import store
from ledgerscope.schemas import TABLES

EVENTS = TABLES["revenue_events"]


def events(spark, rows):
    """(event_key, agency_name, seq) as events; a null key has no event_key's part of the key, city_slug."""
    frame = spark.createDataFrame(rows, "event_key string, agency_name string, seq long")
    fixed = {n: F.lit("x") for n in EVENTS.required if n != "event_key"}
    columns = [fixed.get(n, F.lit(None).cast(EVENTS.schema[n].dataType)).alias(n) for n in EVENTS.names if n not in ("event_key", "agency_name")]
    return frame.select("event_key", "agency_name", *columns, "seq")


def suppliers(spark, rows):
    """(document, name, seq) as suppliers."""
    frame = spark.createDataFrame(rows, "document string, name string, seq long")
    table = TABLES["suppliers"]
    fixed = {n: F.lit("x") for n in table.required}
    return frame.select("name", *[fixed.get(n, F.lit(None).cast("string")).alias(n) if n != "document" else F.col(n) for n in table.names if n != "name"], "seq")


def folders(root):
    return store._in_force(*root)[2]


def seen(spark, root, table, columns):
    return sorted(map(tuple, store.read(spark, root, table).select(*columns).collect()), key=repr)


def files(root, name, table):
    return sorted(n for n in os.listdir(f"{root}/{name}/{table}") if n.startswith("bucket="))


def test_ten_rows_rewrite_their_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    many = [(f"k{i}", "old", i) for i in range(3000)]
    store.merge(spark, root, {"revenue_events": store.Last(events(spark, many))})
    before = store._in_force(spark, root)[2]["revenue_events"]
    assert before["buckets"] == store.BUCKETS == len(before["parts"])
    few = [(f"k{i}", "new", i) for i in range(0, 50, 10)] + [(f"n{i}", "new", i) for i in range(5)]
    name, counts = store.merge(spark, root, {"revenue_events": store.Last(events(spark, few))})
    touched = {r[0] for r in events(spark, few).select(store.bucket_of("revenue_events", store.BUCKETS)).distinct().collect()}
    after = store._in_force(spark, root)[2]["revenue_events"]["parts"]
    assert counts == {"revenue_events": 10} and 0 < len(touched) < store.BUCKETS
    assert files(root, name, "revenue_events") == sorted(f"bucket={b}" for b in touched)
    assert {int(b) for b in after if after[b] != before["parts"].get(b)} == touched
    want = {k: v for k, v, _ in many} | {k: v for k, v, _ in few}
    assert seen(spark, root, "revenue_events", ["event_key", "agency_name"]) == sorted(want.items(), key=repr)


def test_first_wins_adds_what_is_new_and_reads_no_other_bucket(spark, tmp_path):
    root = str(tmp_path)
    many = [(f"d{i}", "old", i) for i in range(500)] + [(None, "loose", 1), (None, "loose", 1)]
    loose = suppliers(spark, many).filter("document is null")
    assert loose.count() == 2  # document is required: such rows are left out, in SQL and here
    store.merge(spark, root, {"suppliers": store.First(suppliers(spark, many))})
    before = store._in_force(spark, root)[2]["suppliers"]["parts"]
    few = [("d1", "late", 0), ("e1", "second", 2), ("e1", "first", 1)]
    name, _ = store.merge(spark, root, {"suppliers": store.First(suppliers(spark, few))})
    after = store._in_force(spark, root)[2]["suppliers"]["parts"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert len(changed) == 1 and after[changed[0]] == before[changed[0]] + [name]
    assert seen(spark, root, "suppliers", ["document", "name"]) == sorted({f"d{i}": "old" for i in range(500)}.items() | {("e1", "first")}, key=repr)
    again, counts = store.merge(spark, root, {"suppliers": store.First(suppliers(spark, few))})
    assert counts == {"suppliers": 3} and store._in_force(spark, root)[2]["suppliers"]["parts"] == after


@pytest.mark.parametrize("last", [False, True])
def test_merges_are_what_whole_tables_give(spark, tmp_path, last):
    root, table = str(tmp_path), TABLES["procurements"]
    kept = None
    for batch in range(3):
        rows = [(None if i % 7 == 0 else f"c{(i * (batch + 3)) % 40}", f"b{batch}r{i}", i % 11 * 100 + i) for i in range(60)]
        frame = spark.createDataFrame(rows, "pncp_control_number string, object string, seq long")
        frame = frame.select(*[F.col(n) if n in frame.columns else F.lit("x" if n in table.required else None).cast(table.schema[n].dataType).alias(n) for n in table.names], "seq")
        store.merge(spark, root, {"procurements": (store.Last if last else store.First)(frame)})
        kept = (last_wins if last else first_wins)(frame, table, "seq", kept)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        assert seen(spark, root, "procurements", table.names) == sorted(map(tuple, kept.collect()), key=repr)


def test_a_row_without_a_required_column_fails_the_merge(spark, tmp_path):
    with pytest.raises(Exception, match="NOT NULL constraint: event_key"):
        store.merge(spark, str(tmp_path), {"revenue_events": store.Last(events(spark, [(None, "x", 1)]))})
    assert store.current(spark, str(tmp_path)) == (0, None)


def test_two_threads_fifty_versions_no_update_lost(spark, tmp_path):
    root, problems = str(tmp_path), []

    def commit(who):
        try:
            for i in range(25):
                while True:  # compare and swap alone: a version that adds one folder to what is there
                    number, _, tables = store._in_force(spark, root)
                    parts = tables.get("cities", {"parts": {}})["parts"] | {str(who * 100 + i): [f"w{who}-{i}"]}
                    if store._swap(spark, root, number + 1, f"w{who}-{i}", {"cities": {"buckets": 16, "parts": parts}}):
                        break
        except Exception as problem:
            problems.append(problem)

    threads = [threading.Thread(target=commit, args=(who,)) for who in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not problems
    number, _, tables = store._in_force(spark, root)
    assert number == 50 and len(tables["cities"]["parts"]) == 50 and os.listdir(f"{root}/versions").__len__() == 50


def test_merges_at_the_same_time_lose_nothing(spark, tmp_path):
    root, problems = str(tmp_path), []

    def work(who):
        try:
            for i in range(4):
                rows = [(f"{who}-{i}-{k}", who, k) for k in range(5)] + [("shared", f"{who}{i}", 1)]
                store.merge(spark, root, {"revenue_events": store.Last(events(spark, rows)), "suppliers": store.First(suppliers(spark, rows))})
        except Exception as problem:
            problems.append(problem)

    threads = [threading.Thread(target=work, args=(who,)) for who in ("a", "b")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not problems and store.current(spark, root)[0] == 8
    for table, key in (("revenue_events", "event_key"), ("suppliers", "document")):
        keys = [r[0] for r in store.read(spark, root, table).select(key).collect()]
        assert sorted(keys) == sorted([f"{w}-{i}-{k}" for w in "ab" for i in range(4) for k in range(5)] + ["shared"])


def test_a_merge_is_taken_over_or_made_again(spark, tmp_path, monkeypatch):
    """Another writer's version appears between the merge and its commit."""
    root = str(tmp_path)
    store.merge(spark, root, {"revenue_events": store.Last(events(spark, [(f"k{i}", "old", i) for i in range(200)]))})
    real, others, runs, merged = store._swap, ["k1", "k2"], [], store._merged

    def interrupted(*commit):
        monkeypatch.setattr(store, "_swap", real)
        store.merge(spark, root, {"revenue_events": store.Last(events(spark, [(others.pop(0), "other", 1)]))})
        if others:
            monkeypatch.setattr(store, "_swap", interrupted)
        return real(*commit)

    monkeypatch.setattr(store, "_swap", interrupted)
    monkeypatch.setattr(store, "_merged", lambda *a: (runs.append(a[3]), merged(*a))[1])
    name, _ = store.merge(spark, root, {"revenue_events": store.Last(events(spark, [("k1", "mine", 5)]))})
    rows = dict(seen(spark, root, "revenue_events", ["event_key", "agency_name"]))
    assert rows["k1"] == "mine" and rows["k2"] == "other" and len(rows) == 200
    buckets = [r[0] for r in events(spark, [("k1", "", 1), ("k2", "", 2)]).select(store.bucket_of("revenue_events", store.BUCKETS)).collect()]
    assert runs.count(name) == (3 if buckets[0] == buckets[1] else 2)  # taken over as it is where its buckets were left alone


def test_lookup_compact_and_clean(spark, tmp_path):
    root = str(tmp_path)
    for i in range(6):
        store.merge(spark, root, {"suppliers": store.First(suppliers(spark, [(f"d{i}-{k}", "n", k) for k in range(40)]))})
    rows = seen(spark, root, "suppliers", ["document"])
    keys = spark.createDataFrame([("x", "d3-7", "x"), ("x", "nobody", "x")], "city_slug string, document string, source_system string")
    found = store.lookup(spark, root, "suppliers", keys)
    assert [r["document"] for r in found.collect()] == ["d3-7"] and len(found.inputFiles()) < len(store.read(spark, root, "suppliers").inputFiles())
    assert store.compact(spark, root, "suppliers", most=2) and store.compact(spark, root, "suppliers", most=2) is None
    assert seen(spark, root, "suppliers", ["document"]) == rows
    assert store.compact(spark, root, "suppliers", buckets=4) and len(folders((spark, root))["suppliers"]["parts"]) == 4
    assert seen(spark, root, "suppliers", ["document"]) == rows
    assert store.clean(spark, root, keep=1) == []  # all folders are young
    gone = store.clean(spark, root, keep=1, older_than=-60)
    kept = [n for n in os.listdir(root) if n.startswith("v") and n != "versions"]
    assert len(gone) == 7 and len(kept) == 1 and seen(spark, root, "suppliers", ["document"]) == rows
    store.merge(spark, root, {"suppliers": store.First(suppliers(spark, [("new", "n", 1)]))})
    assert store.current(spark, root)[0] == 9 and len(seen(spark, root, "suppliers", ["document"])) == 241


def test_offered_rows_are_scanned_once(spark, tmp_path):
    path, reads = str(tmp_path / "in"), spark.sparkContext.accumulator(0)
    events(spark, [(f"k{i}", "v", i) for i in range(50)]).write.parquet(path)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path)
    rows = rows.mapInArrow(counted, rows.schema)
    assert store.merge(spark, str(tmp_path / "s"), {"revenue_events": store.Last(rows)})[1] == {"revenue_events": 50}
    assert reads.value == 50
