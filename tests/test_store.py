"""Versions of the store: what a commit writes, and two writers at once."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerscope.plans import store
from ledgerscope.schemas import TABLES


def cities(spark, slug):
    row = spark.range(1).select(F.lit(slug).alias("slug"))
    schema = TABLES["cities"].schema
    return row.select(*[F.lit(slug).cast(f.dataType).alias(f.name) if f.name == TABLES["cities"].names[0] else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def first(spark, root):
    return [r[0] for r in store.read(spark, root, "cities").collect()]


def test_unchanged_tables_are_carried_over(spark, tmp_path):
    root = str(tmp_path)
    assert store.current(spark, root) == (0, None) and first(spark, root) == []
    one = store.publish(spark, root, {"cities": cities(spark, "a")})
    two = store.publish(spark, root, {"suppliers": store.read(spark, root, "suppliers")})
    assert os.listdir(tmp_path / one) == ["cities"] and os.listdir(tmp_path / two) == ["suppliers"]
    assert store.current(spark, root) == (2, two) and first(spark, root) == ["a"]
    store.publish(spark, root, {"cities": cities(spark, "b")})
    assert first(spark, root) == ["b"] and store.read(spark, root, "suppliers").count() == 0


def test_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store.publish(spark, root, {"cities": cities(spark, "a")})
    before = store._in_force(spark, root)
    store.publish(spark, root, {"cities": cities(spark, "b")})
    seen, real = [before], store._in_force
    monkeypatch.setattr(store, "_in_force", lambda *a: seen.pop() if seen else real(*a))
    with pytest.raises(store.Conflict):
        store.publish(spark, root, {"cities": cities(spark, "c")})
    assert first(spark, root) == ["b"]


def test_a_commit_that_failed_is_written_over(spark, tmp_path):
    os.makedirs(tmp_path / "versions" / "number=1")
    store.publish(spark, str(tmp_path), {"cities": cities(spark, "a")})
    assert first(spark, str(tmp_path)) == ["a"]
