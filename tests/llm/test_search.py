import math
import random

import duckdb
import numpy as np
import pytest
from conftest import SF

from ledgerscope.llm import registry, topk_search


def brute(rows, k, every):
    quant = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = tuple(math.floor(256 * x) for x in v)
            quant[i] = min(quant.get(i, q), q)
    out = []
    for i in [i for i in quant if i % every == 0]:
        score = sorted((-sum(a * b for a, b in zip(quant[i], w)), j) for j, w in quant.items() if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(score[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("options", [{}, {"block": 3, "shard_rows": 20, "chunk_rows": 2, "least_shard": 5}])
def test_against_brute_force(spark, options):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(r.choice([4, 4, 5]))]) for i in range(90)]
    rows += [(90, None), (91, [1.0, None, 2.0, 0.0]), (92, [float("nan")] * 4), (93, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (7, [0.5] * 4), (9, rows[9][1]), (94, [])]
    got = topk_search.nearest(table(spark, rows), every=10, **options).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 10)


def test_few_and_none(spark):
    assert topk_search.nearest(table(spark, [])).collect() == []
    assert topk_search.nearest(table(spark, [(0, [1.0])])).collect() == []
    assert [tuple(r) for r in topk_search.nearest(table(spark, [(0, [1.0]), (1, [2.0])])).collect()] == [(0, 1, 1, 256 * 512)]


def test_large_components_are_exact(spark):
    rows = [(0, [3e6, 3e6]), (1, [3e6, 1e6]), (2, [3e6, 1e6 + 8])]
    got = [tuple(r) for r in topk_search.nearest(table(spark, rows)).orderBy("rank").collect()]
    want = lambda v: int(256 * 3e6) * (int(256 * v[0]) + int(256 * v[1]))
    assert got == [(0, 1, 2, want(rows[2][1])), (0, 2, 1, want(rows[1][1]))]


def test_blocks_are_pruned():
    blocks = [(np.arange(b * 10, b * 10 + 10), np.full((10, 4), 100 - b)) for b in range(50)]
    *_, scored = topk_search.search_blocks(np.array([-1]), np.ones((1, 4), np.int64), blocks, 5)
    assert scored < 50 * 10 / 2


def test_oracle(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(duckdb.sql(topk_search.ORACLE).fetchall())
    got = registry.op1_topk_search(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("options", [{}, {"block": 3, "shard_rows": 20, "chunk_rows": 2, "least_shard": 5}])
def test_every_row_of_a_repeated_id_is_a_candidate(spark, options):
    r = random.Random(2)
    rows = [(i // 2, [r.choice([-1.0, 0.0, 0.5]) for _ in range(4)]) for i in range(80)] + [(1, [5.0] * 4), (1, [9.0] * 4), (1, [9.0] * 4)]
    got = topk_search.nearest(table(spark, rows), every=10, repeats=True, **options).collect()
    quant = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows]
    asks, want = {}, []
    for i, q in quant:
        if i % 10 == 0:
            asks[i] = min(asks.get(i, q), q)
    for i, q in asks.items():
        best = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in quant if j != i)[:5]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_wide_vectors_get_smaller_shards(spark, monkeypatch):
    rows = [(i, [float((i * 7 + d) % 5) for d in range(6)]) for i in range(60)]
    want = sorted(map(tuple, topk_search.nearest(table(spark, rows), every=10).collect()))
    monkeypatch.setattr(topk_search, "SHARD_BYTES", 10 * 8 * 6)
    assert sorted(map(tuple, topk_search.nearest(table(spark, rows), every=10).collect())) == want


SMALL = {"block": 3, "shard_rows": 20, "chunk_rows": 2, "least_shard": 5, "shelf": 2}


@pytest.mark.parametrize("options", [{}, SMALL])
def test_every_row_asks_and_has_all_rows_but_itself(spark, options):
    r = random.Random(3)
    rows = [(i // 2, [r.choice([-1.0, 0.0, 0.5]) for _ in range(4)]) for i in range(80)]
    rows += [(10, [5.0] * 4), (10, [5.0] * 4), (10, [0.0] * 4), (10, [5.0, 5.0]), (3, None), (None, [1.0] * 4)] + [(20, [2.0] * 4)] * 9
    got = topk_search.nearest(table(spark, rows), every=10, each_row=True, **options).collect()
    quant = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None]
    want = []
    for at, (i, q) in enumerate(quant):
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, w)), j) for n, (j, w) in enumerate(quant) if n != at)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_only_shards_that_reach_the_threshold_get_a_query(spark, monkeypatch):
    rows = [(i, [float(i // 100 == d) * (1 + i % 7) for d in range(10)]) for i in range(1000)]
    searched, plain = [], topk_search._search
    monkeypatch.setattr(topk_search, "_search", lambda pairs, *rest: searched.append(pairs.count()) or plain(pairs, *rest))
    got = topk_search.nearest(table(spark, rows), each_row=True, block=25, shard_rows=50, chunk_rows=8, least_shard=50, shelf=3).collect()
    assert len(got) == 20 * 5 and searched[0] == 20
    assert searched[1] <= 20 * 3  # of 20 shards; each query's own range of ids spans two or three


def test_clashing_columns_and_no_rows_for_each_row(spark):
    rows = table(spark, [(0, [1.0]), (50, [2.0])]).selectExpr("*", "1 as v", "2 as query_id", "3 as score")
    assert sorted(map(tuple, topk_search.nearest(rows, each_row=True).collect())) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert topk_search.nearest(table(spark, []), each_row=True).collect() == []
    assert topk_search.nearest(table(spark, [(0, [1.0])]), each_row=True).collect() == []


def test_components_beyond_64_bits_dont_crash(spark):
    rows = [(0, [1e30, 1.0]), (1, [1.0, 1.0]), (50, [1.0, 2.0])]
    got = topk_search.nearest(table(spark, rows), each_row=True).collect()
    assert {r["query_id"] for r in got} == {0, 50}
