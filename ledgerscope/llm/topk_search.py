"""Exact top-k search by block-at-a-time pruning.

Candidates are cut into ranges of ids, the blocks. A block keeps its rows as a forward index (a matrix) and
each term's maximum; a component counts as two terms, one for each sign, so the maximum and the minimum of
the column are kept. A query's bound for a block is the sum of its terms times their maxima. Blocks are
visited in the order of their bounds, scored whole through the forward index, and the visit ends once
the next bound is below the k-th score so far (equal bounds are visited: ties go to smaller ids).

Blocks are gathered into shards of bounded size, and a shard has a bound of its own, from the maxima over its blocks.
A query is scored in the shard with its highest bound first; that gives its threshold. Only shards whose bound
reaches the threshold get the query after that, and only shards with queries are read again. A shard is copied
once for every PART_BYTES of queries sent to it, so copies of the index stay in proportion to the pairs that pass the
bounds. Maxima of shards meet chunks of queries by shelves of bounded size; nothing is broadcast by this module.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, written

K = 5
SCALE = 256.0
BLOCK = 256
SHARD_ROWS = 1 << 16
SHARD_BYTES = 1 << 27  # of a shard's forward indexes, so wide vectors get shards of fewer rows
CHUNK_ROWS = 1 << 13
#: Maxima of so many shards meet a chunk of queries in one task.
SHELF = 1 << 11
#: Bytes of queries that one task scores in a shard: as much as the shard's index.
PART_BYTES = SHARD_BYTES
#: Small inputs are cut into smaller shards, down to this, so that more than one task works.
LEAST_SHARD = 1 << 12


def quantised(embedding: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or isn't finite."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(vectors: list) -> np.ndarray:
    """Rows padded with zeros to one width: a missing component counts as 0."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _build(block: int, shards: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*batches, pd.DataFrame({"vec_id": pd.Series([], dtype="int64"), "v": []})])
        rows = rows.sort_values("vec_id", kind="stable")
        shard = TaskContext.get().partitionId() % shards
        for at in range(0, len(rows), block):
            part = rows.iloc[at : at + block]
            m = _matrix(part["v"].tolist())
            yield pd.DataFrame({
                "shard": [shard], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "rows": [m.tobytes()],
                "most": [m.max(0)], "least": [m.min(0)],
            })

    return build


def _shard_maxima(blocks: pd.DataFrame) -> pd.DataFrame:
    most, least = _matrix(blocks["most"].tolist()).max(0), _matrix(blocks["least"].tolist()).min(0)
    return pd.DataFrame({"shard": blocks["shard"].iloc[:1], "most": [most], "least": [least]})


def _bounds(queries: list, most: list, least: list) -> np.ndarray:
    """Upper bounds of the scores of queries (rows) in shards (columns), raised by what rounding could take."""
    width = max(1, *map(len, queries), *map(len, most))
    q, most, least = (_wide(_matrix(x), width).astype(np.float64) for x in (queries, most, least))
    size = np.abs(q) @ np.maximum(np.abs(most), np.abs(least)).T
    bound = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T
    return np.where(size < 2.0**53, bound, bound + size * 1e-9)


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def search_blocks(
    query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int, kth: np.ndarray | None = None, own: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of each query's k best in these blocks, and how many rows were scored.

    With kth, scores below a query's threshold don't count. With own, rows of the query's id count as well.
    """
    width = max(queries.shape[1], *(m.shape[1] for _, m in blocks))
    queries, blocks = _wide(queries, width), [(ids, _wide(m, width)) for ids, m in blocks]
    largest = float(np.abs(queries).max(initial=0)) * max(float(np.abs(m).max(initial=0)) for _, m in blocks) * width
    kind = np.float64 if largest < 2.0**53 else np.int64  # sums that doubles hold exactly use the faster product
    lowest = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
    queries, blocks = queries.astype(kind), [(ids, m.astype(kind)) for ids, m in blocks]
    most = np.stack([m.max(0) for _, m in blocks])
    least = np.stack([m.min(0) for _, m in blocks])
    bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
    order = np.argsort(-bounds, 1, kind="stable")
    ordered = np.take_along_axis(bounds, order, 1)
    kth = np.full(len(queries), lowest, kind) if kth is None else np.maximum(kth.astype(kind), lowest)
    row, ident, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)
    scored, at, step = 0, 0, 1
    while at < len(blocks):
        visit = order[:, at : at + step]
        live = ordered[:, at : at + step] >= kth[:, None]
        if not live.any():
            break
        found = [(row, ident, score)]
        for b in np.unique(visit[live]):
            rows = np.flatnonzero((live & (visit == b)).any(1))
            ids, m = blocks[b]
            s = queries[rows] @ m.T
            scored += s.size
            out = (ids[None, :] == query_ids[rows][:, None]) & (not own)
            s[out] = lowest
            floor = kth[rows]
            if s.shape[1] > k:
                floor = np.maximum(floor, np.partition(s, -k, 1)[:, -k])
            r, c = np.nonzero((s >= floor[:, None]) & ~out)
            found.append((rows[r], ids[c], s[r, c]))
        row, ident, score = (np.concatenate(x) for x in zip(*found))
        sort = np.lexsort((ident, -score, row))
        row, ident, score = row[sort], ident[sort], score[sort]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        full = rank == k - 1
        kth[row[full]] = np.maximum(kth[row[full]], score[full])
        row, ident, score = row[rank < k], ident[rank < k], score[rank < k]
        at, step = at + step, step * 2
    return row, ident, score.astype(np.int64), scored


_QUERY = "query_id long, key long, copies long, v array<long>"
_NONE = np.iinfo(np.int64).min  # the threshold of a query that has none yet


def _meet(queries: DataFrame, maxima: DataFrame, shelves: int, chunks: int, home: bool) -> DataFrame:
    """(query, kth, shard): with home, each query's shard of the highest bound (one for each shelf, with the bound); else its shards that reach kth, but for its home."""

    def task(queries: pd.DataFrame, maxima: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for at in range(0, len(queries) if len(maxima) else 0, 1024):
            some = queries.iloc[at : at + 1024]
            bounds = _bounds(some["v"].tolist(), maxima["most"].tolist(), maxima["least"].tolist())
            shard = maxima["shard"].to_numpy()
            if home:
                q, best = np.arange(len(some)), bounds.argmax(1)
            else:
                q, best = np.nonzero((bounds >= some["kth"].to_numpy()[:, None]) & (shard[None, :] != some["home"].to_numpy()[:, None]))
            parts.append(some.iloc[q][["query_id", "key", "copies", "v", "kth"]].assign(shard=shard[best], bound=bounds[q, best]))
        columns = ["query_id", "key", "copies", "v", "kth", "shard", "bound"]
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in columns})

    queries = queries.withColumn("chunk", F.pmod(F.xxhash64("query_id", "key"), F.lit(chunks)).cast("int"))
    queries = queries.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
    maxima = maxima.withColumn("shelf", (F.col("shard") % shelves).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pairs = queries.groupBy("shelf", "chunk").cogroup(maxima.groupBy("shelf", "chunk"))
    return pairs.applyInPandas(task, f"{_QUERY}, kth long, shard int, bound double")


def _search(pairs: DataFrame, blocks: DataFrame, k: int, own: bool, part_rows: int) -> DataFrame:
    """Each row of pairs (query, kth, shard) with its product with itself and the ids and scores of its k best in that shard, best first, from kth on."""

    def task(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = queries[["query_id", "key", "copies", "v", "kth", "shard"]].assign(norm=0, ids=None, scores=None)
        if blocks.empty or queries.empty:
            return out.iloc[:0]
        parts = []
        for ids, rows in zip(blocks["ids"], blocks["rows"]):
            ids = np.frombuffer(ids, np.int64)
            parts.append((ids, np.frombuffer(rows, np.int64).reshape(len(ids), -1)))
        for at in range(0, len(queries), CHUNK_ROWS):
            some = queries.iloc[at : at + CHUNK_ROWS]
            m = _matrix(some["v"].tolist())
            out.loc[some.index, "norm"] = (m * m).sum(1)
            row, ident, score, _ = search_blocks(some["query_id"].to_numpy(np.int64), m, parts, k, some["kth"].to_numpy(np.int64), own)
            cuts = np.searchsorted(row, np.arange(1, len(some)))
            for name, values in (("ids", ident), ("scores", score)):
                column = pd.Series(np.split(values, cuts), index=some.index, dtype="object")
                out.loc[some.index, name] = column
        return out

    parts = pairs.groupBy("shard").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    pairs = pairs.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("key", "query_id"), F.col("parts")).cast("int"))
    blocks = blocks.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sides = pairs.select("query_id", "key", "copies", "v", "kth", "shard", "part").groupBy("shard", "part").cogroup(
        blocks.select("ids", "rows", "shard", "part").groupBy("shard", "part")
    )
    return sides.applyInPandas(task, f"{_QUERY}, kth long, shard int, norm long, ids array<long>, scores array<long>")


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = K, block: int = BLOCK, shard_rows: int = SHARD_ROWS, chunk_rows: int = CHUNK_ROWS,
    least_shard: int = LEAST_SHARD, repeats: bool = False, each_row: bool = False, shelf: int = SHELF,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries (query_id, v) against candidates (vec_id, v), v an array of longs.

    A candidate with the query's id is left out. Ties go to smaller ids. Rows with a null id or vector take
    no part. Of candidates that share an id each counts with `repeats`, else the one with the smallest vector; of
    queries that share an id the one with the smallest vector asks. With `each_row`, where queries are rows of candidates,
    every row asks and every row but itself is a candidate, whatever their ids: a row repeated n times
    has n equal answers, and each holds the other copies. Vectors of unlike lengths
    compare as if padded with zeros. Fewer than k candidates give fewer rows; empty tables give none. Scores
    beyond 64 bits wrap, and bounds, which don't, may leave such rows out. The answer is a table in the shared folder.
    """
    queries = queries.filter("query_id is not null and v is not null").select("query_id", "v")
    candidates = candidates.filter("vec_id is not null and v is not null").select("vec_id", "v")
    if each_row:
        queries = queries.groupBy("query_id", "v").agg(F.count("*").alias("copies"))
    else:
        queries = queries.groupBy("query_id").agg(F.min("v").alias("v")).withColumn("copies", F.lit(1).cast("long"))
        if not repeats:
            candidates = candidates.groupBy("vec_id").agg(F.min("v").alias("v"))
    most = k + 1 if each_row else k  # the row itself is among them and goes at the end
    with Scratch(candidates.sparkSession) as scratch:
        asked = scratch.write(queries.select("query_id", F.xxhash64("v").alias("key"), "copies", "v", F.lit(_NONE).alias("kth")))
        n_queries = asked.count()
        n, width = candidates.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        row_bytes = 8 * max(1, width)
        shard_rows = max(1, min(shard_rows, SHARD_BYTES // row_bytes))
        wanted = max(1, candidates.sparkSession.sparkContext.defaultParallelism)
        shards = max(1, math.ceil(n / shard_rows), min(wanted, n // least_shard))
        chunks, shelves = max(1, math.ceil(n_queries / chunk_rows)), max(1, math.ceil(shards / shelf))
        # Rows of one id spread by their vectors, and copies of a row by the tasks that read them.
        spread = candidates.withColumn("hash", F.xxhash64("v")).withColumn("reader", F.spark_partition_id())
        spread = spread.repartitionByRange(shards, "vec_id", "hash", "reader").select("vec_id", "v")
        blocks = scratch.write(spread.mapInPandas(_build(block, shards), "shard int, ids binary, rows binary, most array<long>, least array<long>"))
        maxima = blocks.select("shard", "most", "least").groupBy("shard").applyInPandas(_shard_maxima, "shard int, most array<long>, least array<long>")
        maxima = scratch.write(maxima)
        part_rows = max(1, PART_BYTES // row_bytes)

        homes = _meet(asked, maxima, shelves, chunks, home=True)
        first = F.max_by(F.struct("copies", "v", "kth", "shard"), F.struct("bound", -F.col("shard"))).alias("first")
        homes = homes.groupBy("query_id", "key").agg(first).select("query_id", "key", "first.*")
        homes = scratch.write(_search(homes, blocks, most, each_row, part_rows))
        kth = F.when(F.size("scores") >= most, F.element_at("scores", -1)).otherwise(F.lit(_NONE))
        live = _meet(homes.withColumn("kth", kth).withColumnRenamed("shard", "home"), maxima, shelves, chunks, home=False)
        found = homes.unionByName(_search(scratch.write(live), blocks, most, each_row, part_rows))
        return written(_ranked(found, k, most, each_row))


def _ranked(found: DataFrame, k: int, most: int, each_row: bool) -> DataFrame:
    norm = F.col("norm") if each_row else F.lit(None).cast("long")
    found = found.select("query_id", "key", "copies", norm.alias("norm"), F.explode(F.arrays_zip("ids", "scores")).alias("f"))
    found = found.select("query_id", "key", "copies", "norm", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("place", place).filter(F.col("place") <= most)
    # Another row with the query's id and score is the same entry, so whichever goes the answer is the same.
    itself = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("norm"))
    best = found.groupBy("query_id", "key", "copies").agg(
        F.min(F.when(itself, F.col("place"))).alias("itself"), F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best")
    )
    best = best.withColumn("best", F.slice(F.filter("best", lambda b: ~b["place"].eqNullSafe(F.col("itself"))), 1, k))
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    best = best.select("query_id", F.posexplode("best").alias("at", "b"))
    return best.select("query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", "b.score")


def nearest(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", every: int = 50, k: int = K, **options) -> DataFrame:
    """top_k of the rows whose id is divisible by `every` against all rows of the table."""
    rows = vectors.select(F.col(id).alias("vec_id"), quantised(F.col(embedding)).alias("v"))
    queries = rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    return top_k(queries, rows, k, **options)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v WHERE vec_id % 50 = 0),
d AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT query_id, vec_id, sum(q.x * d.x)::BIGINT AS score FROM q JOIN d USING (i) WHERE vec_id <> query_id GROUP BY ALL),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
