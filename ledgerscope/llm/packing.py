"""Conflict-constrained best-fit packing.

Documents are packed, largest first, into bins of `capacity` words. Open bins are ordered by the room that
is left; the search begins at the first bin with room enough and goes on until a bin is compatible, so the
tightest compatible bin is found, or a new one is opened. A bin carries a bitmap of the duplicate clusters
in it (no two documents of a cluster share a bin) and one of its sources with `per_source` places
each: by default twice the share of a bin that the largest source has of all pieces, so that a corpus of few sources or short
documents still fills its bins. Documents longer than a bin are cut into whole bins and a rest, which is packed like the others.

Packing runs in shards of bounded size, dealt by a hash of the row, so that hot sources and clusters spread
evenly; rows that repeat id, source and text are counted first and dealt `_COPIES` at a time, so that they spread too; each shard wastes part of a bin at most over packing all at once. Texts don't travel.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import word_count

CAPACITY = 2048
PER_SOURCE = 4  #: least number of places of a source in a bin
SHARD_DOCS = 8192
SHARD_WORDS = 1 << 22
_COPIES = 16  # equal rows that go to one shard together


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[int]:
    """The bin of each item, in the order given; sources and clusters are small integers, cluster -1 never conflicts."""
    free: list[tuple[int, int]] = []  # (room left, bin), ascending
    in_source: list[int] = []
    in_cluster: list[int] = []
    lane = (1 << per_source) - 1
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        shift, bit = source * per_source, 0 if cluster < 0 else 1 << cluster
        at = bisect_left(free, (size, -1))
        while at < len(free):
            b = free[at][1]
            if not in_cluster[b] & bit and in_source[b] >> shift & lane != lane:
                break
            at += 1
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(in_source)
            in_source.append(0)
            in_cluster.append(0)
        places = in_source[b] >> shift & lane
        in_source[b] |= (~places & (places + 1)) << shift
        in_cluster[b] |= bit
        if room > size:
            insort(free, (room - size, b))
        out.append(b)
    return out


def _pack_shard(capacity: int, per_source: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.loc[rows.index.repeat(rows["copies"])]
        rows = rows.sort_values(["words", "doc_id", "cluster", "piece"], ascending=[False, True, True, True]).reset_index(drop=True)
        # Only clusters with several documents here need a bit.
        several = pd.factorize(rows["cluster"].where(rows["cluster"].duplicated(keep=False)))[0]
        sources = pd.factorize(rows["source"], use_na_sentinel=False)[0]
        bins = np.array(best_fit(rows["words"].tolist(), sources.tolist(), several.tolist(), capacity, per_source), np.int64)
        rows["bin_id"] = (rows["shard"].astype("int64") * (1 << 32)) + bins
        of_bin = rows.groupby("bin_id")["words"]
        rows["bin_words"], rows["bin_docs"] = of_bin.transform("sum"), of_bin.transform("size")
        return rows[["doc_id", "source", "cluster", "piece", "first_word", "words", "bin_id", "bin_words", "bin_docs"]]

    return pack


def pack(
    docs: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id", cluster: Column | None = None,
    capacity: int = CAPACITY, per_source: int | None = None, shard_docs: int = SHARD_DOCS, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, source, cluster, piece, first_word, words, bin_id, bin_words, bin_docs.

    `cluster` defaults to a hash of the text, so that exact copies conflict. A document without words (a null
    text too) gets one row with words 0 and null bin columns. A null source is a source of its own. Equal
    rows are packed one by one and, being one cluster, into different bins. Very long texts are cut into many
    pieces. Ties in size go by id, cluster and piece. Extra columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
        (F.xxhash64(F.col(text)) if cluster is None else cluster).cast("long").alias("cluster"),
    )
    of_source = rows.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("size").alias("words"), F.sum(F.ceil(F.col("size") / capacity)).alias("pieces")
    )
    total = of_source.agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.max("pieces").alias("most")).first()
    n, words = total["n"] or 0, total["words"] or 0
    shards = max(1, math.ceil(n / shard_docs), math.ceil(words / shard_words))
    if per_source is None:
        per_source = max(PER_SOURCE, math.ceil(2 * capacity * (total["most"] or 0) / max(1, words)))
    last = F.floor((F.col("size") - 1) / capacity).cast("long")
    equal = rows.filter("size > 0").groupBy(*rows.columns).agg(F.count("*").alias("n"))
    equal = equal.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_COPIES}"))))
    equal = equal.withColumn("copies", F.least(F.lit(_COPIES), F.col("n") - F.col("lot") * _COPIES).cast("long")).drop("n")
    pieces = equal.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("first_word", F.col("piece") * capacity)
    pieces = pieces.withColumn("words", F.least(F.col("size") - F.col("first_word"), F.lit(capacity)).cast("long"))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "piece", "lot"), F.lit(shards)))
    schema = "doc_id long, source string, cluster long, piece long, first_word long, words long, bin_id long, bin_words long, bin_docs long"
    packed = pieces.drop("size", "lot").groupBy("shard").applyInPandas(_pack_shard(capacity, per_source), schema)
    none = F.lit(None).cast("long")
    empty = rows.filter("size = 0").select(
        "doc_id", "source", "cluster", *[F.lit(0).cast("long").alias(c) for c in ("piece", "first_word", "words")],
        *[none.alias(c) for c in ("bin_id", "bin_words", "bin_docs")],
    )
    return packed.unionByName(empty)
