"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Within a source every document has the same expected number of copies: its source's target over the
source's size. Documents are ordered by size class, salt and size; the running sum of expected copies,
shifted by one offset a source, is cut at the integers, and a document is emitted once for each
integer that it crosses. As the order follows size, the words taken come near the target too.

The running sum has two levels: a small table of (source, size class, salt) strata holds the rows that
come before each stratum, and a rank within the stratum does the rest. No task needs a whole source. With the
number of rows the classes are cut finer, by further bits of the size, which leaves the order as it is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ROW, checkpointed, hash32, packed, unpacked, word_count

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # of all words, as a fraction: 150 %
MOST = 2  # copies of a document, and times a source's size
SALTS = 64
STRATUM_ROWS = 1 << 16  # about as many rows of one source, salt and (finer) class
BROADCAST_ROWS = 1 << 16  # strata, of some 100 bytes each
SEED = "mix-1"


def source_targets(strata: DataFrame, weights: Sequence[int], share: tuple[int, int], most: int) -> DataFrame:
    """(source, source_size, target) from strata (source, words): weights by code point order, null last,
    repeating; no target above `most` times its source, the excess shared again by weight."""
    num, den = share
    sources = strata.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sources.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1)).cast("long"))
    everything = W.partitionBy()
    # Filled in the order in which sources reach their limit: those that do form a head of this order.
    order = W.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    sources = sources.withColumns({
        "total": F.sum("source_size").over(everything),
        "cap": F.col("source_size") * most,
        "caps_before": F.coalesce(F.sum(F.col("source_size") * most).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "w_left": F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)),
    })
    full = F.col("cap") * den * F.col("w_left") <= F.col("w") * (F.col("total") * num - F.col("caps_before") * den)
    sources = sources.withColumn("full", full)
    level = (F.col("total") * (num / den) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)) / F.sum(
        F.when(F.col("full"), 0).otherwise(F.col("w"))
    ).over(everything)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * F.when(~F.col("full"), level))
    return sources.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id", weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE, most: int = MOST, salts: int = SALTS, seed: str = SEED, carry: Sequence[str] | None = None,
    stratum_rows: int = STRATUM_ROWS,
) -> DataFrame:
    """docs with size, source_size, target, copies and taken (size times copies), dropped ones too.

    A null text has size 0; a null source is a source of its own, the last; null ids order first.
    Equal rows are drawn one by one. A source without words has target 0 and no copies. An empty table
    gives an empty one. Reruns agree: the offset is a hash of seed and source. `carry` names the input columns
    that the result needs, all by default: what isn't carried, a text above all, doesn't shuffle.
    """
    carried = list(docs.columns if carry is None else carry)
    rows = docs.select(
        packed(docs.select(*[F.col(f"`{c}`") for c in carried])), F.col(source).cast("string").alias("source"), F.col(id).alias("id"), word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(text)).alias("tie"),
    ).withColumns({
        "class": F.length(F.bin("size")),
        "salt": F.coalesce(hash32(F.col("id").cast("string")), F.lit(0)) % salts,
    })
    finer = max(0, math.ceil(math.log2(max(1, docs.count() / (salts * stratum_rows)))))
    # The leading bits of the size: the first one, which the class fixes, and `finer` more.
    rows = rows.withColumn("part", F.expr(f"shiftright(size, greatest(0, class - 1 - {finer}))"))
    key = ["source", "class", "salt", "part"]
    # A small table that three things are read from: without a cut each would count all words again.
    strata = checkpointed(rows.groupBy(*key).agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    n_strata = strata.count()
    before = F.sum("n").over(W.partitionBy("source").orderBy("class", "salt", "part")) - F.col("n")
    targets = source_targets(strata, weights, share, most).withColumnRenamed("source", "t_source")
    label = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("")))
    strata = (
        strata.withColumn("before", before)
        .join(targets, F.col("source").eqNullSafe(F.col("t_source")))
        .select(*[F.col(k).alias(f"k_{k}") for k in key], "before", "source_size", "target",
                (hash32(label) / F.lit(2.0**32)).alias("offset"))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    )
    # A small table goes to every task, which spares the rows with their texts a shuffle; a large one is joined.
    strata = F.broadcast(strata) if n_strata <= BROADCAST_ROWS else strata
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"k_{k}"))
    rank = F.row_number().over(W.partitionBy(*key).orderBy("size", "id", "tie")) + F.col("before")
    rows = rows.join(strata, on).withColumn("rank", rank)
    crossed = lambda upto: F.floor(upto * F.col("rate") + F.col("offset"))
    # At a high rank the sum of rank * rate and offset rounds, which alone could give one copy more than `most`.
    rows = rows.withColumn("copies", F.least(crossed(F.col("rank")) - crossed(F.col("rank") - 1), F.lit(most)).cast("long"))
    return unpacked(rows, carried, {
        "size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "copies": F.col("copies"),
        "taken": F.col("copies") * F.col("size"),
    })


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every document as often as it was drawn, columns as they were.

    Documents without words can be drawn too, as the draw goes by rows; else nulls, empty and very long texts, ties, repeated
    rows and empty tables as in mix.
    """
    inner = docs.select(packed(docs), F.col(text).alias("t"), F.col(source).alias("s"), F.col(id).alias("i"))
    drawn = mix(inner, "t", "s", "i", **options)
    return drawn.filter("copies > 0").select(f"{ROW}.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__ls_copy")).drop("__ls_copy")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
rows_ AS (
  SELECT *, length(to_binary(size)) AS class,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT, 0) % 64 AS salt FROM sized),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w FROM s0),
s2 AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(2 * source_size) OVER (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
         sum(w) OVER (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM s1),
s3 AS (SELECT *, cap * 2 * w_left <= w * (total * 3 - caps_before * 2) AS isfull FROM s2),
s4 AS (SELECT source, source_size, CASE WHEN isfull THEN cap::DOUBLE ELSE
         w::DOUBLE * ((total::DOUBLE * 1.5::DOUBLE - (sum(CASE WHEN isfull THEN cap ELSE 0 END) OVER ())::DOUBLE)
                      / (sum(CASE WHEN isfull THEN 0 ELSE w END) OVER ())::DOUBLE) END AS target FROM s3),
ranked AS (
  SELECT r.doc_id, r.size, s.source_size, s.target,
         CASE WHEN s.source_size > 0 THEN s.target / s.source_size::DOUBLE ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1' || coalesce(':' || r.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE AS shift,
         row_number() OVER (PARTITION BY r.source ORDER BY class, salt, size, doc_id) AS rank
  FROM rows_ r JOIN s4 s ON r.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rank::DOUBLE * rate + shift) - floor((rank - 1)::DOUBLE * rate + shift)))::BIGINT AS taken
FROM ranked
"""
