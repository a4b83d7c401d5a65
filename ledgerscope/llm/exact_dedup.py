"""Exact de-duplication with a two-pass Bloom filter, in DataFrame operations only.

Pass one hashes every text to two slots of a filter with 16 slots a row and counts the rows of each slot;
the slots with two rows or more, as bitmaps of 4 KB, are the filter. What shuffles for it are two numbers a
row, never a text. (Bitmaps made by each task and merged would weigh 2 bytes a row times the number of tasks.)
The filter holds at most `SLOTS` bits, 256 MB, which is what lets it be broadcast. Pass two tests each
row: a row with a slot of its own has no equal and passes straight through; the others shuffle, are grouped by
SHA-256 and joined with their group under a salt, so a group that holds a third of all rows spreads over `salts`
tasks. Beyond some 10^8 rows the filter fills and more rows shuffle; the result stays the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ROW, packed, unpacked, written

SLOTS = 1 << 31  # ceiling of the filter's size
LEAST_SLOTS = 1 << 20
SLOTS_PER_ROW = 16
_BITMAP = 1 << 15  # slots of one bitmap, as bitmap_construct_agg has them
SALTS = 32


def filter_slots(rows: int) -> int:
    """Size of the filter for so many rows: the next power of two, between LEAST_SLOTS and SLOTS."""
    return min(SLOTS, max(LEAST_SLOTS, 1 << (SLOTS_PER_ROW * rows - 1).bit_length()))


def repeated_slots(hashes: DataFrame) -> DataFrame:
    """The filter: (part, bits), a bitmap for each part of _BITMAP slots, of the slots that two rows or more of hashes (columns s1, s2) fall into."""
    slots = hashes.select(F.explode(F.array("s1", "s2")).alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).filter("n > 1")
    # Dealt by part before they are gathered: partial bitmaps of every task would be larger than the slots.
    slots = slots.select(F.expr(f"slot div {_BITMAP}").alias("part"), (F.col("slot") % _BITMAP).alias("at")).repartition("part")
    return slots.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))


def _met(rows: DataFrame, words: DataFrame, slot: str, low: int, high: int) -> DataFrame:
    """rows with the boolean met_<slot>: another row may share their slot, which lies from low to below high."""
    side = words.filter(F.col("part").between(low // _BITMAP, (high - 1) // _BITMAP)).select(F.col("part").alias("__ls_part"), F.col("bits").alias("__ls_bits"))
    byte = f"substring(__ls_bits, cast({slot} % {_BITMAP} div 8 as int) + 1, 1)"
    bit = F.expr(f"getbit(cast(conv(hex({byte}), 16, 10) as int), cast({slot} % 8 as int)) = 1")
    rows = rows.join(F.broadcast(side), F.expr(f"{slot} div {_BITMAP}") == F.col("__ls_part"), "left")
    return rows.withColumn(f"met_{slot}", F.coalesce(bit, F.lit(False))).drop("__ls_part", "__ls_bits")


def exact_dedup(
    docs: DataFrame, text: str = "text", id: str = "doc_id", normalise: Callable[[Column], Column] | None = None,
    slots: int | None = None, salts: int = SALTS, carry: Sequence[str] | None = None,
) -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256; of equal texts the row with the largest id stays.

    A null text counts as empty. A null id is smaller than any other. Of rows that share both the text
    and the largest id one stays (they are interchangeable or differ only in columns that the rule
    doesn't read). Very long texts are hashed whole. An empty table gives an empty one. Input columns named
    like a result column give way. `slots` follows the number of rows by default. `carry` names the input
    columns that the result needs, all by default. The rows that the filter holds back are written to the
    shared folder once, as two things are read from them.
    """
    carried = list(docs.columns if carry is None else carry)
    slots = filter_slots(docs.count()) if slots is None else slots
    body = F.coalesce(F.col(text), F.lit(""))
    body = normalise(body) if normalise else body
    # Two independent slots of one row must differ, or a row would meet itself: they lie in two halves.
    half = slots // 2
    kept = packed(docs.select(*[F.col(f"`{c}`") for c in carried]))
    rows = docs.select(kept, F.col(id).alias("id"), body.alias("body")).withColumns({
        "s1": F.pmod(F.xxhash64("body"), F.lit(half)),
        "s2": F.pmod(F.xxhash64("body", F.lit(1)), F.lit(half)) + half,
    })
    words = written(repeated_slots(rows.select("s1", "s2")))
    rows = _met(_met(rows, words, "s1", 0, half), words, "s2", half, slots)
    rows = rows.select(ROW, "id", F.sha2("body", 256).alias("sha"), (F.col("met_s1") & F.col("met_s2")).alias("met"))

    alone = rows.filter("not met").select(
        ROW, "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept")
    )
    several = written(rows.filter("met").drop("met")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    groups = several.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Rows of one id share the salt, so the join's partitioning serves the window too.
    first = F.row_number().over(W.partitionBy("sha", "salt", "id").orderBy("id")) == 1
    several = several.join(groups, ["sha", "salt"]).select(
        ROW, "sha", "keep_id", "n", (F.col("id").eqNullSafe(F.col("keep_id")) & first).alias("kept")
    )
    return unpacked(alone.unionByName(several), carried, {
        "keep_id": F.col("keep_id"), "group_size": F.col("n"), "kept": F.col("kept"), "text_sha256": F.col("sha"),
    })


def drop_exact_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """docs without the rows that exact_dedup drops, columns as they were.

    Nulls, empty and very long texts, ties, repeated rows and empty tables as in exact_dedup: one row of each text stays.
    """
    marked = exact_dedup(docs.select(packed(docs), F.col(text).alias("t"), F.col(id).alias("i")), "t", "i", carry=[ROW])
    return marked.filter("kept").select(f"{ROW}.*")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
