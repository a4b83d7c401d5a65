"""Events that keep arriving: a file stream merged into the store, and windowed sums of it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerscope.functions.expr import at, canonical_json, typed
from ledgerscope.plans import store
from ledgerscope.schemas import TABLES
from ledgerscope.sources.seeds import parsed

_KIND = {"text": "string", "int": "bigint", "real": "double"}


def event_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """JSON lines that appear in a folder, as the table's columns."""
    lines = spark.readStream.text(folder).filter(F.trim("value") != "").select(parsed(F.col("value")).alias("v"))
    return lines.select(*[typed(at(F.col("v"), n), _KIND[k]).alias(n) for n, k in TABLES[table].columns])


def upsert_stream(events: DataFrame, root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into the buckets of the store that it touches, last wins by observed_at; a repeated batch changes nothing.

    Rows of one time go by a hash of the row, so that the same one wins whenever the batch is repeated.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            spark = batch.sparkSession
            seq = F.struct("observed_at", F.xxhash64(*TABLES[table].names).alias("tie"))
            store.merge(spark, root, {table: store.Last(batch.withColumn("seq", seq))})

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_seen_stream(rows: DataFrame, control: str, seq: Sequence[str]) -> DataFrame:
    """The first row of each control number of a stream, over all its micro-batches; rows without one are told apart by all their columns.

    Within a micro-batch the least by seq is the first; ties go by the other columns, so a repeated batch gives the same row. The
    state is one flag a key. Rows of a hot key pass in frames of bounded size, of which one row is kept.
    """
    columns = rows.columns
    order = [*seq, *[c for c in columns if c not in seq]]

    def first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            best = pd.concat([f for f in (best, frame[columns]) if f is not None]).sort_values(order, kind="stable").head(1)
        if not state.exists:
            state.update((True,))
            yield best

    identity = F.coalesce(F.nullif(F.col(control), F.lit("")), canonical_json(columns))
    return rows.withColumn("__key", identity).groupBy("__key").applyInPandasWithState(first, rows.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def totals_by_window(events: DataFrame, time: str, value: str, group: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Sums of a value by time window and group; rows later than `late` behind the newest are left out."""
    timed = events.withColumn("at", F.try_to_timestamp(F.col(time))).withWatermark("at", late)
    sums = timed.groupBy(F.window("at", window), group).agg(F.count("*").alias("events"), F.sum(F.col(value).cast("decimal(28,6)")).cast("double").alias("total"))
    return sums.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), group, "events", "total")
