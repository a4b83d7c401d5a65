"""Snapshots of what was fetched: content-addressed bodies, a manifest, and what a collection covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.expr import safe_suffix, sha256_hex

# Columns of a manifest row, and the note of a coverage report.
MANIFEST = ["source_id", "requested_url", "final_url", "status_code", "content_type", "collected_at", "sha256", "byte_count", "body_path"]
COVERAGE_NOTE = "complete=false means the public source stopped the collection; persisted records remain valid but coverage is partial."


def described(fetched: DataFrame, root: str) -> DataFrame:
    """fetched (source_id, requested_url, final_url, status_code, content_type, collected_at, body) with sha256, byte_count, suffix and body_path."""
    body = F.col("body").cast("binary")
    rows = fetched.withColumns({"sha256": sha256_hex(body), "byte_count": F.octet_length(body), "suffix": safe_suffix(F.col("content_type"), F.col("final_url"))})
    return rows.withColumn("body_path", F.concat_ws("/", F.lit(root), "source_id", F.concat("sha256", "suffix")))


def manifest(rows: DataFrame) -> DataFrame:
    """One row for each fetch, also where the body was stored before."""
    return rows.select(*MANIFEST)


def new_bodies(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Each body once (source_id, sha256, suffix, body), without those stored before."""
    key = ["source_id", "sha256", "suffix"]
    bodies = rows.groupBy(*key).agg(F.any_value("body").alias("body"))
    return bodies if stored is None else bodies.join(stored.select(*key), key, "left_anti")


def append_snapshots(fetched: DataFrame, root: str) -> DataFrame:
    """Writes bodies (one row each, partitioned by source) and manifest rows under root; returns the manifest rows."""
    spark = fetched.sparkSession
    rows = described(fetched, root)
    try:
        stored = spark.read.parquet(f"{root}/bodies")
        stored.schema
    except Exception as problem:  # the first collection has no store yet
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        stored = None
    new_bodies(rows, stored).write.mode("append").partitionBy("source_id").parquet(f"{root}/bodies")
    manifest(rows).write.mode("append").json(f"{root}/manifest", ignoreNullFields=False)
    return manifest(rows)


def coverage(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """One row: whether all series ended well, how many distinct records there are, and the first stop's URL and status.

    rows are the distinct records in scope; stops has (requested_url, status_code, seq) of series that were cut.
    """
    n = rows.agg(F.count("*").alias("records"))
    stop = stops.agg(F.min_by(F.struct("requested_url", "status_code"), "seq").alias("stop"))
    return n.crossJoin(stop).select(
        F.col("stop").isNull().alias("complete"), "records", F.col("stop.requested_url").alias("stopped_url"),
        F.col("stop.status_code").alias("stopped_status"), F.lit(COVERAGE_NOTE).alias("note"),
    )
