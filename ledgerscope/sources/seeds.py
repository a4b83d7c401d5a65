"""CSV seeds and JSON lines, read through Spark so that any store works."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.functions.expr import at, typed, ustrip
from ledgerscope.schemas import Table

#: The place of a line among the lines of one path.
LINE = "struct<path:string,block:bigint,row:bigint>"

_KIND = {"text": "string", "int": "bigint", "real": "double"}


def _missing(problem: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(problem)


def read_seed(spark: SparkSession, path: str, columns: Sequence[str], seq: bool = False) -> DataFrame:
    """A CSV with a header as text columns, chosen by name; a missing file is empty.

    Empty cells of columns in the header are '', columns that it lacks are null. seq adds the order of rows.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    except AnalysisException as problem:
        if not _missing(problem):
            raise
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("seq", F.lit(0).cast("long")) if seq else empty
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return raw.select(*cells, *([F.monotonically_increasing_id().alias("seq")] if seq else []))


def read_lines(spark: SparkSession, paths: Iterable[str], missing_ok: bool = False) -> DataFrame:
    """(file, line, value) of the lines of text files that aren't blank; `file` is a path's place in the list.

    `line` sorts in reading order: a path that is a folder counts its files by name, whatever order Spark reads
    them in, a file its blocks by place, and a block its lines.
    """
    out = None
    for place, path in enumerate(paths):
        try:
            lines = spark.read.text(path)
        except AnalysisException as problem:
            if missing_ok and _missing(problem):
                continue
            raise
        line = F.struct(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        )
        lines = lines.select(F.lit(place).alias("file"), line.alias("line"), "value").filter(ustrip(F.col("value")) != "")
        out = lines if out is None else out.unionByName(lines)
    return spark.createDataFrame([], f"file int, line {LINE}, value string") if out is None else out


def arrival() -> Column:
    """The order of read_lines as one sortable column."""
    return F.struct("file", "line").alias("seq")


def parsed(value: Column) -> Column:
    """A line as VARIANT, raising if it is malformed. Blank lines are null here too: filters may run in any order."""
    return F.parse_json(F.when(ustrip(value) != "", value))


def read_rows(spark: SparkSession, paths: Iterable[str], table: Table, missing_ok: bool = False) -> DataFrame:
    """JSON lines as the columns of a table and seq; other keys go, missing ones are null, a malformed line raises."""
    lines = read_lines(spark, paths, missing_ok).select(arrival(), parsed(F.col("value")).alias("v"))
    return lines.select("seq", *[typed(at(F.col("v"), name), _KIND[kind]).alias(name) for name, kind in table.columns])
