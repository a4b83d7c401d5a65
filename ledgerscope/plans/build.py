"""Files to tables: the seeds and JSON lines of a city merged into its store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.functions.expr import at, blank_to_null, strict_double, strict_long, typed
from ledgerscope.schemas import TABLES
from ledgerscope.sources.city import CATALOGUE, Workspace
from ledgerscope.sources.seeds import LINE, parsed, read_lines, read_rows, read_seed

from . import store

#: Order of arrival across inputs: seeds come first, then files in the order given.
_SEQ = f"struct<file:int,line:{LINE}>"


def _ordered(frame: DataFrame, file: int) -> DataFrame:
    line = F.struct(F.lit("").alias("path"), F.lit(0).alias("block"), F.col("seq").alias("row"))
    return frame.withColumn("seq", F.struct(F.lit(file).alias("file"), line.alias("line")).cast(_SEQ))


def must_be(kind: str, cell: Column, name: str) -> Column:
    """A numeric cell; empty is null, and anything that isn't a number fails the build."""
    text = blank_to_null(cell)
    number = strict_long(text) if kind == "int" else strict_double(text)
    problem = F.raise_error(F.concat(F.lit(f"{name} isn't a number: "), text)).cast("long" if kind == "int" else "double")
    return F.when(text.isNull(), None).when(number.isNotNull(), number).otherwise(problem)


def seed_table(spark: SparkSession, workspace: Workspace, table: str, blanks: bool = False) -> DataFrame:
    """A seed CSV as a table's columns and seq, with the city's slug; blanks: '' in text columns is null too."""
    columns = TABLES[table].columns
    names = [n for n, _ in columns if n != "city_slug"]
    raw = read_seed(spark, str(workspace.seeds / f"{table}.csv"), names, seq=True)
    cell = {n: must_be(kind, F.col(n), n) if kind != "text" else (blank_to_null(F.col(n)) if blanks else F.col(n)) for n, kind in columns if n != "city_slug"}
    return raw.select(F.lit(workspace.city.slug).alias("city_slug"), *[c.alias(n) for n, c in cell.items()], "seq")


def suppliers_of(contracts: DataFrame, city_slug: str) -> DataFrame:
    """A supplier for each contract line that names one, also of contracts that were already known."""
    lines = contracts.filter((F.col("supplier_document").isNotNull()) & (F.col("supplier_document") != ""))
    return lines.select(
        F.lit(city_slug).alias("city_slug"), F.col("supplier_document").alias("document"), F.col("supplier_type").alias("person_type"),
        F.col("supplier_name").alias("name"), F.coalesce(blank_to_null(F.col("source_system")), F.lit("PNCP")).alias("source_system"),
        F.col("observed_at").alias("first_observed_at"), "seq",
    )


def build(spark: SparkSession, workspace: Workspace, root: str, procurements: Iterable[str] = (), contracts: Iterable[str] = ()) -> str:
    """Merges a city's configuration, seeds and collected files into the store at root; returns the new version."""
    city = workspace.city
    values = [(city.slug, city.name, city.uf, city.ibge_code, city.municipality_cnpj)]
    cities = spark.createDataFrame(values, TABLES["cities"].schema).withColumn("seq", F.lit(0))
    catalogue = read_seed(spark, str(workspace.catalogue), CATALOGUE, seq=True).withColumn("city_slug", F.lit(city.slug))
    changes: dict[str, store.First | store.Last] = {"cities": store.Last(cities), "sources": store.Last(catalogue)}
    for table in ("officials", "fiscal_observations", "legislative_observations"):
        changes[table] = store.Last(seed_table(spark, workspace, table))
    offered = _ordered(seed_table(spark, workspace, "procurements", blanks=True), -1)
    collected = read_rows(spark, procurements, TABLES["procurements"])
    changes["procurements"] = store.First(offered.unionByName(collected.withColumn("seq", F.col("seq").cast(_SEQ))))
    lines = read_rows(spark, contracts, TABLES["contracts"])
    changes["contracts"] = store.First(lines)
    changes["suppliers"] = store.First(suppliers_of(lines, city.slug))
    return store.merge(spark, root, changes)[0]


def ingest_events(spark: SparkSession, root: str, revenue: Iterable[str] = (), expense: Iterable[str] = ()) -> dict[str, int]:
    """Merges normalised revenue and expense events into the store, last wins; returns the rows read of each.

    Nothing is inferred: sources must carry their URL, time and hash. Missing files count as empty. The rows are
    counted by the write that takes them in.
    """
    paths = {"revenue_events": revenue, "expense_events": expense}
    return store.merge(spark, root, {t: store.Last(read_rows(spark, p, TABLES[t], missing_ok=True)) for t, p in paths.items()})[1]


def quarantined(spark: SparkSession, paths: Iterable[str], table: str) -> DataFrame:
    """(file, line, value, columns): lines whose numbers don't read as numbers and were taken as null."""
    lines = read_lines(spark, paths, missing_ok=True).withColumn("v", parsed(F.col("value")))
    kinds = {"int": "bigint", "real": "double"}
    bad = [
        F.when((F.coalesce(F.to_json(at(F.col("v"), n)), F.lit("null")) != "null") & typed(at(F.col("v"), n), kinds[k]).isNull(), F.lit(n))
        for n, k in TABLES[table].columns if k != "text"
    ]
    marked = lines.withColumn("columns", F.array_compact(F.array(*bad)) if bad else F.expr("cast(array() as array<string>)"))
    return marked.filter(F.size("columns") > 0).drop("v")
