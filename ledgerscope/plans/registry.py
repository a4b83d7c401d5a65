"""Queries of the engine over the driver's tables, and the SQL that they are checked against.

The public-records model is laid over the test tables: line items are contracts (city: the supplier's nation),
orders are procurements, events are expense events, pages and documents are snapshots.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.functions import expr as E
from ledgerscope.functions.windows import date_windows, request_grid, windows_between
from ledgerscope.operators import audit, concentration, merge, normalize, provenance, scope
from ledgerscope.plans import store
from ledgerscope.schemas import TABLES, Table
from ledgerscope.sources.city import CityConfig

CITY = CityConfig("brazil", " Nation_7 ", "BR", "2")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame) -> DataFrame:
    """rows over all cores where their scan has fewer parts than that: parsing records costs far more than one small shuffle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _contracts(spark: SparkSession, sf_dir: str, city: bool = False, loose: bool = False) -> DataFrame:
    """Line items as contracts; loose ones lack the supplier on line 1."""
    supplier = _t(spark, sf_dir, "supplier")
    if city:
        supplier = supplier.join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = _t(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    document = F.col("s_suppkey").cast("string")
    return rows.select(
        (F.col("n_name") if city else F.lit("all")).alias("city_slug"),
        (F.when(F.col("l_linenumber") != 1, document) if loose else document).alias("supplier_document"),
        F.col("s_name").alias("supplier_name"), F.col("l_extendedprice").alias("global_value"),
    )


def supplier_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.of_city(_contracts(spark, sf_dir), "all", "decimal(18,2)")


def concentration_null_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.of_city(_contracts(spark, sf_dir, loose=True), "all", "decimal(18,2)")


def concentration_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concentration.by_city(_contracts(spark, sf_dir, city=True), "decimal(18,2)")


_CONTRACT_LINES = Table(
    (("control", "text"), ("l_orderkey", "int"), ("l_linenumber", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_extendedprice", "real")),
    ("control",), ("l_orderkey",),
)


def _lines(spark: SparkSession, sf_dir: str, loose: bool = False) -> DataFrame:
    control = F.concat_ws("-", "l_orderkey", "l_linenumber")
    rows = _t(spark, sf_dir, "lineitem").withColumn("control", F.when(F.col("l_linenumber") != 1, control) if loose else control)
    rows = rows.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    return rows.withColumn("seq", F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity")).select(*_CONTRACT_LINES.names, "seq")


def contracts_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.first_wins(_lines(spark, sf_dir), _CONTRACT_LINES, "seq")


def null_key_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.first_wins(_lines(spark, sf_dir, loose=True), _CONTRACT_LINES, "seq")


def distinct_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir, loose=True).withColumn("control", F.coalesce("control", F.lit(""))).select("control", "l_orderkey", "l_partkey", "seq")
    return merge.distinct_seen(rows, "control", "seq").drop("seq")


_EVENTS = Table((("user_id", "int"), ("event_type", "text"), ("event_id", "int"), ("value", "real")), ("user_id", "event_type"), ("user_id",))


def events_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", F.col("event_id").alias("seq"))
    return merge.last_wins(rows, _EVENTS, "seq")


def upsert_all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events arrive at a store that has the even ones: every event is on one side."""
    rows = _t(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", F.col("event_id").alias("seq"))
    arriving = F.coalesce(F.pmod("event_id", F.lit(2)) == 1, F.lit(False))
    return merge.last_wins(rows.filter(arriving), _EVENTS, "seq", merge.last_wins(rows.filter(~arriving), _EVENTS, "seq"))


_ORDERS = Table((("o_orderkey", "int"), ("o_totalprice", "real")), ("o_orderkey",), ("o_orderkey",))


def insert_ignore_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are offered to a store that has the orders with line items: only the others come in."""
    stored = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("o_totalprice", F.lit(-1.0))
    new = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderkey").alias("seq"))
    return merge.first_wins(new, _ORDERS, "seq", stored).filter("o_totalprice >= 0")


def supplier_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as first seen in contracts by arrival, not by smallest date."""
    rows = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    seq = F.struct("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")
    rows = rows.select(F.col("s_suppkey").cast("string").alias("document"), F.col("s_name").alias("name"), F.col("l_shipdate").alias("first_observed_at"), seq.alias("seq"))
    return merge.winners(rows, ["document"], "seq").select("document", "name", "first_observed_at")


def _orders_by_window(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = _t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_totalprice")
    bounds = orders.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    # Windows have one length, so an order's window is found by arithmetic: an equi-join, not a range join.
    number = lambda day: F.floor(F.datediff(day, "first") / 30).cast("int")
    dated = orders.crossJoin(F.broadcast(bounds.select("first")))
    sums = dated.groupBy(number("day").alias("number")).agg(F.count("*").alias("orders"), E.money_sum(F.col("o_totalprice"), "decimal(18,2)").alias("total"))
    return windows_between(bounds, 30).withColumn("number", number("start")).drop("first"), sums


def date_windows_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their value by windows of 30 days from the first order's day to the last one's."""
    windows, sums = _orders_by_window(spark, sf_dir)
    return windows.join(sums, "number", "left").select(
        F.date_format("start", "yyyy-MM-dd").alias("window_start"), F.date_format("end", "yyyy-MM-dd").alias("window_end"),
        F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0.0)).alias("total"),
    )


def request_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = date_windows(spark, date(2026, 1, 1), date(2026, 2, 15), 30)
    grid = request_grid(_t(spark, sf_dir, "region").select("r_regionkey"), windows)
    return grid.select("r_regionkey", F.date_format("start", "yyyyMMdd").alias("first_day"), F.date_format("end", "yyyyMMdd").alias("last_day"))


def _raw_procurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the portal's loose JSON, with keys that differ by case and falsy alternatives."""
    rows = _spread(_t(spark, sf_dir, "orders")).join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    odd = F.col("o_orderkey") % 2 == 1
    record = F.struct(
        F.when(odd, "").otherwise(F.col("o_orderkey").cast("string")).alias("numeroControlePNCP"),
        F.col("o_orderkey").cast("string").alias("numeroControlePncp"),
        F.year("o_orderdate").alias("anoCompra"), F.col("o_orderpriority").alias("modalidadeNome"), F.col("o_totalprice").alias("valorTotalEstimado"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dataPublicacaoPncp"),
        F.struct(
            F.lit("M").alias("esferaId"), F.when(F.col("o_orderstatus") == "F", "E").otherwise("L").alias("poderId"),
            F.when(odd, "").otherwise(F.col("c_name")).alias("razaosocial"), F.col("c_mktsegment").alias("razaoSocial"),
        ).alias("orgaoEntidade"),
        F.struct(
            F.concat(F.lit(" "), F.lower("n_name"), F.lit("\t")).alias("municipioNome"), F.lit(0).alias("codigoIbge"),
            F.when(F.col("n_nationkey") != 7, F.col("n_nationkey")).alias("municipioId"),
        ).alias("unidadeOrgao"),
    )
    return rows.select("o_orderkey", F.parse_json(F.to_json(record)).alias("record"), F.lit("2026-01-01").alias("observed_at"), F.lit("sha").alias("snapshot_sha256"))


def normalize_procurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.procurements(_raw_procurements(spark, sf_dir).drop("o_orderkey"), CITY)


def scope_procurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_procurements(spark, sf_dir)
    return rows.filter(scope.procurement_in_scope(F.col("record"), CITY, "executivo")).select("o_orderkey")


def _raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(_t(spark, sf_dir, "lineitem")).join(_t(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    even = F.col("l_orderkey") % 2 == 0
    org = F.struct(F.lpad(F.col("l_suppkey").cast("string"), 14, "0").alias("cnpj"), F.col("s_name").alias("nome"), F.lit("M").alias("esfera"), F.col("l_returnflag").alias("poder"))
    record = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("numeroControlePNCP"), F.col("l_orderkey").cast("string").alias("numeroControlePncpCompra"),
        F.year("l_shipdate").alias("anoContrato"), F.when(even, F.col("l_linenumber")).otherwise(0).alias("sequencialContrato"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("sequencial"),
        F.when(even, org).alias("orgaoEntidade"), F.when(~even, org).alias("orgao"),
        F.struct(F.col("n_nationkey").alias("codigoIbgeMunicipio"), F.lit("").alias("ufSigla"), F.col("n_name").alias("nomeMunicipio")).alias("unidadeExecutora"),
        F.col("s_suppkey").cast("string").alias("niFornecedor"), F.col("s_name").alias("nomeRazaoSocialFornecedor"), F.col("l_extendedprice").alias("valorGlobal"),
        F.when(F.col("l_returnflag") == "A", "http://x.example/y").alias("linkSistemaOrigem"),
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.parse_json(F.to_json(record)).alias("record"), F.lit("2026-01-01").alias("observed_at"), F.lit("sha").alias("snapshot_sha256"))


def normalize_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.contracts(_raw_contracts(spark, sf_dir).drop("l_orderkey", "l_linenumber", "l_partkey"), CITY)


def scope_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_contracts(spark, sf_dir)
    city = CityConfig("x", "nation_3", "BR", "2")
    return rows.filter(scope.contract_in_scope(F.col("record"), city, "municipal")).select("l_orderkey", "l_linenumber", "l_partkey")


def seed_null_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed cells: '' is null, numbers are read strictly."""
    rows = _t(spark, sf_dir, "orders")
    cell = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.format_string(" %.2f ", "o_totalprice"))
    year = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.year("o_orderdate").cast("string"))
    return rows.select("o_orderkey", E.strict_double(E.blank_to_null(cell)).alias("estimated_value"), E.strict_long(E.blank_to_null(year)).alias("year"))


def cnpj_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    punctuated = F.concat(F.substring("k", 1, 2), F.lit("."), F.substring("k", 3, 6), F.lit("/"), F.expr("substring(k, 9)"))
    keys = _t(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 4 == 0, 12).otherwise(14), F.lit("0")).alias("k"))
    both = keys.select(punctuated.alias("k")).unionByName(keys)
    return both.filter(E.is_cnpj(F.col("k"))).select(E.digits(F.col("k")).alias("cnpj")).distinct()


def cnpj_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_t(spark, sf_dir, n).select(F.col(c).cast("string").alias("cnpj")) for n, c in (("customer", "c_custkey"), ("supplier", "s_suppkey"))]
    return parts[0].unionByName(parts[1]).distinct()


def active_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of 100 customer numbers each, with an entry per customer: ids as numbers and texts, some inactive."""
    item = F.struct(
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise(F.concat(F.lit('"'), F.col("c_nationkey"), F.lit('"'))).alias("id"),
        (F.col("c_nationkey") % 5 != 0).cast("string").alias("active"),
    )
    entry = F.concat(F.lit('{"id":'), item["id"], F.lit(',"statusAtivo":'), item["active"], F.lit("}"))
    payload = _t(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 100").alias("page")).agg(F.concat(F.lit('{"data":['), F.array_join(F.collect_list(entry), ","), F.lit("]}")).alias("payload"))
    return scope.active_modalities(payload)


def json_extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", E.typed(E.at(F.parse_json("props"), "k"), "bigint").alias("k"))


def expense_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage"))
    return rows.agg(F.count("*").alias("events"), E.money_sum(F.col("value"), "decimal(18,2)").alias("gross_value"))


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = _t(spark, sf_dir, "pages")
    kind = F.when(F.col("page_id") % 4 == 0, "application/json").when(F.col("page_id") % 4 == 1, "text/HTML; charset=utf-8").otherwise("")
    return page.select(
        F.col("page_id"), F.lit("pages").alias("source_id"), F.col("url").alias("requested_url"), F.col("url").alias("final_url"), F.lit(200).alias("status_code"),
        kind.alias("content_type"), F.lit("2026-01-01").alias("collected_at"), F.encode("html", "utf-8").alias("body"),
    )


def snapshot_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.described(_fetched(spark, sf_dir), "raw").select("page_id", "sha256", F.col("byte_count").cast("long").alias("byte_count"))


def safe_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.described(_fetched(spark, sf_dir), "raw").select("page_id", "suffix")


def snapshot_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "documents").select("doc_id", E.sha256_hex(F.col("text")).alias("sha256"))
    return rows.groupBy("sha256").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("fetches"))


def new_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of odd documents that even ones haven't stored yet."""
    rows = _t(spark, sf_dir, "documents").select(F.lit("documents").alias("source_id"), E.sha256_hex(F.col("text")).alias("sha256"), F.lit(".txt").alias("suffix"), F.col("text").alias("body"), "doc_id")
    stored = provenance.new_bodies(rows.filter("doc_id % 2 = 0"))
    return provenance.new_bodies(rows.filter("doc_id % 2 = 1"), stored).select("sha256", F.octet_length("body").cast("long").alias("byte_count"))


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    stops = _t(spark, sf_dir, "region").filter("r_regionkey < 0").select(F.col("r_name").alias("requested_url"), F.lit(503).alias("status_code"), F.col("r_regionkey").alias("seq"))
    return provenance.coverage(rows, stops).select("complete", "records", "stopped_url", "stopped_status")


def coverage_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of a collection that was cut several times: the first stop counts."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    stops = _t(spark, sf_dir, "region").select(F.col("r_name").alias("requested_url"), (F.col("r_regionkey") + 500).cast("int").alias("status_code"), F.col("r_regionkey").alias("seq"))
    return provenance.coverage(rows, stops).select("complete", "records", "stopped_url", "stopped_status")


def manifest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows against pages as snapshots: two rows a snapshot, of which some name another time of observation, and short ones none."""
    sha = lambda c: F.sha2(c.cast("string"), 256)
    time = lambda c: F.concat(F.lit("t"), F.col(c) % 3)
    rows = _t(spark, sf_dir, "documents").select(F.when(F.col("n_chars") > 40, sha(F.expr("doc_id div 2"))).alias("snapshot_sha256"), time("doc_id").alias("observed_at"))
    pages = _t(spark, sf_dir, "pages").select(sha(F.col("page_id")).alias("sha256"), time("page_id").alias("collected_at"))
    return audit.rows_to_manifest(rows, pages)


def expense_contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as expenses, purchases naming their user's contract, against orders as contracts of their customer."""
    number = F.when(F.col("event_type") == "purchase", F.col("user_id").cast("string"))
    expenses = _t(spark, sf_dir, "events").select(F.lit("all").alias("city_slug"), number.alias("contract_number"))
    contracts = _t(spark, sf_dir, "orders").select(F.lit("all").alias("city_slug"), F.col("o_custkey").cast("string").alias("contract_number"))
    return audit.expenses_to_contracts(expenses, contracts)


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.when(F.col("event_type").isin("purchase", "refund"), "expense_events").otherwise("revenue_events")
    return _t(spark, sf_dir, "events").groupBy(target.alias("target")).agg(F.count("*").alias("rows_read"))


def procurement_contract_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("contracts"), E.money_sum(F.col("l_extendedprice"), "decimal(18,2)").alias("contracted"))
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    linked = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return linked.select("o_orderkey", "o_totalprice", F.coalesce("contracts", F.lit(0)).alias("contracts"), "contracted")


def order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required minus present, over all line items: orders without any."""
    return _t(spark, sf_dir, "orders").select("o_orderkey").subtract(_t(spark, sf_dir, "lineitem").select("l_orderkey"))


def _store_root(spark: SparkSession) -> str:
    """A new store's folder in the shared folder of the session, or a temporary one where all runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerscope-")
    return f"{shared}/store-{uuid.uuid4().hex}"


def _as_table(rows: DataFrame, table: str, **columns) -> DataFrame:
    """rows as a table of the model, with null in columns that aren't given, and seq."""
    fields = TABLES[table].schema.fields
    return rows.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields], columns["seq"].alias("seq"))


def _merged_in_two(spark: SparkSession, rows: DataFrame, table: str, kind: type, later: str) -> DataFrame:
    """A table of a new store after two merges of one kind: the rows that aren't `later`, then those that are."""
    root = _store_root(spark)
    for condition in (f"not ({later})", later):
        store.merge(spark, root, {table: kind(rows.filter(condition))})
    return store.read(spark, root, table)


def store_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as expenses of their user, in two merges: a later one wins, within a merge the last event."""
    text = lambda c: F.col(c).cast("string")
    rows = _as_table(
        _t(spark, sf_dir, "events"), "expense_events", city_slug=F.lit("all"), source_system=F.lit("x"), event_key=text("user_id"), stage=F.lit("paid"),
        agency_code=text("event_id"), agency_name=F.col("event_type"), gross_value=F.col("value"), source_url=F.lit("u"), observed_at=F.lit("t"), seq=F.col("event_id"),
    )
    return _merged_in_two(spark, rows, "expense_events", store.Last, "coalesce(gross_value < 20, false)").select("event_key", "agency_code", "agency_name", "gross_value")


def store_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as procurements of their part, in two merges: an earlier one wins, within a merge the first line; lines of one supplier have no key and all stay."""
    control = F.when(F.col("l_suppkey") != 1, F.col("l_partkey").cast("string"))
    rows = _as_table(
        _t(spark, sf_dir, "lineitem"), "procurements", city_slug=F.lit("all"), source_system=F.lit("x"), pncp_control_number=control,
        process_number=F.concat_ws("-", "l_orderkey", "l_linenumber"), year=F.col("l_linenumber"), observed_at=F.lit("t"), seq=F.struct("l_orderkey", "l_linenumber"),
    )
    return _merged_in_two(spark, rows, "procurements", store.First, "year > 3").select("pncp_control_number", "process_number", "year")


_QUERIES = (
    supplier_concentration, concentration_null_supplier, concentration_by_city, contracts_first_wins, null_key_append, distinct_seen, events_last_wins,
    insert_ignore_existing, supplier_dimension, date_windows_rollup, request_grid_cells, normalize_procurement, scope_procurements,
    normalize_contract, scope_contracts, seed_null_normalise, cnpj_digits, cnpj_union, active_modalities, json_extract_props, expense_by_stage,
    snapshot_hash, safe_suffix, snapshot_dedupe, new_snapshots, coverage_report, ingest_counts, procurement_contract_link,
    upsert_all_events, order_gaps, coverage_stopped, manifest_audit, expense_contract_audit, store_last_wins, store_first_wins,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def _concentration_sql(document: str) -> str:
    return f"""
WITH c AS (SELECT {document} AS supplier_document, s_name AS supplier_name, l_extendedprice::DECIMAL(18,2) AS v
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
t AS (SELECT sum(v)::DOUBLE AS total FROM c),
g AS (SELECT supplier_document, supplier_name, count(*) AS contracts, sum(v)::DOUBLE AS known_global_value FROM c
      WHERE supplier_document IS NOT NULL GROUP BY ALL)
SELECT g.*, known_global_value / total AS share_of_known_value, 'descriptive_concentration_not_irregularity' AS label FROM g, t"""


def _first_sql(control: str) -> str:
    return f"""
WITH l AS (SELECT {control} AS control, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY control ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS rn FROM l)
SELECT control, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM r WHERE rn = 1 OR control IS NULL"""


_LOOSE = "CASE WHEN l_linenumber <> 1 THEN l_orderkey || '-' || l_linenumber END"


def oracle_sql() -> dict[str, str]:
    procurements, contracts = TABLES["procurements"], TABLES["contracts"]
    sql_kind = {"text": "VARCHAR", "int": "BIGINT", "real": "DOUBLE"}

    def projected(table: Table, known: dict[str, str]) -> str:
        return ", ".join(f"({known[n]})::{sql_kind[k]} AS {n}" if n in known else f"NULL::{sql_kind[k]} AS {n}" for n, k in table.columns)

    every = {"city_slug": "'brazil'", "source_system": "'PNCP'", "observed_at": "'2026-01-01'", "snapshot_sha256": "'sha'"}
    return {
        "supplier_concentration": _concentration_sql("s_suppkey::VARCHAR"),
        "concentration_null_supplier": _concentration_sql("CASE WHEN l_linenumber <> 1 THEN s_suppkey::VARCHAR END"),
        "concentration_by_city": """
WITH c AS (SELECT n_name AS city_slug, s_suppkey::VARCHAR AS supplier_document, s_name AS supplier_name, l_extendedprice::DECIMAL(18,2) AS v
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT city_slug, supplier_document, supplier_name, count(*) AS contracts, sum(v)::DOUBLE AS known_global_value FROM c GROUP BY ALL)
SELECT g.*, known_global_value / (SELECT sum(v)::DOUBLE FROM c WHERE c.city_slug = g.city_slug) AS share_of_known_value,
       'descriptive_concentration_not_irregularity' AS label FROM g""",
        "contracts_first_wins": _first_sql("l_orderkey || '-' || l_linenumber"),
        "null_key_append": _first_sql(_LOOSE),
        "distinct_seen": f"""
WITH l AS (SELECT coalesce({_LOOSE}, '') AS control, l_orderkey, l_partkey, row_number() OVER (
  PARTITION BY coalesce({_LOOSE}, 'none-' || l_orderkey || '-' || l_partkey) ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS rn FROM lineitem)
SELECT control, l_orderkey, l_partkey FROM l WHERE rn = 1""",
        "events_last_wins": """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
        "insert_ignore_existing": "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
        "supplier_dimension": """
SELECT s_suppkey::VARCHAR AS document, s_name AS name, l_shipdate AS first_observed_at FROM (SELECT *, row_number() OVER (
  PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice) AS rn FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey WHERE rn = 1""",
        "date_windows_rollup": """
WITH w AS (SELECT d::DATE AS s, least(d::DATE + 29, DATE '2001-08-01') AS e FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 30 DAY) t(d))
SELECT strftime(s, '%Y-%m-%d') AS window_start, strftime(e, '%Y-%m-%d') AS window_end, count(o_orderkey) AS orders, coalesce(sum(o_totalprice::DECIMAL(18,2)), 0)::DOUBLE AS total
FROM w LEFT JOIN orders ON o_orderdate::DATE BETWEEN s AND e GROUP BY ALL""",
        "request_grid_cells": "SELECT r_regionkey, first_day, last_day FROM region, (VALUES ('20260101', '20260130'), ('20260131', '20260215')) w(first_day, last_day)",
        "normalize_procurement": "SELECT " + projected(procurements, every | {
            "pncp_control_number": "o_orderkey::VARCHAR", "year": "year(o_orderdate)", "modality_name": "o_orderpriority", "sphere": "'M'",
            "power": "CASE WHEN o_orderstatus = 'F' THEN 'E' ELSE 'L' END", "agency_name": "CASE WHEN o_orderkey % 2 = 1 THEN c_mktsegment ELSE c_name END",
            "municipality_ibge": "CASE WHEN n_nationkey IN (0, 7) THEN '2' ELSE n_nationkey::VARCHAR END", "municipality_name": "' ' || lower(n_name) || chr(9)",
            "uf": "'BR'", "published_at": "strftime(o_orderdate, '%Y-%m-%d')", "estimated_value": "o_totalprice",
        }) + " FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
        "scope_procurements": """SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE lower(n_name) = 'nation_7' AND o_orderstatus = 'F'""",
        "normalize_contract": "SELECT " + projected(contracts, every | {
            "pncp_control_number": "l_orderkey || '-' || l_linenumber", "procurement_control_number": "l_orderkey::VARCHAR", "year": "year(l_shipdate)",
            "sequence": "CASE WHEN l_orderkey % 2 = 0 THEN l_linenumber WHEN l_linenumber > 1 THEN l_linenumber END",
            "agency_cnpj": "lpad(l_suppkey::VARCHAR, 14, '0')", "agency_name": "s_name", "sphere": "'M'", "power": "l_returnflag",
            "municipality_ibge": "CASE WHEN n_nationkey = 0 THEN '2' ELSE n_nationkey::VARCHAR END", "municipality_name": "n_name", "uf": "'BR'",
            "supplier_document": "s_suppkey::VARCHAR", "supplier_name": "s_name", "global_value": "l_extendedprice",
            "source_url": """CASE WHEN l_orderkey % 2 = 0 OR l_linenumber > 1
  THEN 'https://pncp.gov.br/api/pncp/v1/orgaos/' || lpad(l_suppkey::VARCHAR, 14, '0') || '/contratos/' || year(l_shipdate) || '/' || l_linenumber
  WHEN l_returnflag = 'A' THEN 'http://x.example/y' ELSE '' END""",
        }) + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey",
        "scope_contracts": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE n_nationkey = 2 OR lower(trim(n_name)) = 'nation_3'""",
        "seed_null_normalise": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN printf('%.2f', o_totalprice)::DOUBLE END AS estimated_value,
CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) END AS year FROM orders""",
        "cnpj_digits": "SELECT DISTINCT lpad(c_custkey::VARCHAR, 14, '0') AS cnpj FROM customer WHERE c_custkey % 4 <> 0",
        "cnpj_union": "SELECT c_custkey::VARCHAR AS cnpj FROM customer UNION SELECT s_suppkey::VARCHAR FROM supplier",
        "active_modalities": "SELECT DISTINCT c_nationkey::BIGINT AS id FROM customer WHERE c_nationkey % 5 <> 0",
        "json_extract_props": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
        "expense_by_stage": "SELECT event_type AS stage, count(*) AS events, sum(value::DECIMAL(18,2))::DOUBLE AS gross_value FROM events GROUP BY ALL",
        "snapshot_hash": "SELECT page_id, sha256(html) AS sha256, octet_length(encode(html))::BIGINT AS byte_count FROM pages",
        "safe_suffix": r"""WITH p AS (SELECT page_id, regexp_extract(regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', ''), '[^/]*$') AS name FROM pages),
s AS (SELECT page_id, lower(regexp_extract(regexp_replace(name, ';.*$', ''), '[^.](\.[^.]+)$', 1)) AS suffix FROM p)
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '.json' WHEN page_id % 4 = 1 THEN '.html' WHEN suffix <> '' AND length(suffix) <= 8 THEN suffix ELSE '.bin' END AS suffix FROM s""",
        "snapshot_dedupe": "SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, count(*) AS fetches FROM documents GROUP BY 1",
        "new_snapshots": """SELECT DISTINCT sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS byte_count FROM documents d WHERE doc_id % 2 = 1
AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 2 = 0 AND e.text = d.text)""",
        "store_last_wins": """
            WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(value < 20, false) DESC, event_id DESC) AS r FROM events WHERE user_id IS NOT NULL)
            SELECT user_id::VARCHAR AS event_key, event_id::VARCHAR AS agency_code, event_type AS agency_name, value AS gross_value FROM ranked WHERE r = 1""",
        "store_first_wins": """
            WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber > 3, l_orderkey, l_linenumber) AS r FROM lineitem WHERE l_suppkey <> 1)
            SELECT l_partkey::VARCHAR AS pncp_control_number, l_orderkey || '-' || l_linenumber AS process_number, l_linenumber::BIGINT AS year FROM ranked WHERE r = 1
            UNION ALL SELECT NULL, l_orderkey || '-' || l_linenumber, l_linenumber::BIGINT FROM lineitem WHERE l_suppkey = 1""",
        "coverage_stopped": """SELECT false AS complete, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS records,
            arg_min(r_name, r_regionkey) AS stopped_url, (500 + min(r_regionkey))::INTEGER AS stopped_status FROM region""",
        "manifest_audit": """
            WITH d AS (SELECT CASE WHEN n_chars > 40 THEN sha256((doc_id // 2)::VARCHAR) END AS snapshot_sha256, 't' || (doc_id % 3) AS observed_at FROM documents),
            l AS (SELECT CASE WHEN snapshot_sha256 IS NOT NULL THEN snapshot_sha256 END AS k, CASE WHEN snapshot_sha256 IS NOT NULL THEN observed_at END AS t, count(*) AS n FROM d GROUP BY 1, 2),
            r AS (SELECT sha256(page_id::VARCHAR) AS k, 't' || (page_id % 3) AS t, count(*) AS n FROM pages GROUP BY 1, 2)
            SELECT coalesce(l.k, r.k) AS snapshot_sha256, coalesce(l.t, r.t) AS observed_at, coalesce(l.n, 0) AS sources, coalesce(r.n, 0) AS targets,
                CASE WHEN l.n IS NULL THEN 'never_referred_to' WHEN l.k IS NULL THEN 'no_reference' WHEN r.n IS NULL THEN 'target_missing' ELSE 'matched' END AS class
            FROM l FULL JOIN r ON l.k = r.k AND l.t = r.t""",
        "expense_contract_audit": """
            WITH l AS (SELECT CASE WHEN event_type = 'purchase' THEN user_id::VARCHAR END AS k, count(*) AS n FROM events GROUP BY 1),
            r AS (SELECT o_custkey::VARCHAR AS k, count(*) AS n FROM orders GROUP BY 1)
            SELECT CASE WHEN coalesce(l.k, r.k) IS NOT NULL THEN 'all' END AS city_slug, coalesce(l.k, r.k) AS contract_number, coalesce(l.n, 0) AS sources, coalesce(r.n, 0) AS targets,
                CASE WHEN l.n IS NULL THEN 'never_referred_to' WHEN l.k IS NULL THEN 'no_reference' WHEN r.n IS NULL THEN 'target_missing' ELSE 'matched' END AS class
            FROM l FULL JOIN r ON l.k = r.k""",
        "coverage_report": """SELECT true AS complete, count(*) AS records, NULL::VARCHAR AS stopped_url, NULL::INTEGER AS stopped_status FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
        "ingest_counts": "SELECT CASE WHEN event_type IN ('purchase', 'refund') THEN 'expense_events' ELSE 'revenue_events' END AS target, count(*) AS rows_read FROM events GROUP BY 1",
        "procurement_contract_link": """SELECT o_orderkey, o_totalprice, count(l_orderkey) AS contracts, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS contracted
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
        "upsert_all_events": """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY abs(event_id) % 2 DESC, event_id DESC) AS rn
FROM events) WHERE rn = 1""",
        "order_gaps": "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
    }
