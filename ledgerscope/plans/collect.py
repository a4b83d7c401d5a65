"""REST sources to normalised JSON lines, by way of raw pages that are written first."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date
from urllib.parse import urlencode

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.functions.expr import canonical_json, digits, is_cnpj
from ledgerscope.functions.windows import date_windows, request_grid
from ledgerscope.operators import normalize, provenance, scope
from ledgerscope.operators.merge import distinct_seen
from ledgerscope.schemas import TABLES
from ledgerscope.sources import paged
from ledgerscope.sources.city import CityConfig
from ledgerscope.sources.seeds import parsed, read_lines


def _grid(cells: DataFrame, params: dict) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyyMMdd")
    full = F.struct(day("start").alias("dataInicial"), day("end").alias("dataFinal"), *[c.alias(k) for k, c in params.items()])
    return cells.select(F.col("series"), F.to_json(full).alias("params"))


def _log(spark: SparkSession, out: str) -> DataFrame | None:
    """The pages that were written so far, of all runs."""
    try:
        return spark.read.schema(f"{paged.PAGES}, params string, run string, sha256 string, byte_count int, suffix string, body_path string").parquet(f"{out}/pages")
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return None


def _landed(grid: DataFrame, out: str, url: str, source_id: str, page_size: int, pause: float, fetch: paged.Fetch, *more, resume: bool, first_stop: bool, round_pages: int) -> DataFrame:
    """The pages of a grid (series, params), from a log that grows by `round_pages` pages of each series at a time.

    A run that is stopped loses its last round at most. With resume, series go on after their last page in the log, whichever run
    wrote it, and ended series ask for nothing; a page at which a series was cut is asked for again. With first_stop, series
    behind the first one that was cut are left out, as a sequential run would never have come to them.
    """
    spark, run = grid.sparkSession, uuid.uuid4().hex
    grid = spark.createDataFrame(grid.collect(), grid.schema)  # a row a request series: what the driver plans with
    fresh = not resume
    while True:
        log = None if fresh else _log(spark, out)
        todo = grid.withColumn("next", F.lit(1))
        if log is not None:
            state = log.groupBy("params").agg(
                F.coalesce(F.max(F.when(~F.col("stopped"), F.col("page"))), F.lit(0)).alias("page"),
                F.max(F.col("last") | (F.col("stopped") & (F.col("run") == run))).alias("ended"),
            )
            todo = grid.join(F.broadcast(state), "params", "left").filter(~F.coalesce("ended", F.lit(False)))
            todo = todo.select("series", "params", (F.coalesce("page", F.lit(0)) + 1).alias("next"))
        if log is not None and todo.isEmpty():
            break
        pages = paged.fetch_pages(todo, url, source_id, page_size, pause, fetch, *more, limit=round_pages).join(F.broadcast(grid), "series").withColumn("run", F.lit(run))
        provenance.described(pages, f"{out}/snapshots").write.mode("overwrite" if fresh else "append").parquet(f"{out}/pages")
        fresh = False
    logged = log.join(F.broadcast(grid.select("params")), "params", "left_semi").drop("series").join(F.broadcast(grid), "params")
    # Of a page that was asked for several times the last good answer counts; a cut counts if it is this run's.
    landed = logged.filter(~F.col("stopped") | (F.col("run") == run))
    if first_stop:
        cut = landed.filter("stopped").agg(F.min("series")).first()[0]
        landed = landed if cut is None else landed.filter(F.col("series") <= cut)
    new = logged.filter(F.col("run") == run).select("source_id", "requested_url", "final_url", "status_code", "content_type", "collected_at", "body")
    provenance.append_snapshots(new, f"{out}/snapshots")
    return landed


def replayed(grid: DataFrame, out: str, url: str, source_id: str) -> DataFrame:
    """The pages of a grid (series, params) from the manifest and the stored bodies alone, as _landed gives them: no request is made.

    A page that was asked for several times counts as it came last. The addresses in the manifest are matched by their parameters.
    """
    spark = grid.sparkSession
    manifest = spark.read.json(f"{out}/snapshots/manifest", schema="source_id string, requested_url string, final_url string, status_code int, content_type string, collected_at string, sha256 string")
    pages = manifest.filter(F.col("source_id").isin(source_id, f"{source_id}_limitada")).withColumns({
        "key": F.regexp_replace("requested_url", r"&pagina=\d+&tamanhoPagina=\d+$", ""), "page": F.regexp_extract("requested_url", r"&pagina=(\d+)&", 1).cast("long"),
    })
    pages = pages.groupBy("key", "page").agg(F.max_by(F.struct("source_id", "requested_url", "final_url", "status_code", "content_type", "collected_at", "sha256"), "collected_at").alias("p"))
    asked = spark.createDataFrame([(r["series"], r["params"], f"{url}?{urlencode(json.loads(r['params']))}") for r in grid.collect()], "series long, params string, key string")
    pages = pages.join(F.broadcast(asked), "key").select("series", "page", "params", "p.*")
    bodies = spark.read.parquet(f"{out}/snapshots/bodies").select("source_id", "sha256", "body").dropDuplicates(["source_id", "sha256"])
    return pages.join(bodies, ["source_id", "sha256"]).withColumn("stopped", F.col("source_id") != source_id)


def _records(landed: DataFrame) -> DataFrame:
    good = landed.filter("not stopped").select(F.col("body").cast("string").alias("body"), "status_code", "collected_at", "sha256", "series", "page")
    rows = normalize.records_of_pages(good)
    return rows.withColumn("seq", F.struct("series", "page", "pos")).drop("series", "page", "pos")


def _write_lines(rows: DataFrame, table: str, path: str) -> DataFrame:
    rows = distinct_seen(rows, "pncp_control_number", "seq").drop("seq")
    rows.select(canonical_json(TABLES[table].names).alias("value")).write.mode("overwrite").text(path)
    return rows


def discover_modalities(spark: SparkSession, out: str, fetch: paged.Fetch = paged.http_get, replay: bool = False) -> DataFrame:
    """(id) of the active modalities, from one request that is archived, or from the last one in the archive."""
    if replay:
        seen = spark.read.json(f"{out}/snapshots/manifest", schema="source_id string, collected_at string, sha256 string").filter("source_id = 'pncp_modalidades'")
        last = seen.agg(F.max_by("sha256", "collected_at").alias("sha256"))
        bodies = spark.read.parquet(f"{out}/snapshots/bodies").filter("source_id = 'pncp_modalidades'").join(last, "sha256", "left_semi")
        return scope.active_modalities(bodies.select(F.col("body").cast("string").alias("payload")))
    answer = paged.patient_get(fetch, paged.MODALITIES_URL, {"statusAtivo": "true"})
    if answer.status >= 400:
        raise RuntimeError(f"status {answer.status} from {paged.MODALITIES_URL}")
    row = ("pncp_modalidades", paged.MODALITIES_URL, answer.url or paged.MODALITIES_URL, answer.status, answer.content_type, str(pd.Timestamp.now("UTC")), answer.body)
    fetched = spark.createDataFrame([row], "source_id string, requested_url string, final_url string, status_code int, content_type string, collected_at string, body binary")
    provenance.append_snapshots(fetched, f"{out}/snapshots")
    return scope.active_modalities(fetched.select(F.col("body").cast("string").alias("payload")))


def collect_procurements(
    spark: SparkSession, city: CityConfig, start: date, end: date, out: str, branch: str = "executivo", fetch: paged.Fetch = paged.http_get,
    page_size: int = paged.PROCUREMENT_PAGE, pause: float = paged.PROCUREMENT_PAUSE, *, resume: bool = False, first_stop: bool = False, replay: bool = False,
    round_pages: int = 50,
) -> str:
    """Procurement notices of a city in a period; returns the folder of JSON lines.

    A source that stays unavailable ends its series; the records so far are kept and coverage says so. resume goes on after
    the pages that earlier runs have logged; first_stop leaves out all series behind the first that was cut; replay takes all
    pages from the archive and asks for none.
    """
    modalities = discover_modalities(spark, out, fetch, replay)
    cells = request_grid(modalities, date_windows(spark, start, end))
    cells = cells.withColumn("series", F.datediff("start", F.lit(start)) * 100_000 + F.col("id"))
    grid = _grid(cells, {"codigoModalidadeContratacao": F.col("id"), "uf": F.lit(city.uf), "codigoMunicipioIbge": F.lit(city.ibge_code)})
    if replay:
        landed = replayed(grid, out, paged.PROCUREMENTS_URL, "pncp_consulta")
    else:
        landed = _landed(grid, out, paged.PROCUREMENTS_URL, "pncp_consulta", page_size, pause, fetch, resume=resume, first_stop=first_stop, round_pages=round_pages)
    rows = _records(landed)
    rows = normalize.procurements(rows.filter(scope.procurement_in_scope(F.col("record"), city, branch)), city)
    path = f"{out}/contratacoes_{branch}_{start}_{end}.jsonl"
    rows = _write_lines(rows, "procurements", path)
    stops = landed.filter("stopped").select("requested_url", "status_code", F.struct("series", "page").alias("seq"))
    provenance.coverage(rows, stops).write.mode("overwrite").json(f"{out}/coverage", ignoreNullFields=False)
    return path


def agency_cnpjs(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(cnpj) of the agencies in procurement files: digits only, 14 of them, distinct and ascending."""
    lines = read_lines(spark, paths, missing_ok=True)
    raw = F.try_variant_get(parsed(F.col("value")), "$.agency_cnpj", "string")
    return lines.select(raw.alias("c")).filter(is_cnpj(F.col("c"))).select(digits(F.col("c")).alias("cnpj")).distinct().orderBy("cnpj")


def collect_contracts(
    spark: SparkSession, city: CityConfig, start: date, end: date, out: str, cnpjs: DataFrame, branch: str = "executivo",
    fetch: paged.Fetch = paged.http_get, page_size: int = paged.CONTRACT_PAGE, pause: float = paged.CONTRACT_PAUSE, *, resume: bool = False, replay: bool = False,
    round_pages: int = 50,
) -> str:
    """Contracts of the agencies in cnpjs (cnpj); returns the folder of JSON lines. A failing source fails the job.

    No agency at all is an error; agencies whose id hasn't 14 digits are left out. resume goes on after the pages that a
    failed run has logged; replay takes all pages from the archive and asks for none.
    """
    known = cnpjs.filter("cnpj is not null and cnpj <> ''").select(digits(F.col("cnpj")).alias("cnpj")).distinct()
    if known.isEmpty():
        raise ValueError("no agency id to collect contracts for")
    cells = request_grid(known.filter(F.length("cnpj") == 14), date_windows(spark, start, end))
    # Series are taken up agency by agency, in each window by window: 14 digits of the id, four of the window.
    cells = cells.withColumn("series", F.col("cnpj").cast("long") * 10_000 + F.floor(F.datediff("start", F.lit(start)) / 30))
    grid = _grid(cells, {"cnpjOrgao": F.col("cnpj")})
    if replay:
        landed = replayed(grid, out, paged.CONTRACTS_URL, "pncp_contratos")
    else:
        landed = _landed(grid, out, paged.CONTRACTS_URL, "pncp_contratos", page_size, pause, fetch, paged.single_retry_get, resume=resume, first_stop=False, round_pages=round_pages)
    rows = _records(landed)
    rows = normalize.contracts(rows.filter(scope.contract_in_scope(F.col("record"), city, branch)), city)
    path = f"{out}/contratos_{branch}_{start}_{end}.jsonl"
    _write_lines(rows, "contracts", path)
    return path


def collect_pages(sources: DataFrame, out: str, fetch: paged.Fetch = paged.http_get) -> DataFrame:
    """Archives the page of each source (id, url); one result row each, errors included, never failing the job."""

    def work(batches):
        for batch in batches:
            rows = []
            for source_id, url in zip(batch["id"], batch["url"]):
                row = {"source_id": source_id, "requested_url": url, "collected_at": str(pd.Timestamp.now("UTC")), "final_url": None, "status_code": None, "content_type": None, "body": None, "error": None}
                try:
                    a = paged.stubborn_get(fetch, url)
                    row |= {"final_url": a.url or url, "status_code": a.status, "content_type": a.content_type, "body": a.body}
                except Exception as problem:  # one source's failure is a row, not the job's
                    row["error"] = str(problem)
                rows.append(row)
            yield pd.DataFrame(rows, columns=["source_id", "requested_url", "final_url", "status_code", "content_type", "collected_at", "body", "error"])

    wanted = sources.select(F.trim("id").alias("id"), F.trim("url").alias("url")).filter("id <> '' and url <> ''")
    schema = "source_id string, requested_url string, final_url string, status_code int, content_type string, collected_at string, body binary, error string"
    path = f"{out}/results"
    wanted.repartition(4).mapInPandas(work, schema).write.mode("overwrite").parquet(path)
    landed = sources.sparkSession.read.parquet(path)
    provenance.append_snapshots(landed.filter("error is null").drop("error"), out)
    ok = F.col("error").isNull()
    return landed.select(
        "source_id", ok.alias("ok"), F.when(ok, F.sha2("body", 256)).alias("sha256"), F.col("status_code").alias("status"), "final_url", "error",
    )


def union_cnpjs(spark: SparkSession, city: CityConfig, given: Iterable[str], procurements: Iterable[str]) -> DataFrame:
    """(cnpj): ids given, those of procurement files and the municipality's own, distinct."""
    rows = [(c,) for c in [*given, city.municipality_cnpj] if c]
    return spark.createDataFrame(rows, "cnpj string").unionByName(agency_cnpjs(spark, procurements)).distinct()


def as_json(frame: DataFrame) -> str:
    """A small result as indented JSON for the command line."""
    return json.dumps([r.asDict() for r in frame.collect()], ensure_ascii=False, indent=2)
