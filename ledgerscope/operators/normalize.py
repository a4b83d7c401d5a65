"""Loose JSON records to the fixed columns of the model.

A mapping says, for each column, which alternatives to try in turn. Values are read from VARIANT, which keeps
keys that differ by case apart and tells 0, "" and {} from missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import loose
from ledgerscope.functions.expr import at, exploded, first_truthy
from ledgerscope.functions.loose import Loose
from ledgerscope.schemas import TABLES
from ledgerscope.sources.city import CityConfig

# Keys of the portal's records by output column, in the order in which they are tried; org. and unit.
# stand for the objects below, city. for the city's own value.
SOURCE_SYSTEM = "PNCP"
CONTRACT_DETAIL = "https://pncp.gov.br/api/pncp/v1/orgaos/%s/contratos/%s/%s"
PROCUREMENT_OBJECTS = {"org": ["orgaoEntidade"], "unit": ["unidadeOrgao"]}
CONTRACT_OBJECTS = {"org": ["orgaoEntidade", "orgao"], "unit": ["unidadeOrgao", "unidadeExecutora"]}
PROCUREMENT_KEYS = {
    "pncp_control_number": "numeroControlePNCP numeroControlePncp",
    "process_number": "processo",
    "notice_number": "numeroCompra",
    "year": "anoCompra",
    "modality_id": "modalidadeId",
    "modality_name": "modalidadeNome",
    "object": "objetoCompra",
    "agency_cnpj": "org.cnpj",
    "agency_name": "org.razaosocial org.razaoSocial",
    "sphere": "org.esferaId",
    "power": "org.poderId",
    "unit_code": "unit.codigoUnidade",
    "unit_name": "unit.nomeUnidade",
    "municipality_ibge": "unit.codigoIbge unit.municipioId city.ibge_code",
    "municipality_name": "unit.municipioNome",
    "uf": "unit.ufSigla city.uf",
    "published_at": "dataPublicacaoPncp",
    "proposal_opening_at": "dataAberturaProposta",
    "proposal_closing_at": "dataEncerramentoProposta",
    "estimated_value": "valorTotalEstimado",
    "homologated_value": "valorTotalHomologado",
    "status_name": "situacaoCompraNome",
    "source_url": "linkSistemaOrigem linkProcessoEletronico",
}
CONTRACT_KEYS = {
    "pncp_control_number": "numeroControlePNCP numeroControlePncp",
    "procurement_control_number": "numeroControlePNCPCompra numeroControlePncpCompra",
    "contract_number": "numeroContratoEmpenho",
    "year": "anoContrato",
    "sequence": "sequencialContrato sequencial",
    "contract_type_id": "tipoContratoId",
    "contract_type_name": "tipoContratoNome",
    "process_number": "processo",
    "object": "objetoContrato",
    "agency_cnpj": "org.cnpj",
    "agency_name": "org.razaoSocial org.razaosocial org.nome",
    "sphere": "org.esferaId org.esfera",
    "power": "org.poderId org.poder",
    "unit_code": "unit.codigoUnidade unit.codigo",
    "unit_name": "unit.nomeUnidade",
    "municipality_ibge": "unit.codigoIbge unit.codigoIbgeMunicipio unit.municipioId city.ibge_code",
    "municipality_name": "unit.municipioNome unit.nomeMunicipio city.name",
    "uf": "unit.ufSigla unit.uf city.uf",
    "supplier_type": "tipoPessoa",
    "supplier_document": "niFornecedor",
    "supplier_name": "nomeRazaoSocialFornecedor",
    "initial_value": "valorInicial",
    "global_value": "valorGlobal",
    "accumulated_value": "valorAcumulado",
    "installments": "numeroParcelas",
    "installment_value": "valorParcela",
    "signed_at": "dataAssinatura",
    "valid_from": "dataVigenciaInicio",
    "valid_to": "dataVigenciaFim",
    "published_at": "dataPublicacaoPncp",
    "updated_at": "dataAtualizacao",
}

#: Keys that no column is read from alone.
_LINKS = {"": "linkSistemaOrigem"}

_KIND = {"text": "string", "int": "bigint", "real": "double"}


def _read(rows: DataFrame, keys: dict[str, str], objects: dict[str, list[str]]) -> tuple[DataFrame, Loose]:
    """rows with the texts of every key in use, and how to ask for them. A record is read once, its objects with it."""
    used = sorted({k for chain in keys.values() for k in chain.split() if not k.startswith("city.")})
    of = {base: [k.partition(".")[2] for k in used if k.startswith(f"{base}.")] for base in objects}
    record, read = F.col("record"), F.col("__read")
    rows = rows.withColumn("__read", loose.members(record, loose.paths(used, objects)))
    rows = rows.withColumns({f"__{path}": loose.is_there(record, read, path, of[base]) for base, places in objects.items() for path in places[:-1]})
    there = {path: F.col(f"__{path}") for places in objects.values() for path in places[:-1]}
    found = Loose(record, objects, {"": read} | {base: F.col(f"__{base}") for base in objects}, there)
    return rows.withColumns({f"__{base}": found.chosen(base, lambda path: read[loose.name(path)]) for base in objects}), found


def _value(found: Loose, chain: str, kind: str, city: CityConfig) -> Column:
    """The first truthy key of a chain; else the city's value, or the last key as it is."""
    *tried, last = chain.split()
    if last.startswith("city."):
        return found.first(tried, kind, F.lit(getattr(city, last[5:])).cast(kind))
    return found.first([*tried, last], kind)


def _normalized(rows: DataFrame, table: str, keys: dict[str, str], objects: dict, city: CityConfig, more=lambda found: {}) -> DataFrame:
    kinds = dict(TABLES[table].columns)
    kept = [F.col(c) for c in rows.columns if c not in kinds and c != "record"]
    rows, found = _read(rows, keys | _LINKS, objects)
    columns = {name: _value(found, chain, _KIND[kinds[name]], city) for name, chain in keys.items()} | more(found)
    columns["pncp_control_number"] = loose.apart(columns["pncp_control_number"])
    columns |= {"city_slug": F.lit(city.slug), "source_system": F.lit(SOURCE_SYSTEM), "observed_at": F.col("observed_at"), "snapshot_sha256": F.col("snapshot_sha256")}
    return rows.select(*[columns[name].alias(name) for name in TABLES[table].names], *kept)


def procurements(rows: DataFrame, city: CityConfig) -> DataFrame:
    """rows (record VARIANT, observed_at, snapshot_sha256, ...) as procurements; other columns stay."""
    return _normalized(rows, "procurements", PROCUREMENT_KEYS, PROCUREMENT_OBJECTS, city)


def contracts(rows: DataFrame, city: CityConfig) -> DataFrame:
    """rows (record VARIANT, observed_at, snapshot_sha256, ...) as contracts; other columns stay.

    source_url is the detail address where agency, year and sequence are there, else the record's link or ''.
    """

    def url(found: Loose) -> dict[str, Column]:
        chain = CONTRACT_KEYS["sequence"]
        numbered = F.lit(False)
        for key in chain.split():
            numbered = numbered | found.truthy(key)
        complete = found.truthy("org.cnpj") & found.truthy("anoContrato") & numbered
        detail = F.format_string(CONTRACT_DETAIL, found.typed("org.cnpj", "string"), found.typed("anoContrato", "string"), _value(found, chain, "string", city))
        return {"source_url": F.when(complete, detail).when(found.truthy("linkSistemaOrigem"), found.typed("linkSistemaOrigem", "string")).otherwise("")}

    return _normalized(rows, "contracts", CONTRACT_KEYS, CONTRACT_OBJECTS, city, url)


def records_of_pages(pages: DataFrame) -> DataFrame:
    """pages (body, status_code, collected_at, sha256, ...) as one row per record: record, observed_at, snapshot_sha256, pos.

    A page is an object with its list under data or content; an empty body or status 204 has no records.
    """
    body = F.when((F.col("status_code") == 204) | (F.trim("body") == ""), "{}").otherwise(F.col("body"))
    v = F.parse_json(body)
    listed = first_truthy([at(v, "data"), at(v, "content")])
    kept = [c for c in pages.columns if c not in ("body", "status_code", "collected_at", "sha256")]
    rows = pages.select(*kept, F.col("collected_at").alias("observed_at"), F.col("sha256").alias("snapshot_sha256"), listed.alias("__listed"))
    return exploded(rows, "__listed").withColumnRenamed("value", "record")
