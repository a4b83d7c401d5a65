import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerscope.functions import expr as E
from ledgerscope.functions.windows import date_windows
from ledgerscope.operators import normalize, scope
from ledgerscope.sources.city import CityConfig

CITY = CityConfig("salvador", "Salvador", "BA", "2927408")


def records(spark, *payloads):
    rows = [(json.dumps(p), "2026-01-02", "abc") for p in payloads]
    return spark.createDataFrame(rows, "raw string, observed_at string, snapshot_sha256 string").select(F.parse_json("raw").alias("record"), "observed_at", "snapshot_sha256")


PROCUREMENT = {
    "numeroControlePNCP": "1", "orgaoEntidade": {"esferaId": "M", "poderId": "E", "razaosocial": "", "razaoSocial": "Town hall"},
    "unidadeOrgao": {"municipioNome": " SALVADOR ", "ufSigla": "BA"},
}
CONTRACT = {
    "numeroControlePNCP": "c1", "numeroControlePNCPCompra": "p1", "anoContrato": 2026, "sequencialContrato": 1,
    "orgaoEntidade": {"cnpj": "13927801000149", "razaoSocial": "Town hall", "esferaId": "M", "poderId": "E"},
    "unidadeOrgao": {"municipioId": 2927408, "municipioNome": "Salvador"}, "niFornecedor": "123", "valorGlobal": 120.0, "linkSistemaOrigem": {},
}


def test_procurement_scope(spark):
    other = PROCUREMENT | {"unidadeOrgao": {"municipioNome": "Recife"}}
    rows = records(spark, PROCUREMENT, other, {})
    assert rows.filter(scope.procurement_in_scope(F.col("record"), CITY, "executivo")).count() == 1
    assert rows.filter(scope.procurement_in_scope(F.col("record"), CITY, "legislativo")).count() == 0
    assert rows.filter(scope.procurement_in_scope(F.col("record"), CITY, "municipal")).count() == 1
    with pytest.raises(ValueError):
        scope.procurement_in_scope(F.col("record"), CITY, "judicial")


def test_contract_scope_by_code_or_name(spark):
    by_code = CONTRACT | {"unidadeOrgao": {"municipioId": 2927408, "municipioNome": "?"}}
    by_alias = CONTRACT | {"unidadeOrgao": {}, "unidadeExecutora": {"nomeMunicipio": "salvador"}, "orgaoEntidade": None, "orgao": {"esfera": "M", "poder": "E"}}
    out = CONTRACT | {"unidadeOrgao": {"municipioId": 1, "municipioNome": "Recife"}}
    rows = records(spark, CONTRACT, by_code, by_alias, out)
    assert rows.filter(scope.contract_in_scope(F.col("record"), CITY, "executivo")).count() == 3


def test_procurement_columns(spark):
    row = normalize.procurements(records(spark, PROCUREMENT), CITY).first()
    assert (row["city_slug"], row["snapshot_sha256"], row["agency_name"], row["municipality_ibge"]) == ("salvador", "abc", "Town hall", "2927408")
    assert row["modality_id"] is None and row["source_url"] is None


def test_contract_columns(spark):
    row, bare = normalize.contracts(records(spark, CONTRACT, {"valorGlobal": "7.5", "anoContrato": "x", "objetoContrato": {"a": 1}}), CITY).collect()
    assert row["source_url"].endswith("/13927801000149/contratos/2026/1") and row["municipality_ibge"] == "2927408" and row["global_value"] == 120.0
    assert (bare["source_url"], bare["global_value"], bare["year"], bare["object"], bare["uf"]) == ("", 7.5, None, None, "BA")


def test_falsy_chain_keeps_the_last_alternative(spark):
    rows = spark.createDataFrame([('{"a": 0, "b": ""}',), ('{"a": {}, "b": "x"}',), ('{"b": []}',), ("{}",)], "raw string").select(F.parse_json("raw").alias("v"))
    got = [r[0] for r in rows.select(E.typed(E.first_truthy([E.at(F.col("v"), "a"), E.at(F.col("v"), "b")]), "string")).collect()]
    assert got == ["", "x", None, None]


def test_records_of_pages(spark):
    body = json.dumps({"content": [{"numeroControlePNCP": "1"}, {"numeroControlePNCP": "2"}]})
    pages = spark.createDataFrame([(body, 200, "t", "s", 1), ("", 200, "t", "s", 2), ("x", 204, "t", "s", 3), ("{}", 200, "t", "s", 4)], "body string, status_code int, collected_at string, sha256 string, page int")
    assert [(r["page"], r["pos"]) for r in normalize.records_of_pages(pages).orderBy("page", "pos").collect()] == [(1, 0), (1, 1)]


def test_active_modalities(spark):
    frame = lambda p: spark.createDataFrame([(p,)], "payload string")
    items = [{"id": 8, "statusAtivo": True}, {"id": "6"}, {"id": 99, "statusAtivo": False}, {"id": "x"}, 5, {"id": 7, "statusAtivo": "false"}]
    for payload in (items, {"data": [], "items": items}):
        assert [r["id"] for r in scope.active_modalities(frame(json.dumps(payload))).collect()] == [6, 7, 8]
    with pytest.raises(ValueError):
        scope.active_modalities(frame("[]"))


def test_date_windows(spark):
    days = [(r["start"], r["end"]) for r in date_windows(spark, date(2026, 1, 1), date(2026, 2, 15)).orderBy("start").collect()]
    assert days == [(date(2026, 1, 1), date(2026, 1, 30)), (date(2026, 1, 31), date(2026, 2, 15))]
    assert date_windows(spark, date(2026, 1, 1), date(2026, 1, 1)).count() == 1
    for bad in ((date(2026, 1, 2), date(2026, 1, 1), 30), (date(2026, 1, 1), date(2026, 1, 2), 0)):
        with pytest.raises(ValueError):
            date_windows(spark, *bad)


def test_strict_numbers(spark):
    rows = spark.createDataFrame([("12.5",), (" 12 ",), ("1_000",), ("1.5d",), ("1.234,56",), ("nan",), (None,)], "t string")
    got = [r[0] for r in rows.select(E.strict_double(F.col("t"))).collect()]
    assert got[:5] == [12.5, 12.0, None, None, None] and got[5] != got[5] and got[6] is None


def test_safe_suffix(spark):
    cases = [("application/JSON", "u", ".json"), ("text/html", "u", ".html"), ("", "http://h.example/a/b.PDF?x=1", ".pdf"), ("", "http://h.example", ".bin"),
             ("", "http://h.example/a.verylongsuffix", ".bin"), ("", "http://h.example/.hidden", ".bin"), (None, None, ".bin"), ("", "http://h.example/a.csv;v=1", ".csv")]
    rows = spark.createDataFrame(cases, "kind string, url string, want string")
    assert [r[0] for r in rows.select(E.safe_suffix(F.col("kind"), F.col("url"))).collect()] == [c[2] for c in cases]


def test_cnpj(spark):
    rows = spark.createDataFrame([("13.927.801/0001-49",), ("13927801000149",), ("123",)], "c string")
    assert [r[0] for r in rows.filter(E.is_cnpj(F.col("c"))).select(E.digits(F.col("c"))).distinct().collect()] == ["13927801000149"]


def test_case_folding_has_the_classes_of_python(spark):
    """Letters up to U+2FFF are the same here just where they are the same there."""
    letters = [chr(c) for c in range(0x21, 0x3000) if not chr(c).isspace() and chr(c) not in "\x85\u1c89\u1c8a"]
    rows = spark.createDataFrame([(c,) for c in letters], "c string").select("c", E.folded(F.col("c")).alias("f")).collect()
    here, there = {}, {}
    for r in rows:
        here.setdefault(r["f"], set()).add(r["c"])
        there.setdefault(r["c"].casefold(), set()).add(r["c"])
    apart = lambda classes: {frozenset(x) for x in classes.values() if not x & {"\u0264"}}  # noqa: E731  # its capital is newer than Python's tables
    assert apart(here) == apart(there)
    pairs = [("STRASSE", "Stra\u00dfe"), ("\u039f\u0394\u039f\u03a3", "\u03bf\u03b4\u03bf\u03c2"), ("\u0130", "i\u0307"), (" S\u00e3o ", "S\u00c3O")]
    frame = spark.createDataFrame([*pairs, ("\u0131", "i"), ("a", "\u00e1")], "a string, b string")
    assert [r[0] for r in frame.select(E.folded(F.col("a")) == E.folded(F.col("b"))).collect()] == [True] * 4 + [False] * 2


def test_an_error_row_of_collect_pages(spark, tmp_path):
    from ledgerscope.plans import collect

    def fetch(url, params):
        from ledgerscope.sources.paged import Response

        if "gone" in url:
            raise ValueError("no such page")
        return Response(200, b"<p>x</p>", "text/html", url)

    sources = spark.createDataFrame([("a", "http://h/ok"), ("b", " http://h/gone "), ("", "http://h/x")], "id string, url string")
    got = {r["source_id"]: r.asDict() for r in collect.collect_pages(sources, str(tmp_path), fetch).collect()}
    assert got["a"]["ok"] and got["a"]["status"] == 200 and got["a"]["error"] is None and len(got["a"]["sha256"]) == 64
    assert not got["b"]["ok"] and got["b"]["sha256"] is None and "no such page" in got["b"]["error"] and len(got) == 2
