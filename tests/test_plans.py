import json
from datetime import date

import pytest

from ledgerscope.__main__ import main
from ledgerscope.operators import provenance
from ledgerscope.plans import build, collect, store
from ledgerscope.schemas import TABLES
from ledgerscope.sources import paged
from ledgerscope.sources.city import CityConfig, open_workspace
from ledgerscope.sources.seeds import read_rows, read_seed
from ledgerscope.streaming import upsert


@pytest.fixture
def home(tmp_path):
    city = tmp_path / "cities" / "salvador"
    (city / "data" / "seed").mkdir(parents=True)
    (city / "city.json").write_text(json.dumps({"slug": "salvador", "name": "Salvador", "uf": "ba", "ibge_code": 2927408}))
    (city / "sources.csv").write_text('id,publisher,scope,authority,url,notes\na,P,s,x,http://h.example/1,"two\nlines ""quoted"""\n')
    return tmp_path


def lines(path, *rows):
    path.write_text("\n\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n")
    return str(path)


def test_arrival_order_over_part_files(spark, tmp_path):
    """Files of a folder count by name, though Spark reads larger ones first."""
    folder = tmp_path / "rows.jsonl"
    folder.mkdir()
    for i, pad in enumerate((0, 40, 900)):
        rows = [{"event_key": f"{i}-{k}", "nature_name": "x" * pad} for k in range(3)]
        (folder / f"part-0000{i}.json").write_text("\n".join(map(json.dumps, rows)) + "\n")
    last = lines(tmp_path / "last.jsonl", {"event_key": "last"})
    got = read_rows(spark, [str(folder), last], TABLES["revenue_events"]).orderBy("seq").select("event_key").collect()
    assert [r[0] for r in got] == [f"{i}-{k}" for i in range(3) for k in range(3)] + ["last"]


def test_workspace(spark, home):
    w = open_workspace(home, "salvador")
    assert w.city == CityConfig("salvador", "Salvador", "BA", "2927408", None)
    assert w.sources(spark).first()["notes"] == 'two\nlines "quoted"'
    with pytest.raises(FileNotFoundError):
        open_workspace(home, "nowhere")
    with pytest.raises(ValueError, match="ibge_code, uf"):
        CityConfig.parse('{"slug": "a", "name": "b"}')
    (home / "cities" / "other").mkdir()
    (home / "cities" / "other" / "city.json").write_text((home / "cities" / "salvador" / "city.json").read_text())
    with pytest.raises(ValueError):
        open_workspace(home, "other")


def test_seed_cells(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a,b\n1,\n"",x\n')
    rows = read_seed(spark, str(tmp_path / "s.csv"), ["a", "b", "c"], seq=True).orderBy("seq").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [("1", "", None), ("", "x", None)]
    assert read_seed(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0


CONTRACT = {"city_slug": "salvador", "source_system": "PNCP", "pncp_control_number": "1", "supplier_type": "PJ", "supplier_document": "12345678000190", "supplier_name": "Fornecedor", "global_value": 100.0, "observed_at": "t1", "year": 2026}


def test_build(spark, home):
    w = open_workspace(home, "salvador")
    names = [n for n in TABLES["procurements"].names if n != "city_slug"]
    cells = {"source_system": "local", "notice_number": "001/2026", "year": "2026", "estimated_value": "1000", "observed_at": "t"}
    (w.seeds / "procurements.csv").write_text(",".join(names) + "\n" + ",".join(cells.get(n, "") for n in names) + "\n")
    (w.seeds / "officials.csv").write_text("name,office,source_url,observed_at\nA,mayor,u,t\nA,mayor,u2,t\n")
    root = str(home / "tables")
    file = lines(home / "c.jsonl", CONTRACT, CONTRACT | {"supplier_name": "Later", "supplier_document": "2"}, CONTRACT | {"pncp_control_number": None})
    build.build(spark, w, root, contracts=[file])
    notice = store.read(spark, root, "procurements").first()
    assert (notice["city_slug"], notice["notice_number"], notice["estimated_value"], notice["pncp_control_number"]) == ("salvador", "001/2026", 1000.0, None)
    assert store.read(spark, root, "officials").first()["source_url"] == "u2"
    assert sorted(str(r["pncp_control_number"]) for r in store.read(spark, root, "contracts").collect()) == ["1", "None"]
    suppliers = {r["document"]: r["name"] for r in store.read(spark, root, "suppliers").collect()}
    assert suppliers == {"12345678000190": "Fornecedor", "2": "Later"}  # a supplier comes in even if its contract was known
    build.build(spark, w, root, contracts=[file])
    assert store.read(spark, root, "procurements").count() == 2  # no key, so a rebuild appends
    assert store.read(spark, root, "contracts").count() == 3 and store.read(spark, root, "cities").count() == 1


def test_failed_build_keeps_the_last_version(spark, home):
    w = open_workspace(home, "salvador")
    root = str(home / "tables")
    build.build(spark, w, root)
    (w.seeds / "fiscal_observations.csv").write_text("entity,period,metric,precision,source_url,observed_at,value_brl\ne,p,m,x,u,t,abc\n")
    before = store.current(spark, root)
    with pytest.raises(Exception, match="isn't a number"):
        build.build(spark, w, root)
    assert store.current(spark, root) == before
    with pytest.raises(Exception):
        build.build(spark, w, root, contracts=[str(home / "missing.jsonl")])


def test_ingest(spark, home):
    root = str(home / "tables")
    revenue = {"city_slug": "s", "source_system": "x", "event_key": "r1", "nature_code": "1", "collected_value": 80.0, "source_url": "u", "observed_at": "t"}
    expense = {"city_slug": "s", "source_system": "x", "event_key": "e1", "stage": "pago", "gross_value": 50.0, "source_url": "u", "observed_at": "t"}
    counts = build.ingest_events(spark, root, [lines(home / "r.jsonl", revenue, revenue | {"collected_value": 81.0})], [lines(home / "e.jsonl", expense), str(home / "none.jsonl")])
    assert counts == {"revenue_events": 2, "expense_events": 1}
    assert [r["collected_value"] for r in store.read(spark, root, "revenue_events").collect()] == [81.0]
    bad = lines(home / "b.jsonl", expense | {"gross_value": "1.234,56"})
    assert build.quarantined(spark, [bad], "expense_events").first()["columns"] == ["gross_value"]
    assert read_rows(spark, [bad], TABLES["expense_events"]).first()["gross_value"] is None


def test_retries():
    naps = []
    answers = iter([paged.Response(429, b"", headers={"retry-after": "7"}), paged.Response(503, b""), paged.Response(200, b"ok")])
    assert paged.patient_get(lambda u, p: next(answers), "u", {}, sleep=naps.append).status == 200 and naps == [7.0, 4.0]
    assert paged.patient_get(lambda u, p: paged.Response(503, b""), "u", {}, sleep=naps.append).status == 503
    with pytest.raises(RuntimeError):
        paged.single_retry_get(lambda u, p: paged.Response(503, b""), "u", {}, page=3, sleep=naps.append)
    assert naps[-1] == 8
    with pytest.raises(RuntimeError, match="404"):
        paged.stubborn_get(lambda u, p: paged.Response(404, b""), "u", sleep=naps.append)


def test_last_page():
    record = {"data": [1] * 50}
    assert paged.is_last({}, 1, 50) and paged.is_last({"data": [1]}, 1, 50) and not paged.is_last(record, 1, 50)
    assert paged.is_last(record | {"totalPaginas": 1}, 1, 50) and paged.is_last(record | {"paginasRestantes": 0}, 1, 50) and not paged.is_last(record | {"totalPaginas": "1"}, 1, 50)


def _fetch(broken=False):
    """A recorded source: two modalities, three notices over two pages, one of them from another city."""

    def fetch(url, params):
        import json

        from ledgerscope.sources.paged import Response

        if "modalidades" in url:
            return Response(200, json.dumps([{"id": 6}, {"id": "8"}]).encode())
        org = {"cnpj": "13927801000149", "esferaId": "M", "poderId": "E"}
        make = lambda n, city: {"numeroControlePNCP": n, "orgaoEntidade": org, "unidadeOrgao": {"municipioNome": city}, "anoContrato": 2026, "sequencial": 2}
        if "cnpjOrgao" in params:
            return Response(200, json.dumps({"data": [make("k1", "Salvador")]}).encode())
        if params["codigoModalidadeContratacao"] == 8:
            return Response(503, b"busy", headers={"retry-after": "0"}) if broken else Response(204, b"")
        if params["pagina"] == 1:
            return Response(200, json.dumps({"data": [make("1", "Salvador"), make("2", "Recife")]}).encode())
        return Response(200, json.dumps({"data": [make("1", "Salvador")]}).encode())

    return fetch


@pytest.mark.parametrize("broken", [False, True])
def test_collect_procurements(spark, tmp_path, broken, monkeypatch):
    city = CityConfig("salvador", "Salvador", "BA", "2927408")
    fetch = _fetch(broken)
    if broken:  # without pauses on the executors
        def short(fetch, url, params, page=1, sleep=None):
            return fetch(url, params)
        monkeypatch.setattr(collect.paged.fetch_pages, "__defaults__", (fetch, short, (lambda s: None), 2))
    path = collect.collect_procurements(spark, city, date(2026, 1, 1), date(2026, 1, 2), str(tmp_path), fetch=fetch, page_size=2, pause=0)
    rows = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert [r["pncp_control_number"] for r in rows] == ["1"] and list(rows[0]) == sorted(rows[0])
    report = spark.read.json(f"{tmp_path}/coverage").first()
    assert (report["complete"], report["records"]) == (not broken, 1)
    assert collect.agency_cnpjs(spark, [path]).first()["cnpj"] == "13927801000149"
    kept = spark.read.json(f"{tmp_path}/snapshots/manifest")
    assert kept.filter("source_id = 'pncp_consulta_limitada'").count() == int(broken)


def test_collect_contracts_and_pages(spark, tmp_path):
    city = CityConfig("salvador", "Salvador", "BA", "2927408", "13.927.801/0001-49")
    cnpjs = collect.union_cnpjs(spark, city, ["123"], [])
    path = collect.collect_contracts(spark, city, date(2026, 1, 1), date(2026, 1, 2), str(tmp_path), cnpjs, fetch=_fetch(), pause=0)
    assert [json.loads(r["value"])["pncp_control_number"] for r in spark.read.text(path).collect()] == ["k1"]
    with pytest.raises(ValueError):
        collect.collect_contracts(spark, city, date(2026, 1, 1), date(2026, 1, 2), str(tmp_path), cnpjs.filter("false"))
    sources = spark.createDataFrame([("a", "http://h.example/1"), (" ", "x"), ("b", "")], "id string, url string")

    def page(url, params):
        from ledgerscope.sources.paged import Response

        return Response(200, b"abc", "text/html")

    got = collect.collect_pages(sources, str(tmp_path / "pages"), page).collect()
    assert [(r["source_id"], r["ok"], r["sha256"][:8]) for r in got] == [("a", True, "ba7816bf")]


def test_snapshots_are_stored_once(spark, tmp_path):
    rows = [("s", "u", "u", 200, "", "t1", b"abc"), ("s", "u", "u", 200, "", "t2", b"abc")]
    fetched = spark.createDataFrame(rows, "source_id string, requested_url string, final_url string, status_code int, content_type string, collected_at string, body binary")
    for _ in range(2):
        provenance.append_snapshots(fetched, str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x/bodies")).count() == 1
    assert spark.read.json(str(tmp_path / "x/manifest")).count() == 4


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    event = {"city_slug": "s", "source_system": "x", "event_key": "e1", "stage": "pago", "gross_value": 50.0, "source_url": "u", "observed_at": "t1"}
    lines(tmp_path / "in" / "1.jsonl", event, event | {"gross_value": 60.0, "observed_at": "t2"})
    stream = upsert.event_stream(spark, str(tmp_path / "in"), "expense_events")
    for _ in range(2):
        upsert.upsert_stream(stream, str(tmp_path / "out"), "expense_events", str(tmp_path / "ck")).awaitTermination()
    assert [r["gross_value"] for r in store.read(spark, str(tmp_path / "out"), "expense_events").collect()] == [60.0]
    batch = spark.createDataFrame([("2026-01-01T10:00:00", 1.0, "a"), ("2026-01-01T11:00:00", 2.0, "a")], "t string, v double, g string")
    assert upsert.totals_by_window(batch, "t", "v", "g").first()["total"] == 3.0


def test_command_line(spark, home, capsys):
    assert json.loads(main(["--repo-root", str(home), "--city", "salvador", "sources"], spark))[0]["id"] == "a"
    file = lines(home / "c.jsonl", CONTRACT)
    root = main(["--repo-root", str(home), "--city", "salvador", "build-db", "--contracts", file], spark)
    assert store.read(spark, root, "contracts").count() == 1
    assert json.loads(main(["--repo-root", str(home), "--city", "salvador", "concentration"], spark))[0]["supplier_name"] == "Fornecedor"
