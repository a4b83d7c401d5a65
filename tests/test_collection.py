"""Collections that are stopped, resumed, replayed and paced; the source behind them as a data source."""

import inspect
import json
import textwrap
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from ledgerscope.operators import audit, normalize
from ledgerscope.plans import collect
from ledgerscope.sources import paged
from ledgerscope.sources.city import CityConfig
from ledgerscope.sources.datasource import PagesReader, PublicRecords
from ledgerscope.streaming.upsert import distinct_seen_stream

CITY = CityConfig("lake", "Lake", "BR", "1200")
DAYS = (date(2026, 1, 1), date(2026, 1, 2))


def portal(log, down=()):
    """Three kinds of notices on 3, 2 and 1 pages of two; requests are appended to the file `log`; `down` has (kind, page) out of order."""

    def fetch(url, params):
        import json

        from ledgerscope.sources.paged import Response

        if "modalidades" in url:
            return Response(200, json.dumps([{"id": 1}, {"id": 2}, {"id": 3}]).encode())
        kind, page = params["codigoModalidadeContratacao"], params["pagina"]
        with open(log, "a") as out:
            out.write(f"{kind}-{page}\n")
        if (kind, page) in down:
            return Response(503, b"busy", headers={"retry-after": "0"})
        record = lambda n: {"numeroControlePNCP": n, "orgaoEntidade": {"esferaId": "M", "poderId": "E"}, "unidadeOrgao": {"municipioNome": "Lake"}}
        count = 2 if page < 4 - kind else 1
        return Response(200, json.dumps({"data": [record(f"{kind}/{page}/{n}") for n in range(count)]}).encode())

    return fetch


@pytest.fixture
def no_pause(monkeypatch):
    def short(fetch, url, params, page=1, sleep=None):
        return fetch(url, params)

    monkeypatch.setattr(collect.paged.fetch_pages, "__defaults__", (None, short, (lambda s: None), 2))


def run(spark, tmp_path, fetch, **more):
    path = collect.collect_procurements(spark, CITY, *DAYS, str(tmp_path / "out"), fetch=fetch, page_size=2, pause=0, **more)
    rows = sorted(r["value"] for r in spark.read.text(path).collect())
    return rows, spark.read.json(f"{tmp_path}/out/coverage").first().asDict()


def asked(log):
    return sorted(log.read_text().split()) if log.exists() else []


EVERY = ["1-1", "1-2", "1-3", "2-1", "2-2", "3-1"]


def test_stop_resume_replay(spark, tmp_path, no_pause):
    log = tmp_path / "log"
    cut, coverage = run(spark, tmp_path, portal(log, {(1, 3), (2, 1)}), round_pages=1)
    numbers = lambda rows: sorted(json.loads(r)["pncp_control_number"] for r in rows)
    assert asked(log) == EVERY[:4] + ["3-1"] and numbers(cut) == ["1/1/0", "1/1/1", "1/2/0", "1/2/1", "3/1/0"]
    assert not coverage["complete"] and coverage["records"] == 5 and "codigoModalidadeContratacao=1&" in coverage["stopped_url"]
    log.unlink()
    rows, coverage = run(spark, tmp_path, portal(log), resume=True, round_pages=1)
    assert asked(log) == ["1-3", "2-1", "2-2"] and coverage["complete"] and coverage["records"] == len(rows) == 9
    assert set(cut) < set(rows)
    log.unlink()
    again, coverage = run(spark, tmp_path, portal(log), resume=True)
    assert asked(log) == [] and again == rows and coverage["complete"]

    def no_request(url, params):
        raise AssertionError(url)

    offline, coverage = run(spark, tmp_path, no_request, replay=True)
    assert offline == rows and coverage["complete"] and coverage["records"] == 9
    whole, _ = run(spark, tmp_path, portal(log))
    assert asked(log) == EVERY and numbers(whole) == numbers(rows)


def test_first_stop_ends_the_run(spark, tmp_path, no_pause):
    rows, coverage = run(spark, tmp_path, portal(tmp_path / "log", {(2, 1)}), first_stop=True)
    assert [json.loads(r)["pncp_control_number"][0] for r in rows] == ["1"] * 5
    assert coverage["stopped_status"] == 503 and coverage["records"] == 5 and not coverage["complete"]


def test_a_failed_run_keeps_its_rounds(spark, tmp_path, no_pause):
    log = tmp_path / "log"
    fine = portal(log)

    def broken(url, params):
        from ledgerscope.sources.paged import Response

        return Response(404, b"") if params.get("pagina") == 2 else fine(url, params)

    with pytest.raises(Exception, match="404"):
        run(spark, tmp_path, broken, round_pages=1)
    assert asked(log) == ["1-1", "2-1", "3-1"]
    log.unlink()
    rows, _ = run(spark, tmp_path, fine, resume=True)
    assert asked(log) == ["1-2", "1-3", "2-2"] and len(rows) == 9


def test_all_tasks_share_one_rate():
    """Four tasks on one clock: in every stretch of time no more requests than slots, at the rate of one task alone."""
    times = []
    for task in range(4):
        now = [100.0]

        def sleep(seconds, now=now):
            now[0] += seconds

        pacer = paged.Pacer(0.5, task, 4, sleep, lambda now=now: now[0])
        fetch = pacer.paced(lambda url, params, now=now: times.append(now[0]))
        for n in range(10):
            fetch("u", {})
            now[0] += 5.3 if n == 3 else 0.1  # one slow answer: what was missed isn't caught up
    times.sort()
    assert all(b - a >= 0.5 - 1e-9 for a, b in zip(times, times[1:])) and len(times) == 40
    assert [t for t in times if t < 102] == [100.0, 100.5, 101.0, 101.5]


def test_single_task_pauses_between_pages():
    naps, now = [], [0.0]
    pacer = paged.Pacer(0.25, 0, 1, lambda s: (naps.append(s), now.__setitem__(0, now[0] + s)), lambda: now[0])
    [pacer.wait() for _ in range(4)]
    assert naps == [0.25] * 3


def test_data_source(spark, tmp_path, no_pause):
    spark.dataSource.register(PublicRecords)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    (tmp_path / "recorded_portal.py").write_text("import os\n" + textwrap.dedent(inspect.getsource(portal)) + """
def fetch(url, params):
    return portal(os.devnull)(url, params | {"codigoModalidadeContratacao": int(params["codigoModalidadeContratacao"])})
""")
    spark.sparkContext.addPyFile(str(tmp_path / "recorded_portal.py"))
    options = {"kind": "procurements", "keys": "1,2,3", "start": "2026-01-01", "end": "2026-01-02", "pageSize": "2", "pause": "0", "uf": "BR", "ibge": "1200", "fetch": "recorded_portal:fetch"}
    pages = spark.read.format("public_records").options(**options).load()
    facts = pages.select("body", "status_code", "collected_at", F.sha2("body", 256).alias("sha256"))
    rows = normalize.procurements(normalize.records_of_pages(facts), CITY)
    collected, _ = run(spark, tmp_path, portal(tmp_path / "log"))
    assert sorted(r["pncp_control_number"] for r in rows.collect()) == sorted(json.loads(r)["pncp_control_number"] for r in collected)


def test_filters_of_the_data_source_rule_out_requests():
    options = {"kind": "contracts", "keys": "a, b,c", "start": "2026-01-01", "end": "2026-03-15"}
    reader = PagesReader(options)
    assert [(s.key, str(s.window_start), str(s.window_end)) for s in reader.wanted()][:3] == [("a", "2026-01-01", "2026-01-30"), ("a", "2026-01-31", "2026-03-01"), ("a", "2026-03-02", "2026-03-15")]
    filters = [In(("key",), ("a", "c")), GreaterThanOrEqual(("window_start",), date(2026, 1, 31)), LessThan(("window_end",), date(2026, 3, 10)), EqualTo(("status_code",), 200)]
    assert [*reader.pushFilters(filters)] == filters[3:]
    assert [s.key for s in reader.wanted()] == ["a", "c"] and {str(s.window_start) for s in reader.wanted()} == {"2026-01-31"}
    assert sorted(s.key for p in reader.partitions() for s in p.series) == ["a", "c"]
    reader.pushFilters(filters)
    empty = PagesReader(options | {"keys": "x"})
    [*empty.pushFilters([EqualTo(("key",), "y")])]
    assert [*empty.read(empty.partitions()[0])] == []


def test_filters_reach_the_plan_of_requests(spark, tmp_path):
    spark.dataSource.register(PublicRecords)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"keys": "1,2", "start": "2026-01-01", "end": "2026-01-02", "pause": "0", "fetch": "no_such_module:fetch"}
    pages = spark.read.format("public_records").options(**options).load()
    assert pages.filter("key = 'nobody'").select("key").collect() == []  # a request would fail


def test_audit(spark):
    sources = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), (None, "1"), ("c", None)], "snapshot_sha256 string, observed_at string")
    targets = spark.createDataFrame([("a", "1"), ("d", "1"), (None, "2"), ("b", "2")], "sha256 string, collected_at string")
    got = sorted(map(tuple, audit.rows_to_manifest(sources, targets).collect()), key=repr)
    assert got == sorted([
        ("a", "1", 2, 1, "matched"), ("b", "1", 1, 0, "target_missing"), ("b", "2", 0, 1, "never_referred_to"), ("d", "1", 0, 1, "never_referred_to"),
        (None, None, 2, 0, "no_reference"), (None, None, 0, 1, "never_referred_to"),
    ], key=repr)
    assert audit.rows_to_manifest(sources.limit(0), targets.limit(0)).collect() == []


def test_first_of_a_stream_wins_over_batches(spark, tmp_path):
    schema = "control string, at long, text string"
    batches = [[("k", 5, "late"), ("k", 3, "tie b"), ("k", 3, "tie a"), ("", 1, "x"), (None, 1, "x")], [("k", 1, "earlier, but second"), ("m", 1, "m"), ("", 1, "x")], [("m", 0, "again"), ("", 2, "x")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in" / f"b{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in/*")

    def go():
        kept = distinct_seen_stream(stream, "control", ["at"])
        kept.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)

    got = go()
    assert [r for r in got if r[0] == "k"] == [("k", 3, "tie a")] and [r[1] for r in got if r[0] == "m"] == [1]
    assert len(got) == 5 and go() == got  # "" and null are told apart by all columns; nothing new, nothing changes
    spark.createDataFrame(batches[0], schema).coalesce(1).write.json(str(tmp_path / "in" / "b3"))
    assert go() == got  # a repeated batch
