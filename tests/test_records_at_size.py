"""What keeps normalisation and scope cheap a record, and scope against plain Python."""

import json
import random
import re

from pyspark.sql import functions as F

from ledgerscope.operators import normalize, scope
from ledgerscope.sources.city import CityConfig

CITY = CityConfig("s", "Town", "BR", "77")
INTERPRETED = 8000  # bytes of code of a method beyond which HotSpot never compiles it


def parsed(spark, records):
    rows = spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(records)], "j string, i int")
    return rows.select(F.parse_json("j").alias("record"), F.lit("t").alias("observed_at"), F.lit("h").alias("snapshot_sha256"), "i")


def largest_method(frame):
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


def test_normalisation_is_compiled_and_reads_a_record_once(spark):
    rows = parsed(spark, [{"numeroControlePNCP": "1"}])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for made in (normalize.contracts(rows, CITY), normalize.procurements(rows, CITY)):
            assert 0 < largest_method(made) < INTERPRETED
            plan = made._jdf.queryExecution().optimizedPlan().toString()
            assert "from_json" not in plan and len(re.findall(r", \$, StructField", plan)) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_stored_records_give_the_same(spark, tmp_path):
    rows = parsed(spark, [{"numeroControlePncp": "1", "orgao": {"nome": "n", "esfera": "M"}, "unidadeOrgao": {"codigoIbge": 77}}, {"numeroControlePNCP": 0, "orgaoEntidade": "x"}, 5])
    rows.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    assert normalize.contracts(stored, CITY).orderBy("i").collect() == normalize.contracts(rows, CITY).orderBy("i").collect()
    inside = scope.contract_in_scope(F.col("record"), CITY, "municipal")
    assert [r["i"] for r in stored.filter(inside).select("i").collect()] == [r["i"] for r in rows.filter(inside).select("i").collect()] == [0]


def test_scope_reads_a_record_once(spark):
    rows = parsed(spark, [{}])
    for inside in (scope.contract_in_scope, scope.procurement_in_scope):
        plan = rows.filter(inside(F.col("record"), CITY, "executivo"))._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r", \$, StructField", plan)) == 1


def python_scope(record, scope_name, org_paths, unit_paths, sphere, power, code, names):
    get = lambda base, key: base.get(key) if isinstance(base, dict) else None
    first = lambda base, keys: next((v for k in keys if (v := get(base, k))), get(base, keys[-1]))
    text = lambda v: None if v is None or isinstance(v, (dict, list)) else v if isinstance(v, str) else json.dumps(v)
    org, unit = first(record, org_paths), first(record, unit_paths)
    wanted = scope.BRANCH_POWER[scope_name]
    branch = text(first(org, sphere)) == "M" and (wanted is None or text(first(org, power)) == wanted)
    here = code and text(first(unit, code)) == "77"
    name = text(first(unit, names))
    return bool(branch and (here or (name is not None and name.strip().casefold() == "town")))


def test_scope_against_plain_python(spark):
    rng = random.Random(5)
    odd = [None, "", "0", 0, False, {}, [], {"x": 1}, "{}", "x", 5]
    good = {"esferaId": "M", "esfera": "M", "poderId": "E", "poder": "E", "codigoIbge": 77, "codigoIbgeMunicipio": "77", "municipioId": 77, "municipioNome": " TOWN ", "nomeMunicipio": "town"}
    some = lambda keys: {k: good[k] if rng.random() < 0.6 else rng.choice(odd) for k in keys if rng.random() < 0.7}
    records = []
    for _ in range(1500):
        record = {p: some(["esferaId", "esfera", "poderId", "poder"]) for p in ("orgaoEntidade", "orgao") if rng.random() < 0.7}
        record |= {p: some(list(good)[4:]) for p in ("unidadeOrgao", "unidadeExecutora") if rng.random() < 0.7}
        records.append({k: rng.choice(odd) if rng.random() < 0.15 else v for k, v in record.items()})
    rows = parsed(spark, [*records, 5, "x", None])
    both = [
        (scope.contract_in_scope, (["orgaoEntidade", "orgao"], ["unidadeOrgao", "unidadeExecutora"], ["esferaId", "esfera"], ["poderId", "poder"], ["codigoIbge", "codigoIbgeMunicipio", "municipioId"], ["municipioNome", "nomeMunicipio"])),
        (scope.procurement_in_scope, (["orgaoEntidade"], ["unidadeOrgao"], ["esferaId"], ["poderId"], [], ["municipioNome"])),
    ]
    for inside, keys in both:
        for branch in ("executivo", "municipal"):
            got = {r["i"] for r in rows.filter(inside(F.col("record"), CITY, branch)).select("i").collect()}
            want = {i for i, r in enumerate(records) if python_scope(r, branch, *keys)}
            assert got == want and len(want) > 30
