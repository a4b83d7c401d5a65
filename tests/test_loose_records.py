"""Normalisation of loose records against plain Python, and lists walked without a round trip through text."""

import json
import random

from pyspark.sql import functions as F

from ledgerscope.functions.expr import exploded
from ledgerscope.operators import normalize
from ledgerscope.schemas import TABLES
from ledgerscope.sources.city import CityConfig

CITY = CityConfig("s", "Town", "BR", "77")
VALUES = [None, "", "0", "a", "{}", "[]", '{"cnpj":"no"}', "null", "false", "nothing", 0, 0.0, 5, -3, 12.5, 1e10, 2**60, True, False, {}, [], {"x": 1}, [1], "12", "7.25", " é "]


def lookup(base, key):
    return base.get(key) if isinstance(base, dict) else None


def pick(values):
    return next((v for v in values if v), values[-1])


def as_kind(value, kind):
    """What the store keeps of a value; texts of numbers count as numbers, as in a column with a numeric type."""
    if value is None or (kind == "text" and isinstance(value, (dict, list))):
        return None
    if kind == "text":
        return value if isinstance(value, str) else json.dumps(value) if isinstance(value, bool) else "10000000000" if value == 1e10 else f"{value:g}" if isinstance(value, float) else str(value)
    try:
        number = float(value) if not isinstance(value, (dict, list)) else None
    except ValueError:
        return None
    return number if number is None or kind == "real" else int(value) if isinstance(value, (bool, int)) else int(number)


def expected(record, keys, objects, kinds):
    found = {name: pick([lookup(record, p) for p in paths]) for name, paths in objects.items()}
    out = {}
    for column, chain in keys.items():
        values = []
        for key in chain.split():
            base, _, rest = key.partition(".")
            values.append(getattr(CITY, rest) if base == "city" else lookup(found[base], rest) if rest else lookup(record, key))
        out[column] = as_kind(pick(values), kinds[column])
    return out


def test_loose_records(spark):
    rng, kinds = random.Random(7), dict(TABLES["contracts"].columns)
    keys, objects = normalize.CONTRACT_KEYS, normalize.CONTRACT_OBJECTS
    tops = sorted({k for c in keys.values() for k in c.split() if "." not in k})
    inner = sorted({k.partition(".")[2] for c in keys.values() for k in c.split() if "." in k})
    records = []
    for _ in range(400):
        record = {k: rng.choice(VALUES) for k in tops if rng.random() < 0.7}
        for path in (p for paths in objects.values() for p in paths):
            if rng.random() < 0.8:
                record[path] = rng.choice([*VALUES[:-2], {k: rng.choice(VALUES) for k in inner if rng.random() < 0.6}, {k: rng.choice(VALUES) for k in inner}])
        records.append(record)
    rows = spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(records)], "j string, i int")
    got = normalize.contracts(rows.select(F.parse_json("j").alias("record"), F.lit("t").alias("observed_at"), F.lit("h").alias("snapshot_sha256"), "i"), CITY)
    strings = {n for n in keys if kinds[n] == "text"}
    for row in got.collect():
        want = expected(records[row["i"]], keys, objects, kinds)
        for name in keys:
            if name in strings or kinds[name] == "real":
                assert row[name] == want[name], (name, row[name], want[name], records[row["i"]])


def test_exploded_lists(spark):
    rows = spark.createDataFrame([(1, '[5, "x", null, {"a": 1}]'), (2, "{}"), (3, None), (4, "[]"), (5, '"text"')], "id int, j string")
    got = exploded(rows.select("id", F.try_parse_json("j").alias("list")), "list")
    assert got.columns == ["id", "pos", "value"] and [(r["id"], r["pos"], r["v"]) for r in got.select("id", "pos", F.to_json("value").alias("v")).orderBy("pos").collect()] == [
        (1, 0, "5"), (1, 1, '"x"'), (1, 2, "null"), (1, 3, '{"a":1}'),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "to_json" not in plan
