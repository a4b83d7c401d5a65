"""Which records belong to a city and a branch of its government."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions import loose
from ledgerscope.functions.expr import at, exploded, first_truthy, folded, holds
from ledgerscope.functions.loose import Loose
from ledgerscope.sources.city import CityConfig

# The sphere of municipal bodies and the power of each branch.
MUNICIPAL_SPHERE = "M"
BRANCH_POWER = {"executivo": "E", "legislativo": "L", "municipal": None}


def branch_filter(sphere: Column, power: Column, scope: str) -> Column:
    if scope not in BRANCH_POWER:
        raise ValueError(f"unknown scope {scope!r}; known: {', '.join(BRANCH_POWER)}")
    wanted = BRANCH_POWER[scope]
    inside = sphere == MUNICIPAL_SPHERE
    return F.coalesce(inside if wanted is None else inside & (power == wanted), F.lit(False))


def same_name(name: Column, city_name: str) -> Column:
    return F.coalesce(folded(name) == folded(F.lit(city_name)), F.lit(False))


def _in_scope(record: Column, objects: dict[str, list[str]], spheres: list[str], powers: list[str], scope: str, unit_keys: list[str], here) -> Column:
    """Records whose body is of the branch and whose unit is here(found); a record is read once, the VARIANT asked where texts leave a value open."""
    keys = {"org": [*spheres, *powers], "unit": unit_keys}

    def inside(record: Column, read: Column) -> Column:
        there = {p: loose.is_there(record, read, p, [k.partition(".")[2] for k in keys[base]]) for base, places in objects.items() for p in places[:-1]}

        def part(base: str, test) -> Column:
            texts = Loose(record, objects, {}, there).chosen(base, lambda path: read[loose.name(path)])
            return holds(texts, lambda t: test(Loose(record, objects, {base: t}, there)))

        org = part("org", lambda found: branch_filter(found.first(spheres, "string"), found.first(powers, "string"), scope))
        return org & part("unit", here)

    where = loose.paths([*keys["org"], *keys["unit"]], objects)
    # The record is bound by a lambda of its own: a filter on a parsed record would parse it again wherever it is named.
    return holds(record, lambda r: holds(loose.members(r, where), lambda read: inside(r, read)))


def procurement_in_scope(record: Column, city: CityConfig, scope: str) -> Column:
    """Procurements belong to a city by its name alone."""
    objects = {"org": ["orgaoEntidade"], "unit": ["unidadeOrgao"]}
    names = ["unit.municipioNome"]
    return _in_scope(record, objects, ["org.esferaId"], ["org.poderId"], scope, names, lambda found: same_name(found.first(names, "string"), city.name))


def contract_in_scope(record: Column, city: CityConfig, scope: str) -> Column:
    """Contracts belong to a city by its IBGE code or its name."""
    objects = {"org": ["orgaoEntidade", "orgao"], "unit": ["unidadeOrgao", "unidadeExecutora"]}
    codes, names = ["unit.codigoIbge", "unit.codigoIbgeMunicipio", "unit.municipioId"], ["unit.municipioNome", "unit.nomeMunicipio"]

    def here(found: Loose) -> Column:
        return F.coalesce(found.first(codes, "string") == city.ibge_code, F.lit(False)) | same_name(found.first(names, "string"), city.name)

    return _in_scope(record, objects, ["org.esferaId", "org.esfera"], ["org.poderId", "org.poder"], scope, [*codes, *names], here)


def active_modalities(payload: DataFrame, column: str = "payload") -> DataFrame:
    """(id) of the active modalities in JSON payloads, distinct and ascending; raises if there is none.

    A payload is a list, or an object with a list under data, content or items. Only `statusAtivo: false` makes
    an entry inactive; ids are whole numbers or texts of digits.
    """
    v = F.try_parse_json(column)
    listed = F.when(F.schema_of_variant(v).rlike("^ARRAY"), v).otherwise(first_truthy([at(v, p) for p in ("data", "content", "items")]))
    entries = exploded(payload.select(listed.alias("listed")), "listed").filter(F.schema_of_variant("value").startswith("OBJECT")).select(
        F.to_json(at(F.col("value"), "id")).alias("id"), F.coalesce(F.to_json(at(F.col("value"), "statusAtivo")), F.lit("null")).alias("active")
    )
    number = F.regexp_extract("id", r'^"?(-?[0-9]+)"?$', 1)
    ids = entries.filter("active <> 'false'").filter((number != "") & ~F.col("id").startswith('"-')).select(number.cast("long").alias("id")).distinct()
    if ids.isEmpty():
        raise ValueError("the payload lists no active modality; collection must not assume any")
    return ids.orderBy("id")
