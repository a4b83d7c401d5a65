"""How contract value spreads over suppliers. Descriptive: no evidence of irregularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value: what the figures mean, carried with every row.
LABEL = "descriptive_concentration_not_irregularity"


def by_city(contracts: DataFrame, money: str = "decimal(28,6)") -> DataFrame:
    """Suppliers of each city with contracts, known_global_value, share of the city's total and the label.

    The total counts contracts without a supplier document too, so shares may add up to less than 1; a total of
    zero gives null shares. One document under two names is two rows. Contracts are grouped by supplier, and
    the city's total is added up over the groups, as decimals; both sides of their join group anew unless the plan reuses the exchange.
    """
    value = F.col("global_value").cast(money)
    groups = contracts.filter("global_value is not null").groupBy("city_slug", "supplier_document", "supplier_name")
    groups = groups.agg(F.count("*").alias("contracts"), F.sum(value).alias("value"))
    totals = groups.groupBy("city_slug").agg(F.sum("value").cast("double").alias("total"))
    known = F.col("value").cast("double")
    return groups.filter("supplier_document is not null").join(totals, "city_slug").select(
        "city_slug", "supplier_document", "supplier_name", "contracts", known.alias("known_global_value"),
        F.when(F.col("total") != 0, known / F.col("total")).alias("share_of_known_value"), F.lit(LABEL).alias("label"),
    )


def of_city(contracts: DataFrame, city_slug: str, money: str = "decimal(28,6)") -> DataFrame:
    """One city's suppliers, the largest first; ties by name, then document."""
    rows = by_city(contracts.filter(F.col("city_slug") == city_slug), money).drop("city_slug")
    return rows.orderBy(F.desc("known_global_value"), F.asc_nulls_first("supplier_name"), "supplier_document")


def ranked(concentration: DataFrame) -> DataFrame:
    """The suppliers of each city with their rank and the share of all up to that rank."""
    order = W.partitionBy("city_slug").orderBy(F.desc("known_global_value"), "supplier_name", "supplier_document")
    return concentration.withColumns({"rank": F.row_number().over(order), "running_share": F.sum("share_of_known_value").over(order)})
