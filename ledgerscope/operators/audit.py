"""Two-sided audits: what refers to something that isn't there, and what nothing refers to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The classes of an audit.
MATCHED, NO_TARGET, NO_SOURCE, NO_REFERENCE = "matched", "target_missing", "never_referred_to", "no_reference"


def audit(sources: DataFrame, targets: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, sources, targets, class) for each key of sources that refer to targets, or of targets.

    Sources with a null in the key refer to nothing: they are one row, with a null key. Targets with a null in the key
    can't be referred to and count as never referred to, as one row too. Both sides are counted by key before they meet, so a
    target with very many sources is one row of the join.
    """
    def counted(rows: DataFrame, name: str) -> DataFrame:
        whole = F.lit(True)
        for k in key:
            whole = whole & F.col(k).isNotNull()
        keyed = rows.select(whole.alias("whole"), *[F.when(whole, F.col(k)).alias(k) for k in key])
        return keyed.groupBy("whole", *key).agg(F.count("*").alias(name))

    left, right = counted(sources, "sources"), counted(targets, "targets")
    met = left.filter("whole").drop("whole").join(right.filter("whole").drop("whole"), list(key), "full_outer")
    kind = F.when(F.col("targets").isNull(), NO_TARGET).when(F.col("sources").isNull(), NO_SOURCE).otherwise(MATCHED)
    met = met.select(*key, F.coalesce("sources", F.lit(0)).alias("sources"), F.coalesce("targets", F.lit(0)).alias("targets"), kind.alias("class"))
    zero = F.lit(0).cast("long")
    loose = left.filter("not whole").select(*key, "sources", zero.alias("targets"), F.lit(NO_REFERENCE).alias("class"))
    alone = right.filter("not whole").select(*key, zero.alias("sources"), "targets", F.lit(NO_SOURCE).alias("class"))
    return met.unionByName(loose).unionByName(alone)


def rows_to_manifest(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Audit of rows against the snapshots that they come from, on hash and time of observation."""
    return audit(rows.select("snapshot_sha256", "observed_at"), manifest.select(F.col("sha256").alias("snapshot_sha256"), F.col("collected_at").alias("observed_at")), ["snapshot_sha256", "observed_at"])


def expenses_to_contracts(expenses: DataFrame, contracts: DataFrame) -> DataFrame:
    """Audit of expense events against the contracts that they name, in their city."""
    return audit(expenses.select("city_slug", "contract_number"), contracts.select("city_slug", "contract_number"), ["city_slug", "contract_number"])
