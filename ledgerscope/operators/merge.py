"""Keyed merges: first wins, last wins, and distinct within one collection.

Arrival order is an explicit column, never the order of rows. Rows with a null in the key never conflict and
are split off before any shuffle. New rows are reduced to one a key before they meet the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.expr import canonical_json
from ledgerscope.schemas import Table


def null_in(names: Sequence[str]) -> Column:
    """Whether one of these columns is null."""
    found = F.lit(False)
    for name in names:
        found = found | F.col(name).isNull()
    return found


def winners(rows: DataFrame, key: Sequence[str], seq: str, last: bool = False) -> DataFrame:
    """One row a key, the first or last by seq: an aggregate with partial sums, so a hot key never fills a task."""
    pick = F.max_by if last else F.min_by
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*key).agg(pick(whole, F.col(seq)).alias("won")).select("won.*")


def first_wins(new: DataFrame, table: Table, seq: str, stored: DataFrame | None = None) -> DataFrame:
    """Insert-or-ignore: a stored row wins over new ones, an earlier new one over later ones.

    Rows that lack a required column are dropped; rows with a null in the key are all kept.
    """
    new = new.filter(~null_in(table.required))
    loose = new.filter(null_in(table.key)).select(*table.names)
    keyed = winners(new.filter(~null_in(table.key)), table.key, seq).select(*table.names)
    if stored is None:
        return keyed.unionByName(loose)
    keyed = keyed.join(stored.select(*table.key), list(table.key), "left_anti").select(*table.names)
    return stored.select(*table.names).unionByName(keyed).unionByName(loose)


def required_or_error(rows: DataFrame, table: Table, seq: str) -> DataFrame:
    """rows, of which one that lacks a required column fails the query."""
    for name in table.required:
        problem = F.raise_error(F.concat(F.lit(f"NOT NULL constraint: {name} in row "), F.col(seq).cast("string")))
        rows = rows.withColumn(name, F.coalesce(F.col(name), problem.cast(table.schema[name].dataType)))
    return rows


def last_wins(new: DataFrame, table: Table, seq: str, stored: DataFrame | None = None) -> DataFrame:
    """Insert-or-replace: a new row wins over a stored one, a later new one over earlier ones, as a whole row.

    A row that lacks a required column fails the query; rows with a null in the key are all kept.
    """
    checked = required_or_error(new, table, seq)
    loose = checked.filter(null_in(table.key)).select(*table.names)
    keyed = winners(checked.filter(~null_in(table.key)), table.key, seq, last=True).select(*table.names)
    if stored is None:
        return keyed.unionByName(loose)
    kept = stored.join(keyed.select(*table.key), list(table.key), "left_anti").select(*table.names)
    return kept.unionByName(keyed).unionByName(loose)


def distinct_seen(rows: DataFrame, control: str, seq: str) -> DataFrame:
    """The first row of each control number; rows without one are told apart by all their columns."""
    columns = [c for c in rows.columns if c != seq]
    identity = F.coalesce(F.nullif(F.col(control), F.lit("")), canonical_json(columns))
    marked = rows.withColumn("__key", identity)
    return winners(marked, ["__key"], seq).drop("__key")


def quarantine(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """rows that pass all checks, and the others with the names of those they fail."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    marked = rows.withColumn("failed", failed)
    return marked.filter(F.size("failed") == 0).drop("failed"), marked.filter(F.size("failed") > 0)
