"""A versioned store of the model's tables as Parquet, laid out by a hash of the key.

A table is cut into buckets; a version says for each bucket which folders hold it. A merge reads and writes
only the buckets that its rows fall into: insert-or-ignore adds a folder with the keys that are new, insert-or-replace writes
the bucket again; all other buckets are carried over by name. Rows with a null in the key never conflict; they have a
bucket of their own that is only added to.

A version counts once its record stands in versions/. The record is created in one step that fails if it is
there (compare and swap): of two writers one is first, and the other takes its changes over to the new version, or merges
again if the first one touched the same buckets. A run that fails leaves the last version in force. `clean` removes the
folders that no kept version names.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerscope.operators.merge import null_in, required_or_error, winners
from ledgerscope.schemas import TABLES

#: Buckets of a table that is written for the first time.
BUCKETS = 16
#: The bucket of rows with a null in their key.
LOOSE = -1
#: Times that a merge is taken over to a newer version before it gives up.
TRIES = 100


class Conflict(RuntimeError):
    """Another writer made a version from the same one and was first."""


@dataclass(frozen=True)
class First:
    """Rows to insert unless their key is there; the first by seq of several."""

    rows: DataFrame
    seq: str = "seq"
    last = False


@dataclass(frozen=True)
class Last:
    """Rows to insert or to put in the place of those with their key; the last by seq of several."""

    rows: DataFrame
    seq: str = "seq"
    last = True


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, place = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, place = _fs(spark, path)
    fs.delete(place, True)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, place = _fs(spark, path)
    stream = fs.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with this text in one step; False if it is there.

    The text is written beside it first. A rename that refuses an existing target puts it in place, as HDFS has it;
    on a local disk, where a rename would replace the target, a hard link does.
    """
    spare = f"{path}.{uuid.uuid4().hex}"
    fs, place = _fs(spark, spare)
    fs.mkdirs(place.getParent())
    stream = fs.create(place, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() != "file":
            return bool(fs.rename(place, spark._jvm.org.apache.hadoop.fs.Path(path)))
        local = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
        try:
            os.link(local(spare), local(path))
        except FileExistsError:
            return False
        return True
    finally:
        fs.delete(place, False)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{root}/versions") if n.endswith(".json") and n[:-5].isdigit())


def _record(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(_read_text(spark, f"{root}/versions/{number:010d}.json"))


def _in_force(spark: SparkSession, root: str) -> tuple[int, str | None, dict]:
    """Number, name and tables of the last version; a table has its number of buckets and the folders of each."""
    numbers = _numbers(spark, root)
    if not numbers:
        return 0, None, {}
    last = _record(spark, root, numbers[-1])
    return last["number"], last["name"], last["tables"]


def current(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and name of the version in force; (0, None) before the first."""
    return _in_force(spark, root)[:2]


def _swap(spark: SparkSession, root: str, number: int, name: str, tables: dict) -> bool:
    """Puts a version in force if its number is still free."""
    return _create(spark, f"{root}/versions/{number:010d}.json", json.dumps({"number": number, "name": name, "tables": tables}, sort_keys=True))


def bucket_of(table: str, buckets: int) -> Column:
    key = TABLES[table].key
    return F.when(null_in(key), F.lit(LOOSE)).otherwise(F.pmod(F.xxhash64(*key), F.lit(buckets))).cast("int")


def _rows(spark: SparkSession, root: str, table: str, places: dict | None, only: set[int] | None = None) -> DataFrame:
    """The rows of a table, or of some of its buckets."""
    schema = TABLES[table].schema
    parts = {b: folders for b, folders in (places or {}).get("parts", {}).items() if only is None or int(b) in only}
    paths = sorted(f"{root}/{folder}/{table}/bucket={b}" for b, folders in parts.items() for folder in folders)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the version in force; empty if it hasn't been written."""
    return _rows(spark, root, table, _in_force(spark, root)[2].get(table))


def lookup(spark: SparkSession, root: str, table: str, keys: DataFrame) -> DataFrame:
    """The rows of a table with one of these keys, read from the keys' buckets alone."""
    places = _in_force(spark, root)[2].get(table)
    if not places:
        return _rows(spark, root, table, None)
    key = list(TABLES[table].key)
    wanted = keys.select(*[F.col(k).cast(TABLES[table].schema[k].dataType).alias(k) for k in key]).distinct()
    touched = {r[0] for r in wanted.select(bucket_of(table, places["buckets"])).distinct().collect()}
    return _rows(spark, root, table, places, touched - {LOOSE}).join(wanted, key, "left_semi").select(*TABLES[table].names)


def _write(frame: DataFrame, root: str, folder: str, table: str, buckets: int) -> dict[str, list[str]]:
    """Writes rows by bucket; returns the folder that each bucket with rows has now."""
    marked = frame.select(*TABLES[table].names).withColumn("bucket", bucket_of(table, buckets))
    # A bucket's rows go to a few tasks by key, those without a key to all.
    marked = marked.repartition("bucket", F.when(F.col("bucket") == LOOSE, F.pmod(F.xxhash64(*TABLES[table].names), F.lit(64))))
    marked.write.partitionBy("bucket").parquet(f"{root}/{folder}/{table}")
    names = _names(frame.sparkSession, f"{root}/{folder}/{table}")
    return {n.partition("=")[2]: [folder] for n in names if n.startswith("bucket=")}


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame]) -> str:
    """Writes a new version with these tables as wholes, the others carried over by name, and puts it in force; may raise Conflict."""
    number, _, places = _in_force(spark, root)
    name = f"v{number + 1}-{uuid.uuid4().hex[:8]}"
    placed = {}
    for table, frame in tables.items():
        buckets = places.get(table, {}).get("buckets", BUCKETS)
        placed[table] = {"buckets": buckets, "parts": _write(frame, root, name, table, buckets)}
    if not _swap(spark, root, number + 1, name, places | placed):
        raise Conflict(f"version {number + 1} of {root} is another writer's; {name} isn't in force")
    return name


def _offered(spark: SparkSession, root: str, name: str, table: str, change: First | Last) -> int:
    """Writes the rows of a change beside the version that is made, once, and returns how many were offered, counted by that write."""
    schema, seen = TABLES[table], Observation()
    rows = change.rows.observe(seen, F.count(F.lit(1)).alias("n"))
    rows = required_or_error(rows, schema, change.seq) if change.last else rows.filter(~null_in(schema.required))
    rows.select(*schema.names, F.col(change.seq).alias("seq"), null_in(schema.key).alias("loose")).write.parquet(f"{root}/{name}/_offered/{table}")
    return seen.get["n"]


def _merged(spark: SparkSession, root: str, folder: str, name: str, table: str, change: First | Last, places: dict | None) -> tuple[dict, set[int]]:
    """The table's places after a merge, and the buckets that it had to look at."""
    schema, buckets = TABLES[table], (places or {}).get("buckets", BUCKETS)
    offered = spark.read.parquet(f"{root}/{name}/_offered/{table}")
    keyed = winners(offered.filter("not loose").drop("loose"), schema.key, "seq", last=change.last).select(*schema.names)
    touched = {r[0] for r in offered.filter("not loose").select(bucket_of(table, buckets)).distinct().collect()}
    stored = _rows(spark, root, table, places, touched)
    if change.last:
        keyed = keyed.unionByName(stored.join(keyed.select(*schema.key), list(schema.key), "left_anti").select(*schema.names))
    else:
        keyed = keyed.join(stored.select(*schema.key), list(schema.key), "left_anti").select(*schema.names)
    written = _write(keyed.unionByName(offered.filter("loose").select(*schema.names)), root, folder, table, buckets)
    parts = dict((places or {}).get("parts", {}))
    for bucket, folders in written.items():
        replaced = change.last and int(bucket) != LOOSE
        parts[bucket] = folders if replaced else parts.get(bucket, []) + folders
    return {"buckets": buckets, "parts": parts}, touched


def merge(spark: SparkSession, root: str, changes: Mapping[str, First | Last]) -> tuple[str, dict[str, int]]:
    """Merges rows into tables as one version; returns its name and the number of rows offered for each table.

    Rows of a First change that lack a required column are left out, those of a Last change fail the merge. If another
    writer was first, the tables whose touched buckets it left alone are taken over as they are; the others are merged again.
    """
    name = f"v-{uuid.uuid4().hex[:12]}"
    counts = {table: _offered(spark, root, name, table, change) for table, change in changes.items()}
    done: dict[str, tuple[dict | None, dict, set[int]]] = {}
    for attempt in range(TRIES):
        number, _, places = _in_force(spark, root)
        tables = dict(places)
        for table, change in changes.items():
            if table not in done or not _untouched(done[table][0], places.get(table), done[table][2]):
                folder = name if attempt == 0 else f"{name}-{attempt}"
                done[table] = (places.get(table), *_merged(spark, root, folder, name, table, change, places.get(table)))
            tables[table] = _rebased(*done[table][:2], places.get(table))
        if _swap(spark, root, number + 1, name, tables):
            _delete(spark, f"{root}/{name}/_offered")
            return name, counts
    raise Conflict(f"{name} of {root} met another writer {TRIES} times")


def _untouched(base: dict | None, now: dict | None, touched: set[int]) -> bool:
    """Whether the touched buckets are what they were when the merge read them."""
    of = lambda p, b: (p or {}).get("parts", {}).get(str(b), [])
    return (base or {}).get("buckets", BUCKETS) == (now or {}).get("buckets", BUCKETS) and all(of(base, b) == of(now, b) for b in touched)


def _rebased(base: dict | None, merged: dict, now: dict | None) -> dict:
    """What a merge did to base, done to now: changed buckets as merged, and what it added to the rows without a key."""
    old, parts = (base or {}).get("parts", {}), dict((now or {}).get("parts", {}))
    for bucket, folders in merged["parts"].items():
        if folders != old.get(bucket):
            added = [f for f in folders if f not in old.get(bucket, [])]
            parts[bucket] = parts.get(bucket, []) + added if int(bucket) == LOOSE else folders
    return {"buckets": merged["buckets"], "parts": parts}


def compact(spark: SparkSession, root: str, table: str, most: int = 4, buckets: int | None = None) -> str | None:
    """Writes buckets of more than `most` folders again as one, or the whole table in another number of buckets; None if there is nothing to do."""
    number, _, places = _in_force(spark, root)
    now = places.get(table)
    if not now:
        return None
    anew = buckets is not None and buckets != now["buckets"]
    chosen = {int(b) for b, folders in now["parts"].items() if anew or len(folders) > most}
    if not chosen:
        return None
    name = f"v{number + 1}-{uuid.uuid4().hex[:8]}"
    parts = {b: f for b, f in now["parts"].items() if int(b) not in chosen}
    count = buckets if anew else now["buckets"]
    parts |= _write(_rows(spark, root, table, now, chosen), root, name, table, count)
    if not _swap(spark, root, number + 1, name, places | {table: {"buckets": count, "parts": parts}}):
        raise Conflict(f"version {number + 1} of {root} is another writer's; {name} isn't in force")
    return name


def clean(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
    """Removes all versions but the last `keep`, and folders that none of these name; returns the folders.

    Folders changed less than `older_than` seconds ago stay: they may belong to a writer that hasn't finished.
    """
    numbers = _numbers(spark, root)
    for number in numbers[:-keep]:
        _delete(spark, f"{root}/versions/{number:010d}.json")
    named = {f for n in numbers[-keep:] for t in _record(spark, root, n)["tables"].values() for folders in t["parts"].values() for f in folders}
    fs, place = _fs(spark, root)
    limit, gone = (time.time() - older_than) * 1000, []
    for status in fs.listStatus(place) if fs.exists(place) else []:
        folder = status.getPath().getName()
        if folder.startswith("v") and folder != "versions" and folder not in named and status.getModificationTime() <= limit:
            fs.delete(status.getPath(), True)
            gone.append(folder)
    return sorted(gone)
