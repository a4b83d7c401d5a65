"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Prefix of internal columns; input columns travel inside one struct, so their names can't clash.
_P = "__ls_"
ROW = _P + "row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame) -> Column:
    """All columns of df as one struct, so that an operator can add its own beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def unpacked(df: DataFrame, columns: list[str], added: dict[str, Column]) -> DataFrame:
    """The input columns again, then the operator's; an input column of the same name gives way."""
    kept = [F.col(f"{ROW}.`{c}`").alias(c) for c in columns if c not in added]
    return df.select(*kept, *[v.alias(k) for k, v in added.items()])


@lru_cache(None)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerscope-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where none is set, a session in one process gets one of its own; a cluster has to name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster[...] has executors of its own
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return _local_folder()


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder as a checkpoint, with its lineage cut."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash32(value: Column) -> Column:
    """The first 32 bits of MD5 as a long: slow but the same in every SQL engine."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Slots of a bitmap. Its table has SLOTS / 64 rows at most whatever the input, which is what lets it be broadcast.
SLOTS = 1 << 26


def bitmap(keys: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """(word, bits): a set of hashed keys, 64 slots to a word."""
    slot = F.pmod(F.col(key), F.lit(slots))
    return keys.select((slot.alias("slot"))).distinct().groupBy(F.expr("slot div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot % 64))")).alias("bits")
    )


def split_by(rows: DataFrame, key: str, words: DataFrame, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """rows whose key may be in the bitmap, and rows whose key surely isn't; no row shuffles."""
    words = F.broadcast(words.select(F.col("word").alias("__ls_w"), F.col("bits").alias("__ls_b")))
    slot = f"pmod({key}, {slots}L)"
    joined = rows.join(words, F.expr(f"{slot} div 64") == F.col("__ls_w"), "left")
    hit = F.coalesce(F.expr(f"shiftrightunsigned(__ls_b, int({slot} % 64)) & 1L") == 1, F.lit(False))
    joined = joined.withColumn("__ls_hit", hit).drop("__ls_w", "__ls_b")
    return joined.filter("__ls_hit").drop("__ls_hit"), joined.filter("not __ls_hit").drop("__ls_hit")


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_folder(df.sparkSession)}/ledgerscope-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: smaller than a checkpoint.

    A lost executor costs no work that is written; the table stays until the folder is cleared (but see Scratch).
    """
    return _stored(df)[0]


class Scratch:
    """Written tables that go when they have served: with drop, or when the block ends.

    Only tables whose readers have been written themselves may go; results are written outside of it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        for path in [*self.paths.values()]:
            self._delete(path)

    def write(self, df: DataFrame) -> DataFrame:
        table, path = _stored(df)
        self.paths[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(self.paths.pop(id(table)))

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def salted_join(left: DataFrame, right: DataFrame, key: str | list[str], by: str | list[str], how: str, salts: int = 16) -> DataFrame:
    """left joined with right, which has one row a key, on key; a hot key of left spreads by a hash of its columns `by`."""
    key, by = ([x] if isinstance(x, str) else x for x in (key, by))
    left = left.withColumn("__ls_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    right = right.withColumn("__ls_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*key, "__ls_salt"], how).drop("__ls_salt")


#: A key with more than one of so many rows is hot, so there are fewer hot keys than that.
HOT_SHARE = 1000


def hot_keys(df: DataFrame, key: str) -> list:
    """The hot keys of a written table."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return [row[0] for row in counts.filter(F.col("n") * HOT_SHARE > df.count()).select(key).collect()]


def hot_join(left: DataFrame, right: DataFrame, key: str, by: str, hot: list, how: str = "inner", salts: int = 32) -> DataFrame:
    """left joined with right on key; hot keys of left spread by a hash of its column `by`, the others join as they are."""
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    left = left.withColumn("__ls_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0))
    every = F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(0))
    right = right.withColumn("__ls_salt", F.explode(every))
    return left.join(right, [key, "__ls_salt"], how).drop("__ls_salt")


#: For oracle SQL: a common table expression with the table of CRC-32, and the checksum of an ASCII text beside it.
CRC_STEPS = """steps AS (SELECT list(t ORDER BY b) AS crc FROM (SELECT range AS b,
  list_reduce(list_prepend(range, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256)))"""


def crc32_sql(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)"
