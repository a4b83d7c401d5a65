"""WARC archives: written with revisit records for equal payloads, read back by verifying the chain of record boundaries.

Writing. Payload digests are grouped once, and a bitmap of those that repeat lets all other pages pass straight to
their file; only pages with a repeated digest shuffle, salted, to learn which of them holds the payload. Spark's text
writer ends each record with the two blank lines of the format.

Reading. Spark's text reader splits archives of any size at the magic `WARC/1.1` line, so every occurrence of it is a
candidate record, those inside payloads too. Running sums of the candidates' lengths, by block of a file and then over
blocks, give their offsets; a candidate's Content-Length gives the offset of its successor. Within a segment of
`SEGMENT` bytes pointers are doubled in one task; over segments a table of exits is doubled by joins. Candidates that
can't be reached from the start of their file are parts of payloads. A payload with the magic inside is put together
again from its pieces.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, bitmap, salted_join, shared_folder, split_by, written

# Lines of the format.
MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32, _DIGITS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"

#: Bytes of a file whose candidates one task links.
SEGMENT = 1 << 26


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: five hexadecimal digits make four."""
    hexed = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(hexed, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), _DIGITS32, _BASE32)


def _with_types(pages: DataFrame, least_bytes: int) -> DataFrame:
    """pages (page_id, url, body) with digest, record_type, refers_to (a page_id) and copy, which tells repeated rows apart."""
    rows = pages.withColumns({"digest": base32_sha1(F.col("body")), "bytes": F.octet_length("body").cast("long")})
    large, small = rows.filter(F.col("bytes") >= least_bytes), rows.filter(F.col("bytes") < least_bytes)
    repeated = large.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
    words = written(bitmap(repeated.select(F.xxhash64("digest").alias("h")), "h"))
    several, alone = split_by(large.withColumn("h", F.xxhash64("digest")), "h", words)
    alone = alone.drop("h").unionByName(small) if least_bytes > 0 else alone
    # Written, as the copy numbers have to stay the same for all that reads them.
    several = written(several.withColumn("copy", F.monotonically_increasing_id()))
    # The largest page_id, then copy; a null page_id is smaller than any other.
    kept = several.groupBy("digest").agg(F.max(F.struct("page_id", "copy")).alias("kept"))
    several = salted_join(several, kept, "digest", "copy", "inner", 32)
    is_kept = F.col("copy") == F.col("kept.copy")
    several = several.select(
        "page_id", "url", "body", "digest", "bytes", F.when(is_kept, "response").otherwise("revisit").alias("record_type"),
        F.when(~is_kept, F.struct(F.col("kept.page_id").alias("page_id"))).alias("target"), F.when(~is_kept, F.col("copy")).alias("copy"),
    )
    alone = alone.select(
        "page_id", "url", "body", "digest", "bytes", F.lit("response").alias("record_type"),
        F.lit(None).cast(several.schema["target"].dataType).alias("target"), F.lit(None).cast("long").alias("copy"),
    )
    return several.unionByName(alone)


def _record(page_id: Column, digest: Column, copy: Column | None = None) -> Column:
    """A record's address; a null page_id leaves its place empty."""
    parts = [F.coalesce(page_id.cast("string"), F.lit("")), digest]
    return F.concat(F.lit("<urn:x-page:"), F.concat_ws(":", *parts, *([copy] if copy is not None else [])), F.lit(">"))


def write_archive(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """One record a page in WARC files under folder, which must not exist; other columns aren't written.

    The payload is the html in UTF-8; null counts as empty. Of pages with equal payloads of at least least_bytes
    bytes, the one with the largest id (null is smallest; of repeated rows any one) is the response, the others are
    revisit records without a payload that refer to it. Smaller payloads are all responses. A null url leaves
    its line out; line breaks in a url are percent-encoded. Texts of any length are written whole. An empty
    table makes an archive without records.
    """
    rows = _with_types(pages.select(F.col(f"`{id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("body")), least_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(END))
    revisit = F.col("record_type") == "revisit"
    address = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat_ws(
        "\r\n", F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record(F.col("page_id"), F.col("digest"), F.col("copy"))), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), address), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record(F.col("target.page_id"), F.col("digest")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")), F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))),
    )
    record = F.concat(F.lit(MAGIC), head, F.lit(END), http, F.when(revisit, "").otherwise(F.col("body")))
    rows.select(record.alias("value")).write.option("lineSep", END).text(folder)


def _field(head: Column, name: str) -> Column:
    """A named field of the lines after the magic; null where there is none."""
    return F.nullif(F.regexp_extract(head, rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Every occurrence of the magic: file, block, id (order within a block), len (bytes to the next one), what its header says, and a hash of its bytes.

    The text before the first magic of a file is a candidate too, without a size. hlen and clen are the bytes of header
    and content; digest and payload_bytes are those of a payload that lies in the candidate whole.
    """
    lines = spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value"
    )
    head = F.substring_index("value", END, 1)
    rows = lines.withColumns({"head": head, "hlen": F.octet_length(head).cast("long") + len(END), "len": F.octet_length("value").cast("long") + len(MAGIC)})
    rows = rows.withColumn("clen", F.regexp_extract(_field(F.col("head"), "Content-Length"), r"^\d{1,9}$", 0).try_cast("long"))
    whole = F.col("clen") + F.col("hlen") + len(END) + len(MAGIC) <= F.col("len")
    block = F.when(whole, F.expr("substring(cast(value as binary), int(hlen) + 1, int(clen))"))
    return rows.select("file", "block", "id", "len", "hlen", "clen", whole.alias("whole"), F.sha2("value", 256).alias("hash"), *_facts(F.col("head"), block))


def _facts(head: Column, block: Column) -> list[Column]:
    """Columns of a record from its header and its content, the latter null where it isn't known yet."""
    http = F.substring_index(block.cast("string"), END, 1)
    payload = F.substring(block, F.octet_length(http) + len(END) + 1, F.lit((1 << 31) - 1))
    revisit = _field(head, "WARC-Type") == "revisit"
    numbers = lambda name: F.regexp_extract(_field(head, name), r"^<urn:x-page:(-?\d+):", 1).try_cast("long")
    return [
        numbers("WARC-Record-ID").alias("page_id"), _field(head, "WARC-Type").alias("record_type"), numbers("WARC-Refers-To").alias("refers_to"),
        F.when(revisit, _field(http, "Content-Length").try_cast("long")).otherwise(F.octet_length(payload).cast("long")).alias("payload_bytes"),
        F.when(revisit, F.replace(_field(head, "WARC-Payload-Digest"), F.lit("sha1:"), F.lit(""))).otherwise(base32_sha1(payload)).alias("payload_digest"),
    ]


def with_offsets(rows: DataFrame) -> DataFrame:
    """Candidates with at, the offset of their magic, and next, the offset after what their header says (null without a size).

    Lengths are added up within each block of a file, then over its blocks.
    """
    within = rows.withColumn("end", F.sum("len").over(W.partitionBy("file", "block").orderBy("id")))
    blocks = rows.groupBy("file", "block").agg(F.sum("len").alias("size"))
    blocks = blocks.select("file", "block", (F.sum("size").over(W.partitionBy("file").orderBy("block")) - F.col("size")).alias("base"))
    # A line starts after its magic; the first of a file has none.
    placed = within.join(blocks, ["file", "block"]).withColumn("at", F.col("base") + F.col("end") - F.col("len") - len(MAGIC))
    return placed.filter("at >= 0").withColumn("next", F.col("at") + len(MAGIC) + F.col("hlen") + F.col("clen") + len(END)).drop("base", "end")


def _linked(group: pd.DataFrame, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of a segment's candidates in order, the index that each points to (its own if it leaves the segment), and next (-1: nowhere)."""
    group = group.sort_values("at")
    at, after = group["at"].to_numpy(np.int64), group["next"].fillna(-1).to_numpy(np.int64)
    end = (at[0] // segment + 1) * segment
    index = np.minimum(np.searchsorted(at, after), len(at) - 1)
    inside = after < end
    hits = inside & (at[index] == after)
    return at, np.where(hits, index, np.arange(len(at))), np.where(inside & ~hits, -1, after)


def _exits(segment: int):
    def work(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """The first offset beyond the segment that each candidate leads to."""
        at, to, after = _linked(group, segment)
        for _ in range(len(at).bit_length()):
            to = to[to]
        ends = after[to]
        return pd.DataFrame({"file": key[0], "at": at[ends >= 0], "exit": ends[ends >= 0]})

    return work


def _reached(segment: int):
    def work(key: tuple, group: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        """The candidates of a segment that its entry leads to."""
        if group.empty or entries.empty:
            return pd.DataFrame({"file": [], "at": []}).astype({"file": str, "at": "int64"})
        at, to, _ = _linked(group, segment)
        seen = np.isin(at, entries["at"].to_numpy())
        for _ in range(len(at).bit_length()):  # whatever lies up to 2^k records behind the entry
            seen[to[seen]] = True
            to = to[to]
        return pd.DataFrame({"file": key[0], "at": at[seen]})

    return work


def reachable(placed: DataFrame, scratch: Scratch, segment: int = SEGMENT) -> DataFrame:
    """(file, at) of the candidates that the chain of records from offset 0 leads to; placed is a written table."""
    links = placed.select("file", "at", "next", F.expr(f"at div {segment}").alias("segment"))
    entries = placed.select("file", F.lit(0).cast("long").alias("at")).distinct()
    most = links.agg(F.max("segment")).first()[0]
    if most:  # some file has several segments: entries reached after 1, 2, 4, ... exits
        jumps = scratch.write(links.groupBy("file", "segment").applyInPandas(_exits(segment), "file string, at long, exit long"))
        entries = scratch.write(entries)
        for _ in range(int(most).bit_length()):
            further = entries.join(jumps, ["file", "at"]).select("file", F.col("exit").alias("at"))
            entries = scratch.write(entries.unionByName(further).distinct())
            second = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("then"))
            jumps = scratch.write(jumps.join(second, ["file", "exit"]).select("file", "at", F.col("then").alias("exit")))
    entries = entries.withColumn("segment", F.expr(f"at div {segment}"))
    return links.groupBy("file", "segment").cogroup(entries.groupBy("file", "segment")).applyInPandas(_reached(segment), "file string, at long")


def read_archive(spark: SparkSession, folder: str, segment: int = SEGMENT) -> DataFrame:
    """The records of the WARC files under folder: file, at (offset), page_id, record_type, refers_to, payload_bytes, payload_digest.

    payload_bytes and payload_digest (SHA-1, base 32) of a response are computed from its payload, those of a revisit record are the
    ones that it states of the payload it refers to. Magic inside payloads makes no record. A file that doesn't start with the
    magic has none; a record cut short by the end of its file is left out. Repeated records are all returned.
    """
    facts = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    with Scratch(spark) as scratch:
        placed = scratch.write(with_offsets(scratch.write(candidates(spark, folder))))
        real = scratch.write(placed.join(reachable(placed, scratch, segment), ["file", "at"]))
        whole = real.filter("whole").select("file", "at", *facts)
        broken = real.filter("not whole").select("file", "at", "next")
        if broken.isEmpty():
            return written(whole)
        return written(whole.unionByName(_mended(spark, folder, placed, broken, scratch).select("file", "at", *facts)))


def _mended(spark: SparkSession, folder: str, placed: DataFrame, broken: DataFrame, scratch: Scratch) -> DataFrame:
    """Records whose content holds the magic: their pieces, found again by hash, are put together."""
    # A record is one value, so its pieces and the segments that it touches are bounded by it.
    touched = F.explode(F.sequence(F.expr(f"at div {SEGMENT}"), F.expr(f"next div {SEGMENT}"))).alias("segment")
    owners = broken.select("file", F.col("at").alias("owner"), F.col("next").alias("stop"), touched)
    inner = placed.withColumn("segment", F.expr(f"at div {SEGMENT}")).join(owners, ["file", "segment"]).filter("at >= owner and at < stop")
    pieces = scratch.write(inner.select("file", "owner", "stop", "at", "hash"))
    words = scratch.write(bitmap(pieces.select(F.xxhash64("hash").alias("h")), "h"))
    lines = spark.read.option("lineSep", MAGIC).text(folder).withColumn("hash", F.sha2("value", 256)).withColumn("h", F.xxhash64("hash"))
    texts = split_by(lines, "h", words)[0].groupBy("hash").agg(F.any_value("value").alias("value"))
    joined = pieces.join(texts, "hash").groupBy("file", F.col("owner").alias("at"), "stop").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    head = F.substring_index("text", END, 1)
    rows = joined.select("file", "at", "stop", text.alias("text")).withColumn("head", head)
    start = F.octet_length("head") + len(END)
    size = (F.col("stop") - F.col("at") - len(MAGIC) - len(END)).cast("int") - start
    block = F.substring(F.col("text").cast("binary"), start + 1, size)
    return rows.filter(F.octet_length("text") >= start + size + len(END)).select("file", "at", *_facts(F.col("head"), block))


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) written to an archive and read back; see write_archive and read_archive. The archive stays."""
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/ledgerscope-warc-{uuid.uuid4().hex}"
    write_archive(pages, folder, least_bytes=least_bytes)
    return read_archive(spark, folder)


# The digest's 160 bits in fives. Of rows that repeat a page one is the response.
ORACLE = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
bits AS (SELECT *, list_transform(range(8), lambda p: ('0x' || substr(x, p * 5 + 1, 5))::BIGINT) AS parts FROM hashed),
digests AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest FROM bits),
ranked AS (SELECT *, row_number() OVER w AS r, first_value(page_id) OVER w AS kept FROM digests
  WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN r > 1 THEN kept END AS refers_to FROM ranked
"""
