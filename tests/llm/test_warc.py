import base64
import hashlib
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import SF

from ledgerscope.llm import registry, warc
from ledgerscope.llm.common import Scratch

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99:X>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def digest(body):
    return base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()


def brute(rows, least=0):
    """Counts of (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for body, ids in groups.items():
        size, kept = len(body.encode()), max(ids, key=lambda i: (i is not None, i or 0))
        for n, i in enumerate(sorted(ids, key=lambda i: i != kept)):
            first = n == 0 or size < least
            out.append((i, size, digest(body), "response" if first else "revisit", None if first else kept))
    return Counter(out)


ROWS = [
    (1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, "<p>x</p>"), (3, None, "<p>x</p>"), (None, "http://c/", "<p>x</p>"),
    (4, "http://d/\r\nContent-Length: 3", None), (5, "u", ""), (6, "u", "é😀" * 50), (7, "u", FAKE), (8, "u", "a" + FAKE * 3 + "WARC/1.1\r\nWARC/1.1\r\n"),
    (9, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (10, "u", "WARC/1.1\r\n" * 40), (11, "u", "x" * 20_000), (-12, "u", "minus"),
    (13, "u", "a" + FAKE * 3 + "WARC/1.1\r\nWARC/1.1\r\n"), (None, None, "nobody's"), (14, "u", "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n"),
]


@pytest.mark.parametrize(("least", "segment", "split"), [(0, 1 << 26, "128m"), (0, 700, "1500b"), (10, 64, "300b")])
def test_round_trip(spark, tmp_path, least, segment, split):
    pages = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, digest string, file int").repartition(2)
    warc.write_archive(pages, str(tmp_path / "w"), least_bytes=least)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archive(spark, str(tmp_path / "w"), segment).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == brute(ROWS, least)


def test_files_are_archives_by_the_format(spark, tmp_path):
    """A plain reader, record after record, over the bytes of each file."""
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "w"))
    bodies, ids, revisits = [], set(), []
    for path in Path(tmp_path / "w").glob("part-*"):
        data, at = path.read_bytes(), 0
        while at < len(data):
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
            start = at + len(head) + 4
            content = data[start : start + int(fields["Content-Length"])]
            at = start + len(content) + 4
            assert data[at - 4 : at] == b"\r\n\r\n" and fields["WARC-Record-ID"] not in ids
            ids.add(fields["WARC-Record-ID"])
            if fields["WARC-Type"] == "revisit":
                revisits.append(fields["WARC-Refers-To"])
            else:
                bodies.append(content.partition(b"\r\n\r\n")[2].decode())
    assert sorted(bodies) == sorted({h or "" for _, _, h in ROWS}) and len(ids) == len(ROWS) and set(revisits) <= ids


def test_only_reachable_candidates_of_each_file(spark, tmp_path):
    record = lambda n: f"WARC/1.1\r\nWARC-Record-ID: <urn:x-page:{n}:D>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    (tmp_path / "good").write_bytes((record(1) + record(2)).encode())
    (tmp_path / "cut").write_bytes((record(3) + record(4))[:-6].encode())
    (tmp_path / "late").write_bytes(("junk" + record(5)).encode())
    assert sorted(r["page_id"] for r in warc.read_archive(spark, str(tmp_path)).collect()) == [1, 2, 3]
    with Scratch(spark) as scratch:
        placed = scratch.write(warc.with_offsets(warc.candidates(spark, str(tmp_path / "good"))))
        assert [r["at"] for r in placed.orderBy("at").collect()] == [0, len(record(1))]


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages, str(tmp_path / "w")).collect() == []


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    sql, got = con.sql(warc.ORACLE), registry.op13_warc(spark, SF)
    assert got.columns == sql.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(sql.fetchall(), key=repr)
    assert re.fullmatch("[A-Z2-7]{32}", got.first()["payload_digest"])
