import hashlib
import random
import re
import zlib

import duckdb
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerscope.llm import period_runs, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            end = i
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - i + q >= max(6, 4 * q):
                found.setdefault((i, end - i + q), q)
            i = max(end, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(brute_collapsed(words, runs)))


parts = st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.integers(1, 9)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(st.lists(parts, max_size=4))
def test_runs_of_grammar(docs):
    texts = [" ".join("".join(p * n for p, n in doc)) for doc in docs]
    got = period_runs._runs_of([*texts, None, ""])
    for text, (runs, collapsed) in zip([*texts, "", ""], got, strict=True):
        assert runs == brute_runs(text.split()) and collapsed == brute_collapsed(text.split(), runs)


def test_runs_do_not_cross_texts_and_slices(monkeypatch):
    monkeypatch.setattr(period_runs, "SLICE_WORDS", 7)
    assert period_runs._runs_of(["a a a", "a a a", "a " * 40, None, "b"]) == [([], "a a a"), ([], "a a a"), ([(0, 40, 1)], "a"), ([], ""), ([], "b")]


def test_long_texts_take_time_in_proportion():
    rng = random.Random(5)
    for words in (["w"] * 200_000, [str(i % 1000) for i in range(200_000)], [str(rng.randrange(3)) for _ in range(100_000)]):
        ((runs, collapsed),) = period_runs._runs_of([" ".join(words)])
        assert (runs == [(0, 200_000, 1)]) == (words[:2] == ["w", "w"]) and len(collapsed) > 0


def test_find_runs_on_edges(spark):
    rows = [
        (1, None, "x", 0), (1, "", "x", 0), (2, "a b " * 4, "x", 0), (2, "a b " * 4, "x", 0), (None, "a " * 6, "x", 0), (4, "a " * 5, None, None),
        (5, "a b a b a b a b a b a b", "x", 0), (6, "é " * 9, "x", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n int")
    got = period_runs.find_runs(docs)
    assert got.columns == ["doc_id", "text", "n", "runs", "collapsed"]
    seen = sorted(((r["doc_id"], r["text"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=repr)
    want = []
    for i, text, _, _ in rows:
        runs = brute_runs(WORD.findall(text or ""))
        want.append((i, text, runs, brute_collapsed(WORD.findall(text or ""), runs)))
    assert seen == sorted(want, key=repr)
    assert period_runs.find_runs(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark, tmp_path):
    words = ["to", "be", "or", "not", "é"]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(120))) if i % 9 else None) for i in range(300)] + [(None, "a " * 9), (7, "b " * 300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute_row(*r) for r in rows), key=repr)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = con.sql(period_runs.ORACLE)
    got = registry.op11_periodic_runs(spark, SF)
    assert got.columns == sql.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(sql.fetchall(), key=repr)
