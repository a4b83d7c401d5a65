import re
from collections import Counter

from conftest import SF
from test_texts import brute_components

import __spark_entry__
import corpus_pipeline
from ledgerscope.llm.common import written


def test_registry():
    names = list(__spark_entry__.queries())
    assert [n for n in names if n == "pipeline" or n.startswith("op")][0] == "pipeline"
    assert {re.match(r"op(\d+)_", n)[1] for n in names if re.match(r"op\d+_", n)} == {str(i) for i in range(1, 14)}
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_stages(spark):
    """Each stage on what the one before it kept, held against a plain version of its rule."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(900_001, None, "en", "src0", 0), (900_002, "123 456", "en", "src0", 7), (900_003, "", None, None, 0)]
    docs = written(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == columns
    ids = [sorted(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert ids[1] == sorted(i for i, t in texts.items() if any(c.isalpha() for c in t or ""))
    last = {}
    for i in ids[1]:
        last[texts[i]] = max(i, last.get(texts[i], i))
    assert ids[2] == sorted(last.values())
    near = brute_components([(i, texts[i]) for i in ids[2]], 5, 80, 100)
    assert ids[3] == sorted(i for i, _, c in near if i == c)
    assert set(ids[4]) <= set(ids[3]) and max(Counter(ids[4]).values()) <= 2
    words = lambda i: len(re.findall(r"[^\x20\x09-\x0D]+", texts[i]))
    assert abs(sum(map(words, ids[4])) / sum(map(words, ids[3])) - 1.5) < 0.1
    packed = kept[5].groupBy("doc_id").agg({"words": "sum"}).collect()
    assert {r["doc_id"]: r[1] for r in packed} == {i: n * words(i) for i, n in Counter(ids[4]).items()}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
