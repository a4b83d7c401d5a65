import zlib

import numpy as np
from conftest import SF

from ledgerscope.llm import language_id

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def junk():
    r = np.random.default_rng(0)
    letters = ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz "), 2000)) for _ in range(10)]
    return [*letters, "日本語のテキストです。" * 20, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 3]


def test_texts_in_no_language_are_dropped(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(10**6 + i, t, None, "src0", len(t)) for i, t in enumerate(junk())], SCHEMA)
    got = {r["doc_id"] for r in language_id.drop_unknown(docs.unionByName(odd)).select("doc_id").collect()}
    assert got == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_without_labels_texts_with_letters_stay(spark):
    rows = [(1, "the cat", None, "s", 7), (2, "日本語", None, "s", 3), (3, "12 !", None, "s", 4), (4, None, None, "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["doc_id"] for r in language_id.drop_unknown(docs).collect()) == [1, 2]
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2)
    only = spark.createDataFrame([(held, "der hund", "de", "s", 8), (1, "the cat", None, "s", 7)], SCHEMA)
    assert language_id.drop_unknown(only).count() == 2


def test_every_labelled_row_counts(spark):
    """More rows of one language than a sample of 4,000 to learn from, or of 1,000 to calibrate on, would keep."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh "), 12)) + "x" for _ in range(6000)]
    names, protos = language_id.learn(spark.createDataFrame([(t, "l") for t in texts], "text string, lang string"), "text", "lang")
    units = np.rint(language_id._unit(language_id.profiles(texts)) * 1e6).astype(np.int64).sum(0)
    assert names == ["l"] and np.allclose(protos[0], units / np.linalg.norm(units), atol=1e-12)

    long = "".join(rng.choice(list("abcdefghijklmnop"), 400))  # 30 of 3,000 rows: a sample of a third holds too few for a limit
    docs = spark.createDataFrame([(long if i % 100 == 0 else "ab", "l") for i in range(3000)], "text string, lang string")
    both = language_id._unit(language_id._unit(language_id.profiles([long, "ab"])).sum(0, keepdims=True))
    limits = language_id.calibrate(docs, ["l"], both, "text", "lang")
    scores = (language_id._unit(language_id.profiles([long, "ab"])) * both).sum(1)
    assert abs(limits[7] - language_id.PART * int(scores[0] * language_id.BINS) / language_id.BINS) < 1e-9
    odd = language_id._unit(language_id.profiles([long]))
    limits = language_id.calibrate(docs, ["l"], odd, "text", "lang")
    assert limits[7] == language_id.PART * (language_id.BINS - 1) / language_id.BINS and limits[1] < 0.2
