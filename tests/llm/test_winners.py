from ledgerscope.llm import jaccard_join


def test_one_document_of_each_component(spark):
    """Null and repeated ids: each component of different texts keeps one row; texts without words stay."""
    w = " ".join(f"w{i}" for i in range(60))
    v = " ".join(f"v{i}" for i in range(60))
    u = " ".join(f"u{i}" for i in range(60))
    rows = [(None, f"{w} {k}") for k in "abc"] + [(5, f"{v} {k}") for k in "abc"] + [(7, f"{v} d"), (None, f"{v} e")]
    rows += [(9, u), (None, u), (2, f"{u} z"), (None, None), (None, ""), (8, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in jaccard_join.drop_near_duplicates(docs, size=3, threshold=(80, 100)).collect()]
    group = lambda c: [i for i, t in left if (t or "").startswith(c)]
    assert (group("w"), group("v"), group("u")) == ([None], [5], [2])
    assert len(left) == 6 and set(left) >= {(None, None), (None, ""), (8, "alone")}


def test_repeated_rows(spark):
    """Rows that repeat id and text: all stay by default, one without repeats; clashing names keep their values."""
    w = " ".join(f"w{i}" for i in range(60))
    rows = [(1, w, "p")] * 5 + [(2, f"{w} z", "q"), (3, None, "r"), (3, None, "r"), (4, "alone", "s"), (4, "alone", "s"), (None, f"{w} y", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid string")
    for repeats, n in ((True, [1] * 5 + [3, 3, 4, 4]), (False, [1, 3, 3, 4])):
        left = jaccard_join.drop_near_duplicates(docs, size=3, threshold=(80, 100), repeats=repeats).collect()
        assert sorted(r["doc_id"] for r in left) == n and {r["rid"] for r in left} == set("prs")
