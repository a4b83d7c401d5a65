from ledgerscope.llm import url_filter


def test_salts_follow_hot_labels_and_repeat_no_more_rules_than_pages(spark):
    pages = spark.createDataFrame([(1,)] * 1000 + [(2,)] * 300 + [(3,)] * 90 + [(4,)] * 200, "top long")
    rules = spark.createDataFrame([(1,)] * 5 + [(2,)] * 150 + [(4,)] * 400 + [(9,)], "top long")
    got = {r["top"]: r["salts"] for r in url_filter.hot_tops(pages, rules, rows_per_salt=100).collect()}
    assert got == {1: 10, 2: 2}  # 3 isn't hot, 4 has more rules than pages


def test_hot_labels_are_judged_alike_with_and_without_salts(spark, monkeypatch):
    urls = [f"http://{h}/{p}/x" for h in ("a.example.net", "example.com", "b.org", "other.io") for p in ("en", "de", "fr")] * 20 + [None, "no scheme"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = url_filter.rules_table(spark)
    rows = lambda df: sorted(map(tuple, df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    plain = rows(url_filter.judge_urls(pages, rules, salts=1))
    hot = url_filter.hot_tops
    monkeypatch.setattr(url_filter, "hot_tops", lambda p, r: hot(p, r, rows_per_salt=7))
    assert rows(url_filter.judge_urls(pages, rules)) == plain and len(plain) == len(urls)
