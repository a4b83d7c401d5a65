"""Documents of one template: many shared words, some of their own."""

import random

import numpy as np
import pytest

from ledgerscope.llm import jaccard_join
from ledgerscope.llm.common import Scratch
from pyspark.sql import functions as F

from test_texts import brute_components, found, frame


def templated(seed, count, shared=60, own=(8, 8)):
    r = random.Random(seed)
    words = [f"t{i}" for i in range(shared)]
    return [(i, " ".join(words + [f"w{r.randrange(10**9)}" for _ in range(r.randint(*own))])) for i in range(count)]


def opened(spark, rows, size, num):
    """Pairs of sets that the first and the second step open at most."""
    docs = frame(spark, rows).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"))
    with Scratch(spark) as scratch:
        facts = scratch.write(docs.mapInArrow(jaccard_join._describe(size), jaccard_join._FACTS))
        order = jaccard_join.shingle_order(facts)
        every = scratch.write(docs.select("text").mapInArrow(jaccard_join._tokens(size, num, 100, order), "token long, fp long, n int, short boolean"))
        matrix = jaccard_join._matrix(every, num, 100, scratch)
        sets, members = jaccard_join._first_members(matrix, num, 100, jaccard_join.GROUP, scratch)
        labels = scratch.write(sets.select("fp", F.col("fp").alias("comp")))  # as if the first step linked nothing
        both = [members, jaccard_join._next_members(matrix, sets, labels, num, 100, jaccard_join.GROUP, scratch)]
        total = 0
        for m in both:
            m = m.groupBy("pair").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") > 0).alias("b"))
            total += m.agg(F.sum(F.when(F.col("b") > 0, F.col("a") * F.col("b")).otherwise(F.expr("a * (a - 1) div 2")))).first()[0] or 0
        return total


@pytest.mark.parametrize("own", [(8, 8), (8, 16)])
def test_templates_are_not_compared_pair_by_pair(spark, own):
    counts = [opened(spark, templated(3, n, own=own), 5, 80) for n in (500, 2000)]
    assert counts[1] <= 40 * 2000, counts


@pytest.mark.parametrize("size, num, group, own", [(5, 80, 256, (2, 9)), (5, 80, 4, (4, 8)), (3, 90, 8, (1, 5))])
def test_components_of_templates(spark, size, num, group, own):
    rows = templated(7, 60, 40, own) + templated(8, 30, 60, own)
    rows += [(0, t + " more") for _, t in rows[::5]] + [(0, " ".join(t.split(" ")[:-1])) for _, t in rows[::7]]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = jaccard_join.near_duplicates(frame(spark, rows), size=size, threshold=(num, 100), group=group)
    assert found(got) == brute_components(rows, size, num, 100)


def test_short_tokens_of_the_smaller_set_meet_tokens_of_the_larger():
    r = np.random.default_rng(6)
    order = r.integers(0, 9, jaccard_join.CELLS).astype(np.uint8)
    met = 0
    for num in (60, 80, 90):
        for _ in range(400):
            n = int(r.integers(1, 300))
            a = np.unique(r.integers(0, 2**64, n, np.uint64))
            drop, add = int(r.integers(0, n // 5 + 1)), int(r.integers(0, n // 5 + 1))
            b = np.unique(np.concatenate([r.permutation(a)[drop:], r.integers(0, 2**64, add, np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or both * 100 < num * (len(a) + len(b) - both):
                continue
            small, large = sorted((a, b), key=len)
            short = jaccard_join.signatures(small, num, 100, order)[: jaccard_join.short_tokens(len(small), num, 100)]
            shared = len(np.intersect1d(short, jaccard_join.signatures(large, num, 100, order)))
            least = -(-len(large) * num // 100)
            assert shared >= jaccard_join._shared(len(small), num, 100) >= jaccard_join._shared(least, num, 100)
            met += 1
    assert met > 300
