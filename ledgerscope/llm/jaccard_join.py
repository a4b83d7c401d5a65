"""N-gram Jaccard join over a token-group matrix: every link counts, the result is connected components.

Tokens. A document is a set of n word shingles. Sets of n and m >= n with a similarity of t or more share t / (1 + t) * (n + m)
shingles at least: ceil(2 t n / (1 + t)) by the smaller one's size, ceil(t m) by the larger one's. So for any k up to that they share k tokens
of the smaller set's first n - ceil(2 t n / (1 + t)) + k, its short tokens, with the larger set's first m - ceil(t m) + k, in any
order that all sets use. The order is by rising frequency, as counted over all documents in a table of fixed size
(CELLS counters of hashed shingles); k is a fortieth of n. So a document's tokens in the matrix are its rarest
shingles (a fifth of them at 0.8, a ninth as short ones), and one that shares too few of them with others has no link. Documents
of one template, where many shingles are common and a few are their own, have mostly their own as short tokens, and
don't meet. The counts decide how much is opened, never what is linked.

Groups. Documents that overlap enough with the smallest set on one of their tokens take that set as their label; labels
are cut into groups bounded in documents and in shingles. Each group is opened with itself, and where a label has several
with some PIONEERS of its documents, which links groups of copies without trying all pairs. In the next step the documents of
a group that are connected to its label stand for one group over all cuts, the others of it for another.

Matrix. A row for each token in the union of a group's tokens, and whether it is a short token of a member. A query document's
overlap with a group's union bounds its overlap with each member, once as the smaller set (its short tokens in the
union) and once as the larger (its tokens in the union of short ones): it qualifies if they share enough. A pair of groups (or
a group with itself), one for the smaller sets and one for the larger, is opened for documents that qualify, if both sides have some. In an
open pair the bound is taken again over the unions of all shingles, blocks whose sizes differ too much are
passed over, then what is left is verified exactly. Components come from contraction of the links.

Equal sets are one set throughout. Small rows shuffle (token, set); texts only for sets that share enough tokens.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT_SHARE, ROW, Scratch, bitmap, hot_join, hot_keys, packed, split_by, written
from .wordhash import mixed, shingles, word_hashes

GROUP = 4096  # sets in a group, at most
GROUP_SHINGLES = 1 << 20  # shingles in a group, at most (or one set)
BATCH_SHINGLES = 1 << 18  # shingles opened in a task's batch, about
EXTRA = 40  # one more token, and one more to share, for so many shingles
BLOCK = 512  # sets on a side of one product
FLUSH = 1 << 18  # tokens in a batch of rows
PIONEERS = 64  # sets of a label that all its groups are compared with, about
LARGER = 2  # a right side whose sets are compared with smaller ones only
SLICE_ROWS = 1000  # documents whose texts are Python strings at one time

CELL_BITS, SLICES, FAN_IN = 20, 64, 64  # counters of hashed shingles; parts of their table; tables added up in a task
CELLS = 1 << CELL_BITS


def _shared(n, num: int, den: int):
    """How many of their tokens similar sets have in common at least, the smaller of n shingles; for numbers and columns alike."""
    least = F.least if isinstance(n, Column) else min
    whole = (lambda a, b: F.floor(a / b)) if isinstance(n, Column) else (lambda a, b: a // b)
    return least(1 + whole(n, EXTRA), whole(n * num + den - 1, den))


def short_tokens(n: int, num: int, den: int) -> int:
    """How many of the tokens of a set of n shingles meet those of a similar set that isn't smaller."""
    return n + (-2 * n * num) // (num + den) + _shared(n, num, den)


def signatures(tokens: np.ndarray, num: int, den: int, order: np.ndarray | None = None) -> np.ndarray:
    """The tokens of a set (sorted, distinct): its shingles that come first in the order of all sets, its short tokens ahead."""
    n = len(tokens)
    first = n + (-n * num) // den + _shared(n, num, den)
    if order is None:
        return tokens[:first]
    return tokens[np.argsort(order[_cell(tokens)], kind="stable")[:first]]


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _sets(texts: list[str], size: int) -> Iterator[tuple[np.ndarray, int]]:
    """(sorted distinct shingles, hash of the set) of each text."""
    for words in word_hashes(texts, lower=True):
        tokens = np.unique(shingles(words, size))
        yield tokens, int(mixed(np.array([mixed(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))])).view(np.int64)[0])


_FACTS = "doc_id long, rid long, n long, fp long, slice int, part int, cells binary"


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in slices, with their texts: Python strings of a whole batch would take more memory than the batch."""
    for at in range(0, batch.num_rows, SLICE_ROWS):
        part = batch.slice(at, SLICE_ROWS)
        yield part, part.column("text").to_pylist()


def _describe(size: int):
    """A row for each document, and at the end of a partition rows with the counts of its shingles, each set once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, fresh, held = np.zeros(CELLS, np.int64), set(), [], 0
        for part, texts in (x for b in batches for x in _slices(b)):
            found = []
            for tokens, fp in _sets(texts, size):
                found.append((len(tokens), fp))
                if fp not in seen:
                    seen.add(fp)
                    fresh.append(_cell(tokens))
                    held += len(tokens)
                if held >= FLUSH:
                    np.add.at(counts, np.concatenate(fresh), 1)
                    fresh, held = [], 0
            n, fp = ([int(x[i]) for x in found] for i in (0, 1))
            none = [None] * len(found)
            yield _facts(part.column("doc_id"), part.column("rid"), n, fp, none, none, none)
        if fresh:
            np.add.at(counts, np.concatenate(fresh), 1)
        if counts.any():
            part, width, none = TaskContext.get().partitionId(), CELLS // SLICES, [None] * SLICES
            cells = [zlib.compress(counts[i * width : (i + 1) * width].tobytes(), 1) for i in range(SLICES)]
            yield _facts(none, none, none, none, list(range(SLICES)), [part] * SLICES, cells)

    return emit


def _facts(*columns) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
    names = [field.split(" ")[0] for field in _FACTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c for c, t in zip(columns, types)], names)


def _counts(cells: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(cells), np.int64)


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CELLS // SLICES, np.int64)
    for cells in rows["cells"]:
        total = total + _counts(cells)
    return pd.DataFrame({"slice": rows["slice"][:1], "part": rows["part"][:1] // FAN_IN, "cells": [zlib.compress(total.tobytes(), 1)]})


def shingle_order(facts: DataFrame) -> np.ndarray:
    """A level for each counter, higher for frequent ones, from the counts of all partitions, added up FAN_IN at a time.

    What reaches the driver, and every task, has CELLS entries whatever the input.
    """
    parts = facts.filter("slice is not null").select("slice", "part", "cells")
    last = parts.agg(F.max("part")).first()[0] or 0
    with Scratch(facts.sparkSession) as scratch:
        while last > 0:
            parts = parts.groupBy("slice", F.expr(f"part div {FAN_IN}")).applyInPandas(_added, "slice int, part int, cells binary")
            parts, last = scratch.write(parts), last // FAN_IN
        counts = np.zeros((SLICES, CELLS // SLICES), np.int64)
        for row in parts.select("slice", "cells").collect():
            counts[row["slice"]] = _counts(row["cells"])
    return np.floor(4 * np.log2(1 + counts.ravel())).astype(np.uint8)


def _tokens(size: int, num: int, den: int, order: np.ndarray):
    """(token, fp, n, short) of each set, once in a partition."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            many = [len(s) for s in sigs]
            short = np.concatenate([np.arange(m) < short_tokens(n, num, den) for m, n in zip(many, ns)])
            columns = np.concatenate(sigs).view(np.int64), np.repeat(fps, many), np.repeat(np.array(ns, np.int32), many), short
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "fp", "n", "short"])

        sigs, fps, ns, held, seen = [], [], [], 0, set()
        for _, texts in (x for b in batches for x in _slices(b)):
            for tokens, fp in _sets(texts, size):
                if len(tokens) and fp not in seen:
                    seen.add(fp)
                    sigs.append(signatures(tokens, num, den, order))
                    fps.append(fp)
                    ns.append(len(tokens))
                    held += len(sigs[-1])
                    if held >= FLUSH:
                        yield rows()
                        sigs, fps, ns, held = [], [], [], 0
        if sigs:
            yield rows()

    return emit


def _overlap(a: list[np.ndarray], b: list[np.ndarray], same: bool) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of their incidence matrices."""
    if same:
        tokens, n = np.unique(np.concatenate(a), return_counts=True)
        common = tokens[n > 1]
        out = np.diag([float(len(s)) for s in a]).astype(np.float32)
    else:
        common = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
        out = np.zeros((len(a), len(b)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = [np.searchsorted(common, s[np.isin(s, common, assume_unique=True)]) for s in sets]
        return np.repeat(np.arange(len(sets)), [len(x) for x in at]), np.concatenate(at)

    (ra, ca), (rb, cb) = places(a), places(b)
    step = 1 << 12
    for lo in range(0, len(common), step):
        width = min(step, len(common) - lo)
        m = []
        for n, r, c in ((len(a), ra, ca), (len(b), rb, cb)):
            x = np.zeros((n, width), np.float32)
            mine = (c >= lo) & (c < lo + width)
            x[r[mine], c[mine] - lo] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def _bounded(sets: list[np.ndarray], others: list[np.ndarray], num: int, den: int) -> list[int]:
    """Which sets overlap enough with the union of the other group's sets to be similar to any of them."""
    union = np.unique(np.concatenate(others))
    return [i for i, s in enumerate(sets) if int(np.isin(s, union, assume_unique=True).sum()) * den >= num * len(s)]


def links(left: dict[int, np.ndarray], right: dict[int, np.ndarray], num: int, den: int, ordered: bool = False) -> list[tuple[int, int]]:
    """A spanning forest of the links between two groups of sets, which may share sets; if `ordered`, those where the right set isn't smaller."""
    by_size = lambda sets: sorted(sets, key=lambda x: (len(sets[x]), x))
    li, ri = by_size(left), by_size(right)
    a, b = [left[x] for x in li], [right[x] for x in ri]
    keep = _bounded(a, b, num, den)
    if not keep:
        return []
    li, a = [li[i] for i in keep], [a[i] for i in keep]
    keep = _bounded(b, a, num, den)
    if not keep:
        return []
    ri, b = [ri[i] for i in keep], [b[i] for i in keep]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(0, len(a), BLOCK):
        for j in range(0, len(b), BLOCK):
            ids, others = li[i : i + BLOCK], ri[j : j + BLOCK]
            (least, most), (from_, to) = ((len(x[k]), len(x[k : k + BLOCK][-1])) for x, k in ((a, i), (b, j)))
            if most * den < num * from_ or to * den < num * least or (ordered and (to, others[-1]) < (least, ids[0])):
                continue  # sizes too far apart, or compared with the sides changed
            if len({root(x) for x in (*ids, *others)}) == 1:
                continue  # all connected by now
            both = _overlap(a[i : i + BLOCK], b[j : j + BLOCK], ids == others)
            union = np.array([len(x) for x in a[i : i + BLOCK]])[:, None] + np.array([len(x) for x in b[j : j + BLOCK]])[None, :] - both
            for p, q in zip(*np.nonzero(both * den >= num * union)):
                x, y = root(ids[p]), root(others[q])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((ids[p], others[q]))
    return out


def _verify(size: int, num: int, den: int):
    def verify(batch: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        once = batch.drop_duplicates("fp")
        known = {fp: tokens for (tokens, _), fp in zip(_sets(once["text"].tolist(), size), once["fp"])}
        for _, rows in batch.groupby("pair"):
            sides = {side: {fp: known[fp] for fp in sorted(set(r["fp"]))} for side, r in rows.groupby("side")}
            right = sides.get(1, sides.get(LARGER))
            if 0 in sides and right:
                out += links(sides[0], right, num, den, LARGER in sides)
        return pd.DataFrame(out, columns=["x", "y"], dtype="int64")

    return verify


def _open(members: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Links (x, y) between the members (pair, side, fp, n) of open pairs of groups; texts is (fp, text). Small pairs share a task."""
    shingles_ = members.agg(F.sum("n")).first()[0] or 0
    batch = F.pmod(F.xxhash64("pair"), F.lit(max(1, math.ceil(shingles_ / BATCH_SHINGLES)))).alias("batch")
    opened = members.select(batch, "pair", "side", "fp").join(texts, "fp")
    return opened.groupBy("batch").applyInPandas(_verify(size, num, den), "x long, y long")


def _cuts(group: int) -> Column:
    """Into how many parts rows (fp, n) of a group go, so that each is bounded."""
    return F.greatest(F.ceil(F.count("*") / group), F.ceil(F.sum("n") / GROUP_SHINGLES)).cast("int").alias("cuts")


def _part(cuts: Column) -> Column:
    return F.pmod(F.xxhash64("fp"), cuts).cast("int")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, comp): a representative of each of nodes (fp), the same for all that edges (x, y) connect.

    Contraction: a vertex smaller than all its neighbours is a root, and every vertex whose smallest neighbour is a
    root is absorbed by it; the edges then hold roots and what is left. Vertices are hashes, so a few rounds
    do. Every vertex is absorbed once; the rounds' small maps are resolved from the last to the first.
    """
    with Scratch(nodes.sparkSession) as scratch:
        edges = scratch.write(edges.select("x", "y").filter("x <> y").distinct())
        absorbed = []
        while not edges.isEmpty():
            both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
            least = scratch.write(both.groupBy("x").agg(F.min("y").alias("y")))
            roots = least.filter("x < y").select(F.col("x").alias("root"))
            into = scratch.write(least.filter("y < x").join(roots, F.col("y") == F.col("root")).select(F.col("x").alias("v"), "root"))
            absorbed.append(into)
            for end in ("x", "y"):
                edges = edges.join(into, F.col(end) == F.col("v"), "left").withColumn(end, F.coalesce("root", end)).drop("v", "root")
            edges = scratch.write(edges.filter("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
        final = None
        for into in reversed(absorbed):
            if final is not None:
                later = final.select(F.col("v").alias("at"), F.col("root").alias("last"))
                here = into.join(later, F.col("root") == F.col("at"), "left").select("v", F.coalesce("last", "root").alias("root"))
                into = scratch.write(here.unionByName(final))
            final = into
        if final is None:
            return written(nodes.select("fp", F.col("fp").alias("comp")))
        return written(nodes.join(final, nodes["fp"] == final["v"], "left").select("fp", F.coalesce("root", "fp").alias("comp")))


def _once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (rid, text), each rid once in a partition."""
    seen: set[int] = set()
    for b in batches:
        fresh = ~b["rid"].isin(seen) & ~b["rid"].duplicated()
        seen.update(b["rid"][fresh].tolist())
        yield b[fresh]


def _ends(tokens: DataFrame) -> DataFrame:
    """(token, first, last): the smallest set, by size and hash, with this short token, and the largest with this token, where they differ."""
    place = F.struct("n", "fp")
    ends = tokens.groupBy("token").agg(F.min(F.when(F.col("short"), place)).alias("first"), F.max(place).alias("last"))
    return ends.filter("first < last")


def _matrix(every: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(token, fp, n, short, first): the tokens that sets may share with a set of their size or larger, and the smallest set on each."""
    as_smaller = F.count_if(F.col("short") & (F.struct("n", "fp") < F.col("last"))) >= _shared(F.first("n"), num, den)
    as_larger = F.count_if(F.struct("n", "fp") > F.col("first")) >= _shared(F.ceil(F.first("n") * num / den), num, den)
    counts = scratch.write(every.groupBy("token").agg(F.count("*").alias("sets"), F.max("short").alias("met")).filter("sets > 1 and met"))
    total = counts.agg(F.sum("sets")).first()[0] or 0
    hot = [r["token"] for r in counts.filter(F.col("sets") * HOT_SHARE > total).collect()]
    some, _ = split_by(every, "token", bitmap(counts, "token"))
    tokens = scratch.write(hot_join(some, counts.select("token"), "token", "fp", hot).distinct())
    scratch.drop(every, counts)
    for _ in range(2):  # sets without enough tokens leave, then tokens that one set is left on
        placed = scratch.write(hot_join(tokens, _ends(tokens), "token", "fp", hot))
        stay = placed.groupBy("fp").agg((as_smaller | as_larger).alias("stays")).filter("stays").select("fp")
        scratch.drop(tokens)
        tokens = scratch.write(placed.join(stay, "fp").select("token", "fp", "n", "short"))
        scratch.drop(placed)
    return scratch.write(hot_join(tokens, _ends(tokens).select("token", "first"), "token", "fp", hot))


def _first_members(matrix: DataFrame, num: int, den: int, group: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(fp, label, part, n) of all sets in the matrix, and the members (pair, side, fp, n) of each group with itself and of a label's groups with its pioneers."""
    enough = F.col("held") >= _shared(F.ceil(F.col("n") * num / den), num, den)
    centre = F.when(F.struct("n", "fp") >= F.col("first"), F.col("first")).alias("centre")
    near = matrix.groupBy("fp", centre).agg(F.count("*").alias("held"), F.first("n").alias("n"))
    near = near.withColumn("near", enough & (F.col("centre.n") * den >= F.col("n") * num))
    label = near.groupBy("fp").agg(F.min(F.when(F.col("near"), F.col("centre"))).alias("label"), F.first("n").alias("n"))
    label = scratch.write(label.select("fp", F.coalesce("label.fp", "fp").alias("label"), "n"))
    sizes = label.groupBy("label").agg(F.count("*").alias("sets"), _cuts(group))
    every = scratch.write(hot_join(label, sizes, "label", "fp", hot_keys(label, "label")).withColumn("part", _part(F.col("cuts"))))
    grouped = every.filter("sets > 1")
    place, w = F.struct("n", "fp"), W.partitionBy("label", "part", "token")  # a group's size at most
    tokens = matrix.select("token", "fp", "n", "short").join(grouped.select("fp", "label", "part"), "fp")
    tokens = tokens.withColumns({"first": F.min(F.when(F.col("short"), place)).over(w), "last": F.max(place).over(w)}).filter("first < last")
    low, high = F.count_if(F.col("short") & (place < F.col("last"))), F.count_if(place > F.col("first"))
    own = tokens.groupBy("label", "part", "fp").agg(F.first("n").alias("n"), low.alias("low"), high.alias("high"))
    smaller = F.when(F.col("low") >= _shared(F.col("n"), num, den), 0)
    larger = F.when(F.col("high") >= _shared(F.ceil(F.col("n") * num / den), num, den), LARGER)
    own = own.select(F.xxhash64("label", "part").alias("pair"), F.explode(F.array_compact(F.array(smaller, larger))).alias("side"), "fp", "n")
    several = grouped.filter("cuts > 1")
    pair = lambda part: F.xxhash64("label", F.lit(0), part).alias("pair")
    others = several.select(pair("part"), F.lit(1).alias("side"), "fp", "n")
    pioneers = several.filter(F.pmod(F.xxhash64("fp", F.lit(1)), F.greatest(F.ceil(F.col("sets") / PIONEERS), F.col("cuts"))) == 0)
    pioneers = pioneers.withColumn("other", F.explode(F.expr("sequence(0, cuts - 1)"))).select(pair("other"), F.lit(0).alias("side"), "fp", "n")
    return every.select("fp", "label", "part", "n"), own.unionByName(pioneers).unionByName(others)


def _units(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(fp, comp, unit, done): the groups of the second step, and the units that a set has been compared with or is connected to.

    Sets of a group in the component of its label are a unit over all groups with that component, the others of
    the group another one. Within a group all sets have been compared.
    """
    rest = F.xxhash64(F.lit(1), "label", "part")
    core = lambda comp: F.xxhash64(F.lit(0), comp)
    main = labels.select(F.col("fp").alias("label"), F.col("comp").alias("main"))
    placed = hot_join(sets.join(labels, "fp"), main, "label", "fp", hot_keys(sets, "label"))
    inside = placed.filter("comp = main").groupBy("main").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.min("label").alias("c"), F.max("label").alias("d"))
    single = inside.filter("a = b and c = d").select(F.col("c").alias("label"), F.col("a").alias("part"), F.lit(True).alias("whole"))
    placed = placed.join(single, ["label", "part"], "left")  # groups that hold their label's component whole
    unit = F.when(F.col("comp") == F.col("main"), core("main")).otherwise(rest)
    return placed.select("fp", "comp", unit.alias("unit"), F.array(unit, rest, core("comp"), F.when(F.col("whole"), core("main"))).alias("done"))


def _next_members(matrix: DataFrame, sets: DataFrame, labels: DataFrame, num: int, den: int, group: int, scratch: Scratch) -> DataFrame:
    """The members (pair, side, fp, n) of pairs of units, side 0 for smaller sets: documents that qualify by their overlap with the other's union."""
    placed = matrix.select("token", "fp", "n", "short").join(scratch.write(_units(sets, labels)), "fp")
    open_ = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("token")
    placed = scratch.write(placed.join(open_, "token"))
    least = F.min(F.when(F.col("short"), F.col("n"))).alias("least")
    unions = placed.groupBy("token", F.col("unit").alias("other")).agg(least, F.max("n").alias("most"))
    as_smaller = F.col("short") & (F.col("most") >= F.col("n"))
    as_larger = F.coalesce(F.col("least") <= F.col("n"), F.lit(False))
    met = hot_join(placed, unions, "token", "fp", hot_keys(placed, "token"))
    met = met.filter((as_smaller | as_larger) & ~F.coalesce(F.array_contains("done", F.col("other")), F.lit(False)))
    met = met.groupBy("fp", "unit", "other").agg(F.count_if(as_smaller).alias("low"), F.count_if(as_larger).alias("high"), F.first("n").alias("n"))
    smaller = F.when(F.col("low") >= _shared(F.col("n"), num, den), F.struct(F.lit(0).alias("side"), F.col("unit").alias("lo"), F.col("other").alias("hi")))
    larger = F.when(F.col("high") >= _shared(F.ceil(F.col("n") * num / den), num, den), F.struct(F.lit(LARGER).alias("side"), F.col("other").alias("lo"), F.col("unit").alias("hi")))
    met = scratch.write(met.select("fp", "n", F.inline(F.array_compact(F.array(smaller, larger)))))
    sides = met.groupBy("lo", "hi", "side").agg(_cuts(group)).groupBy("lo", "hi").agg(
        F.max(F.when(F.col("side") == 0, F.col("cuts"))).alias("cuts0"), F.max(F.when(F.col("side") == LARGER, F.col("cuts"))).alias("cuts1")
    ).filter("cuts0 is not null and cuts1 is not null")
    met = met.join(sides, ["lo", "hi"]).withColumn("own", _part(F.when(F.col("side") == 0, F.col("cuts0")).otherwise(F.col("cuts1"))))
    met = met.withColumn("other", F.explode(F.expr("sequence(0, if(side = 0, cuts1, cuts0) - 1)")))
    places = [F.when(F.col("side") == s, F.col("own")).otherwise(F.col("other")) for s in (0, LARGER)]
    return scratch.write(met.select(F.xxhash64("lo", "hi", *places).alias("pair"), "side", "fp", "n"))


def linked_sets(docs: DataFrame, size: int, num: int, den: int, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(described, labels): docs (doc_id, rid, text) as (doc_id, rid, n, fp), and (fp, comp) of the sets that share enough tokens."""
    facts = written(docs.mapInArrow(_describe(size), _FACTS))
    described = facts.filter("slice is null").select("doc_id", "rid", "n", "fp")
    with Scratch(docs.sparkSession) as scratch:
        every = scratch.write(docs.select("text").mapInArrow(_tokens(size, num, den, shingle_order(facts)), "token long, fp long, n int, short boolean"))
        matrix = _matrix(every, num, den, scratch)
        sets, members = _first_members(matrix, num, den, group, scratch)

        first = described.filter("n > 0").groupBy("fp").agg(F.min("rid").alias("rid")).join(sets, "fp")
        first = scratch.write(first.select("rid", "fp"))
        some, _ = split_by(docs.select("rid", "text"), "rid", bitmap(first, "rid"))
        # Rows that repeat id and text meet as one row a partition.
        texts = scratch.write(some.mapInPandas(_once, "rid long, text string").join(first, "rid").select("fp", "text").dropDuplicates(["fp"]))

        edges = scratch.write(_open(members, texts, size, num, den))
        labels = components(sets.select("fp"), edges)
        more = scratch.write(_open(_next_members(matrix, sets, labels, num, den, group, scratch), texts, size, num, den))
        if not more.isEmpty():
            labels = components(sets.select("fp"), edges.unionByName(more))
        return described, labels


def _placed(docs: DataFrame, text: Column, id: Column, size: int, threshold: tuple[int, int], group: int) -> tuple[DataFrame, DataFrame]:
    """Rows with shingles, (doc_id, rid, n, component_id, winner) with the rid that their component keeps, and rows without any, (doc_id, rid, n)."""
    num, den = threshold
    rows = docs.select(id.cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), F.xxhash64(id, text).alias("rid"))
    described, labels = linked_sets(rows, size, num, den, group)
    some = described.filter("n > 0")
    some = hot_join(some, labels, "fp", "rid", hot_keys(some, "fp"), "left").withColumn("comp", F.coalesce("comp", "fp"))
    some = written(some.select("doc_id", "rid", "n", "comp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid"))["rid"]
    smallest = some.groupBy("comp").agg(F.min("doc_id").alias("component_id"), first.alias("winner"))
    return hot_join(some, smallest, "comp", "rid", hot_keys(some, "comp")), described.filter("n = 0").select("doc_id", "rid", "n")


def near_duplicates(
    docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = 5, threshold: tuple[int, int] = (80, 100), group: int = GROUP
) -> DataFrame:
    """(doc_id, rid, n_shingles, component_id) of each row of docs; rid is a hash of id and text.

    Sets of distinct shingles of `size` words, lower-cased in ASCII; a shorter text is one shingle. Two documents
    link when intersection * den >= num * union. Null texts and texts without words have no shingles and
    link with nothing, so component_id is their own id. component_id is the smallest id in the
    component; null ids count only where there is no other. Repeated rows are in one component. An empty
    table gives an empty one. Ids must cast to long. Sets are told apart by 64-bit hashes.
    """
    some, alone = _placed(docs, F.col(text), F.col(id), size, threshold, group)
    alone = alone.select("doc_id", "rid", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.select("doc_id", "rid", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = 5, threshold: tuple[int, int] = (80, 100), group: int = GROUP, repeats: bool = True
) -> DataFrame:
    """docs with one document of each component, columns as they were.

    The one with the smallest id stays, null ids last, then the one with the smallest hash of id and text.
    Rows that repeat both its id and its text are the same document: they stay with it, or one of them does
    if `repeats` is False. Null texts and texts without words stay. An empty table gives an empty one, very long
    texts count whole, and columns named like internal ones keep their values.
    """
    inner = docs.select(packed(docs), F.col(text).alias("t"), F.col(id).alias("i"), F.xxhash64(F.col(id), F.col(text)).alias("rid"))
    some, _ = _placed(inner, F.col("t"), F.col("i"), size, threshold, group)
    places = some.select("rid", "winner")
    one = F.lit(True).alias("one")
    acts = places.filter("rid <> winner").select("rid", F.lit(False).alias("one")).distinct()
    if not repeats:
        acts = acts.unionByName(places.filter("rid = winner").groupBy("rid").agg(F.count("*").alias("n")).filter("n > 1").select("rid", one))
    acts = written(acts)
    rows, rest = split_by(inner, "rid", bitmap(acts, "rid"))
    kept = rows.join(acts, "rid", "left_anti").select(ROW).unionByName(rest.select(ROW))
    repeated = acts.filter("one")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(repeated, "rid", "left_semi").groupBy("rid").agg(F.first(ROW).alias(ROW)).select(ROW))
    return kept.select(f"{ROW}.*")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[s:s + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS s FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM both_ JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT doc_id, y FROM reach JOIN links ON other = x)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other)::BIGINT AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
