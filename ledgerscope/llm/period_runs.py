"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of consecutive words with smallest period q and at least `LEAST` words and `POWER` periods that
no neighbouring word extends. Each task takes texts a slice at a time (`SLICE_WORDS`, a longer text alone) and

1. numbers the words and builds a Re-Pair grammar of the whole slice in rounds: a round replaces, at every place,
   the pair that occurs more often than the pairs it overlaps; when no pair repeats, neighbours are joined until each
   text is one symbol. Pairs never cross texts, and equal passages of different texts share their nonterminals;
2. finds the runs across the boundary of each new nonterminal's two parts, once, in one of its expansions;
3. translates them to every place that the nonterminal derives, and merges what one run has left to the maximal
   intervals: a run lies whole in the lowest node of the derivation that covers it and crosses that node's boundary.

Nothing shuffles. Memory follows the slice, some 150 bytes a word, or the longest text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain as chained

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CRC_STEPS, WORD, crc32_sql

LEAST, POWER = 6, 4
#: Words that one grammar covers, and rows that are turned into Python strings at once.
SLICE_WORDS = 1 << 18
SLICE_ROWS = 512
_STEPS = 8

_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def _extents(words: np.ndarray, first: int, last: int, at: int, q: int) -> tuple[int, int]:
    """The run of period q in words[first:last] whose pair (at, at + q) is equal, as start and end."""
    equal = words[first : last - q] == words[first + q : last]
    at -= first
    left = np.flatnonzero(~equal[:at])
    right = np.flatnonzero(~equal[at:])
    return first + (int(left[-1]) + 1 if len(left) else 0), first + q + (at + int(right[0]) if len(right) else len(equal))


def _boundary_runs(words: np.ndarray, first: np.ndarray, middle: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs across `middle` in each words[first:last]: the index of the expansion, and rows (start, length, period).

    A run across the boundary with four periods has one of them and a word on one side, so the pairs q apart
    just before and after the boundary are equal there.
    """
    most = (last - first) // POWER
    which = np.repeat(np.arange(len(first)), most)
    q = np.arange(1, len(which) + 1) - np.repeat(np.cumsum(most) - most, most)
    f, m, e = first[which], middle[which], last[which]
    top = len(words) - 1
    fits, meets = m - 1 - q >= f, m + q < e
    before = fits & (words[np.maximum(m - 1 - q, 0)] == words[m - 1]) & (words[np.maximum(m - q, 0)] == words[m])
    after = meets & (words[np.minimum(m - 1 + q, top)] == words[m - 1]) & (words[np.minimum(m + q, top)] == words[m])
    x, y = np.flatnonzero(before), np.flatnonzero(after)
    kept, at = np.concatenate((x, y)), np.concatenate(((m - 1 - q)[x], (m - 1)[y]))  # words at `at` and at + 1 equal those q further on
    order = np.argsort(kept, kind="stable")
    kept, at = kept[order], at[order]
    which, q, f, e = (x[kept] for x in (which, q, f, e))

    # Most candidates end within a few words; the others are measured whole, the smallest period first.
    low, high = at.copy(), at + 2
    going_low, going_high = np.ones(len(at), bool), np.ones(len(at), bool)
    for _ in range(_STEPS):
        going_low &= (low > f) & (words[np.maximum(low - 1, 0)] == words[np.maximum(low - 1 + q, 0)])
        low -= going_low
        going_high &= (high + q < e) & (words[np.minimum(high, top)] == words[np.minimum(high + q, top)])
        high += going_high
    least = np.maximum(LEAST, POWER * q)
    wanted = np.flatnonzero(going_low | going_high | (high + q - low >= least))
    found, owner = [], []
    runs: list[tuple[int, int, int]] = []
    whose = -1
    for i in wanted.tolist():
        x, period = int(which[i]), int(q[i])
        if x != whose:
            whose, runs = x, []
        if any(period % p == 0 and s <= at[i] and at[i] + 1 + period < s + n for s, n, p in runs):
            continue  # a multiple of a smaller period covers the same words
        if going_low[i] or going_high[i]:
            s, t = _extents(words, int(f[i]), int(e[i]), int(at[i]), period)
        else:
            s, t = int(low[i]), int(high[i]) + period
        if t - s >= max(LEAST, POWER * period):
            runs.append((s, t - s, period))
            found.append((s, t - s, period))
            owner.append(x)
    return np.array(owner, np.int64), np.array(found, np.int64).reshape(-1, 3)


def _chosen(code: np.ndarray, live: np.ndarray, chain: np.ndarray, before: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the live places (ascending, with the codes of their pairs) those with a pair that repeats; which of these a round replaces; their codes.

    chain and before name the next and the previous place; rank, over all places, is lent and given back as it was.
    """
    _, pair, count = np.unique(code, return_inverse=True, return_counts=True)
    several = count[pair] > 1
    live, code, pair = live[several], code[several], pair[several]
    # Frequent pairs first; equally frequent ones in an order that has nothing to do with their places in a text.
    mixed = (np.unique(code).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    of_pair = np.unique(pair, return_inverse=True)[1]
    order = np.lexsort((mixed, -count[count > 1]))
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    worst = rank[-1]
    rank[live] = here = place_of[of_pair]
    # Equal neighbours are one pair that overlaps itself: every second place of such a stretch.
    opens = np.ones(len(live), bool)
    opens[1:] = (chain[live[:-1]] != live[1:]) | (here[1:] != here[:-1])
    nth = np.arange(len(live))
    offset = nth - np.maximum.accumulate(np.where(opens, nth, 0))
    taken = (here <= rank[before[live]]) & (here <= rank[chain[live]]) & (offset % 2 == 0)
    rank[live] = worst
    return live, taken, code


def grammar_runs(words: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Maximal runs (start, length, period) of texts of `sizes` words laid end to end, by start, then period."""
    n = len(words)
    symbols, size = np.append(words, -1).astype(np.int64), np.ones(n + 1, np.int64)
    # The symbols as a list linked both ways over the places of their first words; place n is a border.
    chain, before, alive = np.arange(1, n + 2), np.arange(-1, n), np.append(np.ones(n, bool), False)
    ends = np.cumsum(sizes)
    before[ends] = before[0] = n
    chain[ends - 1] = chain[n] = n
    out: list[np.ndarray] = []

    def join(at: np.ndarray, once: np.ndarray, number: np.ndarray, fresh: int) -> None:
        """Puts nonterminal fresh + number at each place for itself and its neighbour; once: a place in `at` of each."""
        other = chain[at]
        first, left = at[once], size[at[once]]
        whole = left + size[other[once]]
        long = np.flatnonzero(whole >= LEAST)
        if len(long):
            owner, runs = _boundary_runs(words, first[long], first[long] + left[long], first[long] + whole[long])
            if len(owner):
                out.append(_translated(runs, long[owner], first, at, number))
        symbols[at] = fresh + number
        size[at] += size[other]
        alive[other] = False
        chain[at] = chain[other]
        before[chain[at]] = at
        before[n] = n

    rank = np.full(n + 1, n + 1, np.int64)
    live, fresh = np.flatnonzero(chain[:n] < n), int(symbols.max(initial=0)) + 1
    while len(live):
        # A pair that occurs once never repeats later, so each round looks only at pairs that did or that are new.
        code = symbols[live] * fresh + symbols[chain[live]]
        live, taken, code = _chosen(code, live, chain, before, rank)
        at = live[taken]
        _, once, number = np.unique(code[taken], return_index=True, return_inverse=True)
        join(at, once, number, fresh)
        fresh += len(once)
        live = np.unique(np.concatenate((live[~taken], at, before[at])))
        live = live[live < n]
        live = live[alive[live] & (chain[live] < n)]
    while True:  # no pair repeats: every second symbol of each text takes its neighbour in
        heads = np.flatnonzero(alive)
        first = before[heads] == n
        nth = np.arange(len(heads))
        nth -= np.maximum.accumulate(np.where(first, nth, 0))
        at = heads[(nth % 2 == 0) & (chain[heads] < n)]
        if not len(at):
            break
        join(at, np.arange(len(at)), np.arange(len(at)), fresh)
    return _merged(np.concatenate(out)) if out else np.empty((0, 3), np.int64)


def _translated(runs: np.ndarray, owner: np.ndarray, first: np.ndarray, places: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Runs of nonterminals, whose expansions were read at `first`, at all places that derive them."""
    order = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[order], np.arange(len(first) + 1))
    times = bounds[owner + 1] - bounds[owner]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    all_runs = np.repeat(runs, times, axis=0)
    all_runs[:, 0] += places[order[np.repeat(bounds[owner], times) + nth]] - np.repeat(first[owner], times)
    return all_runs


def _merged(runs: np.ndarray) -> np.ndarray:
    """Maximal intervals of each period: two of them share fewer words than a period, a partial one lies in its whole."""
    runs = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))]
    # Periods one after the other on one axis, so that a running maximum never reaches into the next.
    step = np.cumsum(np.concatenate(([0], np.diff(runs[:, 2]) > 0))) * (int((runs[:, 0] + runs[:, 1]).max()) + 1)
    ends = np.maximum.accumulate(runs[:, 0] + runs[:, 1] + step)
    runs = runs[np.concatenate(([True], (runs[:, 0] + runs[:, 1] + step)[1:] > ends[:-1]))]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _of_slice(texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int, int]] | None, str]]:
    """Runs and collapsed text of each list of words."""
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    sizes = [len(t) for t in texts]
    words = np.fromiter(map(ids.__getitem__, chained.from_iterable(texts)), np.int64, sum(sizes))
    runs = grammar_runs(words, sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    bounds = np.searchsorted(runs[:, 0], starts)
    out = []
    for n, mine in enumerate(texts):
        own = runs[bounds[n] : bounds[n + 1]]
        if len(own):
            own = own - np.array([starts[n], 0, 0])
            edges = np.zeros(len(mine) + 1, np.int64)
            np.add.at(edges, own[:, 0] + own[:, 2], 1)
            np.add.at(edges, own[:, 0] + own[:, 1], -1)
            mine = [mine[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
        out.append(([tuple(r) for r in own.tolist()], b" ".join(mine).decode()))
    return out


def _runs_of(texts: list[str | None]) -> list[tuple]:
    out, waiting, total = [], [], 0
    for t in texts:
        words = t.encode().split() if t else []  # bytes split at the space and U+0009 to U+000D
        if waiting and total + len(words) > SLICE_WORDS:
            out += _of_slice(waiting)
            waiting, total = [], 0
        waiting.append(words)
        total += len(words)
    return out + _of_slice(waiting)


def find_runs(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """docs with runs, (start, length, period) by start, then period, and collapsed, the text without repetition.

    collapsed drops a word if any run contains it after that run's first period; kept words are joined by one
    space. A null or empty text has no runs and collapses to ''. A text of any length is treated whole, by one task.
    Repeated rows and repeated ids are treated each by itself. An empty table gives an empty one. Input columns named
    runs or collapsed give way. `carry` names the input columns that the result needs, all by default.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("runs", "collapsed")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = _runs_of(part.column(len(kept)).to_pylist())
                runs = [[dict(zip(("start", "length", "period"), x)) for x in r] for r, _ in found]
                columns = [*part.columns[:-1], pa.array(runs, _RUNS), pa.array([c for _, c in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "runs", "collapsed"])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__ls_text"))
    runs = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("runs", runs), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(work, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """text, in which a tenth of the documents, chosen by CRC-32 of their id, repeat a stretch of words to their end."""
    h = F.crc32(doc_id.cast("string"))
    body = F.coalesce(text, F.lit(""))

    def repeated(words: Column, h: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # A one-element array binds the words to a name: they are split once, not for each word.
    words = F.transform(F.array(F.regexp_extract_all(body, F.lit(WORD), F.lit(0))), lambda w: F.when(F.size(w) > 0, repeated(w, h)))
    return F.when(h % 10 == 0, F.coalesce(F.get(words, F.lit(0)), body)).otherwise(body)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest one (ties: smallest start, then period), and SHA-256 of runs and collapsed text."""
    # max of (length, -start, -period) is that run.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"), (-F.col("best.q")).alias("period"),
        F.expr("1000 * best.n div -best.q").alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# Runs by definition: pairs of equal words q apart, their unbroken stretches, and of stretches with one extent the smallest period.
ORACLE = rf"""
WITH {CRC_STEPS},
hashed AS (SELECT doc_id, text, row_number() OVER () AS k, {crc32_sql("doc_id::VARCHAR")} AS h FROM documents, steps),
split AS (SELECT doc_id, k, h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM hashed),
facts AS (SELECT *, len(w) AS n, h // 10 AS g FROM split),
cut AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM facts),
words AS (SELECT doc_id, k, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM cut WHERE n > 0)),
pairs AS (SELECT x.k, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.k = y.k AND x.word = y.word AND y.i > x.i),
stretches AS (SELECT k, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pairs) GROUP BY k, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT k, start, length, min(q) AS period FROM stretches GROUP BY k, start, length),
best AS (SELECT k, count(*) AS n_runs, arg_min(struct_pack(start := start, length := length, period := period), struct_pack(l := -length, s := start, p := period)) AS b,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY k),
kept AS (SELECT w.k, string_agg(word, ' ' ORDER BY i) AS kept FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.k = w.k AND w.i >= r.start + r.period AND w.i < r.start + r.length) GROUP BY w.k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start AS start, b.length AS length, b.period AS period,
  1000 * b.length // b.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM facts LEFT JOIN best USING (k) LEFT JOIN kept USING (k)
"""
