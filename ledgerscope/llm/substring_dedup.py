"""Removal of repeated passages: every word in a window of `window` words that starts somewhere else too.

Finding candidates. Each window has an anchor, its phrase of `phrase` words with the smallest hash (the first of
several). Equal windows have equal anchors at equal places, so only windows whose anchor recurs matter. The
windows of one anchor form a run; its words from the first window's start to the last one's end are a
context, the part of a document that has to be looked at for this anchor.

Confirming. Contexts are dealt to shards by their anchors, each distinct one with its words and its number of
occurrences, so that all occurrences of a window meet in one shard. There they are compared as words: a
context that occurs several times is a recurring passage, and so is a window that several contexts hold.

Locating. The recurring passages of a shard are compiled into one Aho-Corasick automaton over word numbers, and all
contexts of the shard stream through it. What it matches are the ranges that documents with that context lose.
A text without a match keeps all its words; nothing is removed by any other way.

Shards are bounded: an anchor with more contexts than fit is dealt to several tasks. These count their windows by
hash together first, and a task's automaton has the words of one occurrence of each window that recurs.

Anchors, contexts and ranges are small rows; texts are read only for documents that a bitmap of fixed size lets through.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, ROW, WORD, Scratch, bitmap, hot_join, hot_keys, packed, split_by, unpacked, written
from .wordhash import range_hashes, shingles, word_hashes

WINDOW, PHRASE = 35, 8
GROUP = 2000  # contexts in a task's automaton

_word = re.compile(WORD)


def _anchors(words: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of each run of windows with one anchor."""
    hashes = shingles(words, phrase)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window - phrase + 1)
    place = views.argmin(1) + np.arange(len(views))
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    return hashes[place[first]], first, last


def _occurrences(window: int, phrase: int):
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for rid, words in zip(batch["rid"].to_numpy(), word_hashes(batch["text"].tolist())):
                if len(words) >= window:
                    a, first, last = _anchors(words, window, phrase)
                    out.append((a.view(np.int64), range_hashes(words, first, last + window).view(np.int64), np.full(len(a), rid), first, last))
            if out:
                a, ctx, rid, first, last = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({"a": a, "ctx": ctx, "rid": rid, "first": first.astype(np.int32), "last": last.astype(np.int32)})

    return emit


_TEXTS = "a long, ctx long, n long, parts int, words string, windows array<long>"


def _contexts(window: int):
    """The words of each wanted context, and hashes of its windows where its anchor is dealt to several tasks."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, wanted in zip(batch["text"], batch["wanted"]):
                words, hashes = _word.findall(text), None
                for w in wanted:
                    first, last, windows = w["first"], w["last"], None
                    if w["parts"] > 1:
                        hashes = next(word_hashes([text])) if hashes is None else hashes
                        start = np.arange(first, last + 1)
                        windows = range_hashes(hashes, start, start + window).view(np.int64)
                    out.append((w["a"], w["ctx"], w["n"], w["parts"], " ".join(words[first : last + window]), windows))
            yield pd.DataFrame(out, columns=["a", "ctx", "n", "parts", "words", "windows"])

    return emit


class _Passages:
    """An automaton over numbered words."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)

    def number(self, words: str) -> tuple[int, ...]:
        return tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words.split(" "))

    def covered(self, streams: list[tuple[int, tuple[int, ...]]]) -> pd.DataFrame:
        """(ctx, start, stop): the ranges of words of each stream that matches cover."""
        out: list[tuple[int, int, int]] = []
        if len(self.automaton):
            self.automaton.make_automaton()
        for ctx, ids in streams if len(self.automaton) else ():
            found = sorted((at + 1 - length, at + 1) for at, length in self.automaton.iter(ids))
            begin = end = -1
            for s, e in found:
                if s > end:
                    out += [(ctx, begin, end)] if end > 0 else []
                    begin = s
                end = max(end, e)
            out += [(ctx, begin, end)] if end > 0 else []
        return pd.DataFrame(out, columns=["ctx", "start", "stop"], dtype="int64")


def _locate(window: int):
    def locate(contexts: pd.DataFrame) -> pd.DataFrame:
        passages, held = _Passages(), Counter()
        alone = ~contexts["a"].duplicated(keep=False)  # an anchor's only context shares no window with others
        streams = [(ctx, passages.number(words)) for ctx, words in zip(contexts["ctx"], contexts["words"])]
        for (_, ids), n, one in zip(streams, contexts["n"], alone):
            if n > 1:
                passages.automaton.add_word(ids)
            if not one:
                held.update(ids[j : j + window] for j in range(len(ids) - window + 1))
        for ids, n in held.items():
            if n > 1:
                passages.automaton.add_word(ids)
        return passages.covered(streams)

    return locate


def _locate_part(contexts: pd.DataFrame, recurring: pd.DataFrame) -> pd.DataFrame:
    """As _locate, with the words of the windows that recur."""
    passages = _Passages()
    for words in recurring["words"]:
        passages.automaton.add_word(passages.number(words))
    return passages.covered([(ctx, passages.number(words)) for ctx, words in zip(contexts["ctx"], contexts["words"])])


def _located_in_parts(texts: DataFrame, window: int) -> DataFrame:
    """(ctx, start, stop) for contexts of anchors that are dealt to several tasks; texts is written."""
    part = F.pmod("ctx", F.col("parts")).cast("int").alias("part")
    windows = texts.select("a", part, "ctx", "n", F.posexplode("windows").alias("j", "w"))
    counted = windows.groupBy("a", "w").agg(F.sum("n").alias("n"), F.min(F.struct("ctx", "j")).alias("at")).filter("n > 1")
    words = F.array_join(F.slice(F.split("words", " "), F.col("at.j") + 1, F.lit(window)), " ").alias("words")
    shown = counted.join(texts.select("ctx", "words"), F.col("at.ctx") == F.col("ctx")).select("w", words)
    needed = windows.select(F.col("a").alias("anchor"), F.col("part").alias("task"), "w").distinct().join(shown, "w")
    return texts.select("a", part, "ctx", "words").groupBy("a", "part").cogroup(needed.groupBy("anchor", "task")).applyInPandas(
        _locate_part, "ctx long, start long, stop long"
    )


def repeated_ranges(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, group: int = GROUP) -> DataFrame:
    """(rid, ranges) of docs (rid, text) with words in repeated windows; ranges is an array of (start, stop)."""
    with Scratch(docs.sparkSession) as scratch:
        seen = scratch.write(docs.mapInPandas(_occurrences(window, phrase), "a long, ctx long, rid long, first int, last int"))
        anchors = scratch.write(seen.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1"))
        total = anchors.agg(F.sum("n")).first()[0] or 0
        hot = [r["a"] for r in anchors.filter(F.col("n") * HOT_SHARE > total).collect()]
        recurring = scratch.write(hot_join(seen, anchors.select("a"), "a", "ctx", hot))
        scratch.drop(seen, anchors)

        contexts = scratch.write(recurring.groupBy("a", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("rid", "first", "last")).alias("at")))
        many = contexts.groupBy("a").agg(F.ceil(F.count("*") / group).cast("int").alias("parts")).filter("parts > 1")
        dealt = hot_join(contexts, many, "a", "ctx", hot_keys(contexts, "a"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        wanted = dealt.select("a", "ctx", "n", "parts", "at.*").groupBy("rid").agg(F.collect_list(F.struct("a", "ctx", "n", "parts", "first", "last")).alias("wanted"))
        some, _ = split_by(docs, "rid", bitmap(contexts.select("at.rid"), "rid"))
        texts = scratch.write(some.join(wanted, "rid").dropDuplicates(["rid"]).mapInPandas(_contexts(window), _TEXTS))

        shards = max(1, math.ceil(contexts.count() / group))
        located = texts.filter("parts = 1").select("a", "ctx", "n", "words").groupBy(F.pmod(F.xxhash64("a"), F.lit(shards))).applyInPandas(
            _locate(window), "ctx long, start long, stop long"
        )
        in_parts = texts.filter("parts > 1")
        if not in_parts.isEmpty():
            located = located.unionByName(_located_in_parts(in_parts, window))
        located = scratch.write(located)
        often = contexts.agg(F.sum("n")).first()[0] or 0
        hot = [r["ctx"] for r in contexts.filter(F.col("n") * HOT_SHARE > often).select("ctx").collect()]
        ranges = hot_join(recurring.select("ctx", "rid", "first"), located, "ctx", "rid", hot)
        place = F.struct((F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("stop")).alias("stop"))
        return written(ranges.groupBy("rid").agg(F.collect_set(place).alias("ranges")))


def _cutter(digest: bool):
    @F.pandas_udf("n long, removed long, kept string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        out = []
        for text, cuts in zip(texts, ranges):
            words = _word.findall(text)
            kept, at = [], 0
            for s, e in sorted((c["start"], c["stop"]) for c in cuts) if cuts is not None else ():
                kept += words[at:s] if s > at else []
                at = max(at, e)
            kept += words[at:]
            left = " ".join(kept)
            left = hashlib.sha256(left.encode("utf-8", "surrogatepass")).hexdigest() if digest else left
            out.append((len(words), len(words) - len(kept), left))
        return pd.DataFrame(out, columns=["n", "removed", "kept"])

    return cut


def remove_repeats(
    docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW, phrase: int = PHRASE, digest: bool = False
) -> DataFrame:
    """docs with n_words, n_removed and kept_text (kept words joined by one space), or kept_sha256 if `digest`.

    Windows are judged on the input. A null text has no words. Documents shorter than a window keep all.
    Repeated rows repeat each other's windows. An empty table gives an empty one. Very long texts are treated
    whole. A null id is an id like any other. Input columns named like a result column give way, others keep their
    values. Rows are told apart by a 64-bit hash of id and text, and contexts by one of their words; rows
    equal in id and text have the same windows and lose the same words.
    """
    rows = docs.select(packed(docs), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.col(id), F.col(text)).alias("rid"))
    ranges = repeated_ranges(rows.select("rid", "text"), window, phrase)
    some, rest = split_by(rows, "rid", bitmap(ranges, "rid"))
    rest = rest.withColumn("ranges", F.lit(None).cast(ranges.schema["ranges"].dataType))
    both = some.join(ranges, "rid", "left").unionByName(rest)
    cut = _cutter(digest)(F.col("text"), F.col("ranges"))
    both = both.select(ROW, cut.alias("c"))
    return unpacked(both, docs.columns, {
        "n_words": F.col("c.n"), "n_removed": F.col("c.removed"), "kept_sha256" if digest else "kept_text": F.col("c.kept"),
    })


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS s FROM d WHERE len(ws) >= 35)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT s + o) AS gone FROM win JOIN rep USING (k), range(0, 35) t(o) GROUP BY doc_id),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT doc_id, unnest(gone) AS i, true AS cut FROM gone),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM w LEFT JOIN g USING (doc_id, i) WHERE cut IS NULL GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
