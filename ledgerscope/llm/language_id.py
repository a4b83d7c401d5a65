"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is the product of its letters' vectors, each
rotated by its place; a document is the sum of its trigrams, and a language is the sum of its documents'
unit vectors. A document gets the language with the highest cosine.

Learning reads the whole text of every labelled row that isn't held out, calibration every held-out one. Both add up in
the tasks: what reaches the driver is one vector per language and one histogram. Prediction is a map over whole texts
without a shuffle.

A cosine has noise of about 1 / sqrt(dimensions), and short texts reach less of it than long ones. So a text
is in a language if its score reaches a limit by its number of distinct trigrams; limits are calibrated on
held-out labelled rows and on their first words, which stand for short texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, packed, unpacked

DIMENSIONS = 512
SEED = 20
UNKNOWN = "und"

#: A limit is so much of that quantile of the true language's cosine, over LEAST values or more.
QUANTILE, PART, LEAST = 0.01, 0.5, 20
#: Texts are classed by distinct trigrams: 1, 2-3, 4-7, ..., 128 or more. Bins of a cosine, 0 to 1.
CLASSES, BINS = 8, 200
_PREFIXES = (1, 2, 4, 8, 16, 32, 64)

_CHUNK_CHARS, _CHUNK_DOCS, _SLICE, _ROWS = 1 << 19, 256, 4096, 1024
_letters: dict[int, np.ndarray] = {}
_bmp: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _bmp:
        _bmp.append(np.array([chr(c).isalpha() for c in range(1 << 16)]))
    low = points < 1 << 16
    out = np.zeros(len(points), bool)
    out[low] = _bmp[0][points[low]]
    if not low.all():
        out[~low] = [chr(c).isalpha() for c in points[~low]]
    return out


def _letter(point: int, dimensions: int) -> np.ndarray:
    if point not in _letters or len(_letters[point]) != dimensions:
        _letters[point] = np.random.default_rng([SEED, point]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1
    return _letters[point]


def _bundle(owners: list[int], pieces: list[str], n: int, dimensions: int, out: np.ndarray, distinct: np.ndarray) -> None:
    """Adds the trigram vectors of pieces to the rows of out that own them, and their numbers of distinct trigrams."""
    arrays = [np.frombuffer((" " + p.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for p in pieces]
    row = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
    points = np.concatenate(arrays)
    points = np.where(_is_letter(points), points, 0)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0) | (row[1:] != row[:-1])
    points, row = points[keep], row[keep]
    if len(points) < 3:
        return
    alphabet, code = np.unique(points, return_inverse=True)
    a = len(alphabet)
    valid = (row[2:] == row[:-2]) & (points[1:-1] != 0)
    gram = (code[:-2] * a + code[1:-1]) * a + code[2:]
    gram, row = gram[valid], row[:-2][valid]
    if a**3 <= 1 << 20:
        seen = np.bincount(gram, minlength=a**3) > 0
        used = np.flatnonzero(seen)
        index = (np.cumsum(seen) - 1)[gram]
    else:
        used, index = np.unique(gram, return_inverse=True)
    vectors = np.stack([_letter(int(p), dimensions) for p in alphabet])
    owner = np.asarray(owners)[row]
    order = np.argsort(index, kind="stable") if len(used) > _SLICE else None
    for at in range(0, len(used), _SLICE):
        part = used[at : at + _SLICE]
        bound = np.roll(vectors, 2, 1)[part // (a * a)] * np.roll(vectors, 1, 1)[part // a % a] * vectors[part % a]
        if order is None:
            i, o = index, owner
        else:
            mine = order[np.searchsorted(index, at, sorter=order) : np.searchsorted(index, at + _SLICE, sorter=order)]
            i, o = index[mine] - at, owner[mine]
        counts = np.bincount(o * len(part) + i, minlength=n * len(part)).reshape(n, len(part))
        out += counts.astype(np.float32) @ bound.astype(np.float32)
        distinct += (counts > 0).sum(1)


def profiles(texts: list[str | None], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bundled trigram vector of each whole text; zero where it has no letter."""
    return profiles_and_distinct(texts, dimensions)[0]


def profiles_and_distinct(texts: list[str | None], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """profiles, and the number of distinct trigrams of each text (for texts of several pieces, of each piece, added up)."""
    out, distinct = np.zeros((len(texts), dimensions), np.float64), np.zeros(len(texts), np.int64)
    begin = 0
    while begin < len(texts):
        end, chars, owners, pieces = begin, 0, [], []
        while end < len(texts) and end - begin < _CHUNK_DOCS and (chars == 0 or chars + len(texts[end] or "") <= _CHUNK_CHARS):
            chars += len(texts[end] or "")
            end += 1
        n = end - begin
        sums = np.zeros((n, dimensions), np.float64)
        for i, t in enumerate(texts[begin:end]):
            for at in range(0, len(t or ""), _CHUNK_CHARS):
                if len(pieces) and at:  # a text longer than a chunk goes piece by piece
                    _bundle(owners, pieces, n, dimensions, sums, distinct[begin:end])
                    owners, pieces = [], []
                owners.append(i)
                pieces.append(t[max(0, at - 2) : at + _CHUNK_CHARS])
        if pieces:
            _bundle(owners, pieces, n, dimensions, sums, distinct[begin:end])
        out[begin:end] = sums
        begin = end
    return out, distinct


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return vectors / np.where(norm == 0, 1, norm)


def _labelled(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, text) of every row that has both."""
    return rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")


def learn(labelled: DataFrame, text: str, lang: str, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Language names and prototypes from all labelled rows; sums are of integers, so reruns agree."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch[at : at + _ROWS]
                scaled = np.rint(_unit(profiles(part["text"].tolist(), dimensions)) * 1e6).astype(np.int64)
                for name, rows in part.groupby("lang").indices.items():
                    total[name] = total.get(name, 0) + scaled[rows].sum(0)
        if total:
            yield pd.DataFrame({"lang": list(total), "v": [v.tolist() for v in total.values()]})

    parts = _labelled(labelled, text, lang).mapInPandas(sums, "lang string, v array<long>")
    rows = parts.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("v")).collect()
    names = sorted({r["lang"] for r in rows})
    protos = np.zeros((len(names), dimensions))
    for r in rows:
        protos[names.index(r["lang"]), r["pos"]] = r["v"]
    return names, _unit(protos)


def _class(distinct: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.log2(np.maximum(distinct, 1))).astype(int), 0, CLASSES - 1)


def calibrate(labelled: DataFrame, names: list[str], protos: np.ndarray, text: str, lang: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The least score of each class of texts, from all labelled rows that nothing was learned from.

    A class of fewer than LEAST values takes the limit of the one below; without any, the limit is 0. What
    reaches the driver is a histogram of CLASSES * BINS counts at most.
    """
    limits = np.zeros(CLASSES)
    if not names:
        return limits

    def histogram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((CLASSES, BINS), np.int64)
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch[at : at + _ROWS]
                texts, row = part["text"].tolist(), np.array([names.index(name) for name in part["lang"]])
                words = [t.split(None, _PREFIXES[-1]) for t in texts]
                # A length at a time: profiles cost by the trigrams of all texts that go together, and short texts have few.
                for k in (0, *_PREFIXES):
                    some = [i for i, w in enumerate(words) if k < len(w) or not k]
                    vectors, distinct = profiles_and_distinct([" ".join(words[i][:k]) if k else texts[i] for i in some], dimensions)
                    cosine = (_unit(vectors) * protos[row[some]]).sum(1)
                    bins = np.clip((cosine * BINS).astype(int), 0, BINS - 1)
                    np.add.at(total, (_class(distinct)[distinct > 0], bins[distinct > 0]), 1)
        at = np.argwhere(total > 0)
        yield pd.DataFrame({"class": at[:, 0], "bin": at[:, 1], "n": total[total > 0]})

    held = _labelled(labelled, text, lang).filter(F.col("lang").isin(names))
    counts = np.zeros((CLASSES, BINS), np.int64)
    for r in held.mapInPandas(histogram, "class int, bin int, n long").groupBy("class", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["class"], r["bin"]] = r["n"]
    for k in range(CLASSES):
        n = counts[k].sum()
        limits[k] = PART * np.searchsorted(counts[k].cumsum(), QUANTILE * n, side="right") / BINS if n >= LEAST else limits[k - 1] if k else 0.0
    return limits


def predictor(names: list[str], protos: np.ndarray, dimensions: int = DIMENSIONS, limits: np.ndarray | None = None):
    """A vectorised function from texts to (lang, score, known): known texts have letters and a score that reaches their limit."""
    least = np.zeros(CLASSES) if limits is None else limits

    def answer(texts: list[str | None]) -> pd.DataFrame:
        vectors, distinct = profiles_and_distinct(texts, dimensions)
        some = (vectors != 0).any(1)
        if not names:
            return pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": 0.0, "known": some})
        cosine = _unit(vectors) @ protos.T
        best = cosine.argmax(1)
        score = np.where(some, np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0), 0.0)
        return pd.DataFrame({
            "lang": np.where(some, np.array(names, object)[best], UNKNOWN), "score": score, "known": some & (score >= least[_class(distinct)]),
        })

    @F.arrow_udf("lang string, score double, known boolean")
    def predict(texts: pa.Array) -> pa.Array:
        # A slice at a time: a batch's vectors would take more memory than its texts.
        parts = [answer(texts.slice(at, _ROWS).to_pylist()) for at in range(0, max(1, len(texts)), _ROWS)]
        return pa.RecordBatch.from_pandas(pd.concat(parts, ignore_index=True), preserve_index=False).to_struct_array()

    return predict


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", dimensions: int = DIMENSIONS) -> DataFrame:
    """docs with held_out, lang_pred and score; learned from the rows that aren't held out and have a lang.

    A null text, one without letters, or a table without labels gives `und` and score 0. A null id isn't
    held out. Equal texts get equal answers; an empty table gives an empty one. `score` is the cosine, 0 to 1.
    """
    names, protos = learn(docs.filter(~held_out(F.col(id))), text, lang, dimensions)
    rows = docs.select(packed(docs), held_out(F.col(id)).alias("out"), predictor(names, protos, dimensions)(F.col(text)).alias("p"))
    return unpacked(rows, docs.columns, {"held_out": F.col("out"), "lang_pred": F.col("p.lang"), "score": F.col("p.score")})


def drop_unknown(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", dimensions: int = DIMENSIONS) -> DataFrame:
    """docs in a language, columns as they were.

    Null texts and texts without letters go, and texts whose best cosine is below the limit for their number of
    distinct trigrams: junk letters, and languages without a prototype. Limits come from held-out labelled rows;
    without such rows, or where nothing could be learned (no labels outside the held-out rows), all texts with letters stay.
    """
    inner = docs.select(packed(docs), F.col(text).alias("t"), F.col(lang).alias("l"), F.col(id).alias("i"))
    out = held_out(F.col("i"))
    names, protos = learn(inner.filter(~out), "t", "l", dimensions)
    limits = calibrate(inner.filter(out), names, protos, "t", "l", dimensions)
    known = predictor(names, protos, dimensions, limits)(F.col("t"))
    return inner.select(ROW, known.alias("p")).filter("p.known").select(f"{ROW}.*")
