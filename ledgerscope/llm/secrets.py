"""Secret scans in DataFrame operations only: known formats, and sliding-window entropy.

Known formats are regular expressions. Positions come from the text's pieces around the matches: their
lengths, added up block by block, are the offsets in code points. Beside these, candidate strings (long runs of key
characters with letters and digits, outside of the known formats) are scored by the Shannon entropy of a sliding
window. The window's character counts are kept as it moves: one character enters, one leaves, their two
counts change, and the sum of c * log2(c) changes by their terms only. The counts are fields of five bits in
six longs. Each character class has its own threshold, and an allow-list suppresses candidates
that are random by design but no secrets. A document is one row throughout: nothing is exploded or shuffled.

A text is matched once for each kind: `_let` hands a value to a function as a lambda variable, where a
column that a lambda refers to would be computed again for each element.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, packed, unpacked

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
#: Character class of a whole candidate, and the bits that some window of it must reach.
CLASSES = [(r"^[0-9a-fA-F]+$", 3.0), (r"^[A-Z0-9]+$", 3.5), (r"^[a-z0-9]+$", 3.5), (r"^", 3.8)]
#: Formats that look random and are public: UUIDs, counting alphabets, placeholders.
ALLOWED = [
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)0123456789|abcdefghijk|example|placeholder|changeme|xxxxxx",
]

_SPAN = "array<struct<start:long,rank:int,end:long,kind:string>>"
_BLOCK = 64  # matches that one fold adds up; an array that grows by one is copied, so folds stay short
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_FIELD, _FIELDS = 5, 12  # bits of a count, counts in a long


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(body: Column, pattern: str, group: int = 0) -> Column:
    """The matches with the text before each: (piece, match, part), part a group of the pattern. The text after the last match isn't in it."""
    pieces, matches = F.split(body, pattern, -1), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(body, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), part.alias("part"))
    return F.filter(zipped, lambda z: z["match"].isNotNull())


def _blocks(items: Column) -> Column:
    count = F.ceil(F.size(items) / _BLOCK).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda b: F.slice(items, (b - 1) * _BLOCK + 1, F.lit(_BLOCK)))).otherwise(F.array())


def _sum(items: Column, of) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda total, x: total + of(x))


def _fold(items: Column, start: Column, of) -> Column:
    """(item, at) for each item: at is start and the values of all items before it."""
    state = F.struct(start.alias("at"), F.slice(F.transform(items, lambda x: F.struct(x.alias("item"), start.alias("at"))), 1, 0).alias("out"))

    def step(s: Column, x: Column) -> Column:
        return F.struct((s["at"] + of(x)).alias("at"), F.concat(s["out"], F.array(F.struct(x.alias("item"), s["at"].alias("at")))).alias("out"))

    return F.aggregate(items, state, step, lambda s: s["out"])


def _placed(items: Column, of) -> Column:
    """(item, at) for each item, at the sum of the values before it: two levels of blocks, so that no fold is long."""
    level = lambda inner: lambda blocks, start, size: F.flatten(F.transform(_fold(blocks, start, size), inner))
    within = level(lambda b: _fold(b["item"], b["at"], of))
    of_block = lambda b: _sum(b, of)
    of_blocks = lambda bs: _sum(bs, of_block)
    return _let(_blocks(items), lambda blocks: _let(_blocks(blocks), lambda outer: F.flatten(
        F.transform(_fold(outer, F.lit(0).cast("long"), of_blocks), lambda o: within(o["item"], o["at"], of_block))
    )))


def _spans(parts: Column, kind: str, rank: int, keep=None) -> Column:
    """Spans of the matches that pass keep(part): each starts where the pieces and matches before it end."""
    long = lambda x: (F.length(x["piece"]) + F.length(x["match"])).cast("long")

    def span(p: Column) -> Column:
        start = p["at"] + F.length(p["item"]["piece"])
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(p["item"]["match"])).alias("end"), F.lit(kind).alias("kind")
        )

    placed = _placed(parts, long)
    if keep is not None:
        placed = F.filter(placed, lambda p: keep(p["item"]["part"]))
    return F.transform(placed, span)


def _found(body: Column, pattern: str, kind: str, rank: int, keep=None, group: int = 0, gate: Column | None = None) -> Column:
    some = F.rlike(body, F.lit(pattern)) if gate is None else gate & F.rlike(body, F.lit(pattern))
    return F.when(some, _let(_parts(body, pattern, group), lambda parts: _spans(parts, kind, rank, keep))).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _blanked(body: Column, pattern: str, keep=None, group: int = 0) -> Column:
    """body with spaces in place of the matches that pass keep, at the same places."""
    blank = lambda z: F.repeat(F.lit(" "), F.length(z["match"]))
    one = (lambda z: F.concat(z["piece"], blank(z))) if keep is None else lambda z: F.concat(z["piece"], F.when(keep(z["part"]), blank(z)).otherwise(z["match"]))
    return F.when(F.rlike(body, F.lit(pattern)), F.concat(
        F.array_join(F.transform(_parts(body, pattern, group), one), ""), F.element_at(F.split(body, pattern, -1), -1)
    )).otherwise(body)


def window_entropy(token: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any window (31 characters at most) of a string over ALPHABET."""
    if window >= 1 << _FIELD:
        raise ValueError(f"a window has {(1 << _FIELD) - 1} characters at most")
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    term = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))
    longs = range(-(-len(ALPHABET) // _FIELDS))
    word, shift = (lambda code: F.floor(code / _FIELDS)), (lambda code: (code % _FIELDS * _FIELD).cast("int"))
    one = lambda code, i: F.when(word(code) == i, F.call_function("shiftleft", F.lit(1).cast("long"), shift(code))).otherwise(F.lit(0).cast("long"))

    def count(s: Column, code: Column) -> Column:
        held = F.coalesce(*[F.when(word(code) == i, s[f"c{i}"]) for i in longs])
        return F.call_function("shiftright", held, shift(code)).bitwiseAND(F.lit((1 << _FIELD) - 1))

    state = F.struct(
        *[F.lit(0).cast("long").alias(f"c{i}") for i in longs], F.lit(0.0).alias("sum"), F.lit(0).alias("seen"), F.lit(0.0).alias("best")
    )

    def step(s: Column, move: Column) -> Column:
        enters, leaves = move["in"], move["out"]
        full = leaves >= 0
        had, of_leaving = count(s, enters), count(s, leaves)
        # A character that enters as one of its own leaves changes nothing.
        change = term(had + 1) - term(had) + F.when(full, term(of_leaving - 1) - term(of_leaving)).otherwise(0.0)
        total = s["sum"] + F.when(full & (enters == leaves), 0.0).otherwise(change)
        seen = s["seen"] + 1
        bits = F.when(seen >= window, F.lit(math.log2(window)) - total / window).otherwise(F.lit(0.0))
        counts = [(s[f"c{i}"] + one(enters, i) - F.when(full, one(leaves, i)).otherwise(0)).alias(f"c{i}") for i in longs]
        return F.struct(*counts, total.alias("sum"), seen.alias("seen"), F.greatest(s["best"], bits).alias("best"))

    moves = _let(codes, lambda c: F.arrays_zip(c.alias("in"), F.concat(F.array_repeat(F.lit(-1), window), c).alias("out")))
    return F.aggregate(F.filter(moves, lambda m: m["in"].isNotNull()), state, step, lambda s: s["best"])


def _random(token: Column, window: int) -> Column:
    """Whether a candidate with letters and digits has a window above its class's threshold and isn't allowed."""
    least = F.coalesce(*[F.when(F.rlike(token, F.lit(p)), F.lit(bits)) for p, bits in CLASSES])
    allowed = F.lit(False)
    for p in ALLOWED:
        allowed = allowed | F.rlike(token, F.lit(p))
    shape = F.rlike(token, F.lit("[0-9]")) & F.rlike(token, F.lit("[A-Za-z]"))
    return F.when(shape & ~allowed, window_entropy(token, window) >= least).otherwise(F.lit(False))


def find_secrets(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256, spans and secret_spans (an array of structs).

    Spans are kind:start:end in code points, end exclusive, by start, then kind (assign, access, hex,
    entropy). Candidates for entropy spans are sought in what known formats leave of the text. A null text counts
    as empty: no spans, and the hash of "". Repeated rows are scanned one by one; an empty table gives an empty
    one. Very long texts are scanned whole, in time that grows with length and matches. Input columns named like
    a result column give way, others keep their values.
    """
    rows = docs.select(packed(docs), F.coalesce(F.col(text), F.lit("")).alias("body"))
    body = F.col("body")
    long_enough = lambda part: F.length(part) >= 6
    rest = _let(_blanked(body, ASSIGN, long_enough, 2), lambda t: _let(_blanked(t, ACCESS), lambda u: _blanked(u, HEX)))
    rows = rows.withColumns({
        "assign": _found(body, ASSIGN, "assign", 0, long_enough, 2),
        "access": _found(body, ACCESS, "access", 1, gate=F.contains(body, F.lit("AKIA"))),
        "hex": _found(body, HEX, "hex", 2),
        "entropy": F.when(F.rlike(body, F.lit("[0-9]")) & F.rlike(body, F.lit(CANDIDATE)), _let(
            rest, lambda r: _found(r, CANDIDATE, "entropy", 3, lambda part: _random(part, window))
        )).otherwise(F.expr(f"cast(array() as {_SPAN})")),
    })
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    rows = rows.withColumn("every", F.array_sort(F.concat("base", "entropy")))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda c: F.size(c).cast("long")
    return unpacked(rows, docs.columns, {
        "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
        "base_sha256": F.sha2(joined("base"), 256), "spans": joined("every"), "secret_spans": F.col("every"),
    })


def _sql() -> str:
    """DuckDB SQL for the columns of the query; entropies come from its own aggregate, window by window."""
    every = lambda pattern, group: f"regexp_extract_all(t, '{pattern}', {group})"
    quoted = [p.replace("'", "''") for p in (ASSIGN, ACCESS, HEX, CANDIDATE)]
    blank = lambda pattern, part, least: (
        f"array_to_string(list_transform(list_zip(string_split_regex(t, '{pattern}'), {every(pattern, 0)} || [''], {every(pattern, part)} || ['']), "
        f"lambda z: z[1] || CASE WHEN length(z[3]) >= {least} THEN repeat(' ', length(z[2])) ELSE z[2] END), '')"
    )
    hit = lambda kind, rank, pattern, part, table: (
        f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, unnest(string_split_regex(t, '{pattern}')) AS piece, unnest({every(pattern, 0)} || ['']) AS m, "
        f"unnest({every(pattern, part)} || ['']) AS part, unnest(range(0, len({every(pattern, 0)}) + 1)) AS i FROM {table}"
    )
    classes = " ".join(f"WHEN regexp_matches(part, '{p}') THEN {bits}" for p, bits in CLASSES)
    allowed = " OR ".join(f"regexp_matches(part, '{p}')" for p in ALLOWED)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r1 AS (SELECT doc_id, {blank(quoted[0], 2, 6)} AS t FROM d), r2 AS (SELECT doc_id, {blank(quoted[1], 0, 0)} AS t FROM r1),
r3 AS (SELECT doc_id, {blank(quoted[2], 0, 0)} AS t FROM r2),
hits AS ({hit("assign", 0, quoted[0], 2, "d")} UNION ALL {hit("access", 1, quoted[1], 0, "d")} UNION ALL {hit("hex", 2, quoted[2], 0, "d")}
         UNION ALL {hit("entropy", 3, quoted[3], 0, "r3")}),
ends AS (SELECT *, sum(length(piece) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM hits),
kept AS (
  SELECT doc_id, kind, rank, (stop - length(m))::BIGINT AS start, stop::BIGINT AS stop FROM ends
  WHERE length(m) > 0 AND CASE rank WHEN 0 THEN length(part) >= 6 WHEN 3 THEN
    regexp_matches(part, '[0-9]') AND regexp_matches(part, '[A-Za-z]') AND NOT ({allowed})
    AND list_max(list_transform(range(1, length(part) - {WINDOW} + 2), lambda k: list_aggregate(string_split(substr(part, k, {WINDOW}), ''), 'entropy')))
        >= CASE {classes} END ELSE true END),
found AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k, count(*) FILTER (rank = 2) AS h,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN found USING (doc_id)
"""


ORACLE = _sql()
