"""Repair of the structure of conversations at least cost, the ASCII-least list of edits among the cheapest.

A repaired conversation's role initials are `(s?(ua)+)?`. Rows are dealt and sorted by range of (conversation, turn), so a
conversation of any size spreads over tasks, and each task cuts them into pieces: rows of one conversation, `PIECE_ROWS`
or `PIECE_BYTES` at most. A conversation that is one piece is solved where it lies. For the others only what
pieces owe each other is exchanged, as small rows: the first places of (role, text), a cost matrix over the four states
of the pattern, the costs to go at the end of each piece, and the state in which each piece is entered.

Within pieces, many at a time: a DP from the end gives the cost to go of every node (row, state); arcs that keep to it are
optimal. Nodes are ranked by their audits of 1, 2, 4, ... initials, with pointers that double along; each node takes
the optimal arc of least initial and rank, and the doubled pointers lay out the path from the entry. Arcs out of a
node differ in their initials, as the pattern is deterministic, so no two of them ever tie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import CRC_STEPS, Scratch, crc32_sql, written

PIECE_ROWS, PIECE_BYTES = 4096, 1 << 22
#: Padded rows that one DP takes at once, and pieces that are turned into Python values at once.
_AT_ONCE, _BATCH = 1 << 16, 512

# Costs of edits, and the pattern's states: 0 start, 1 after s, 2 after u, 3 after a.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_KEPT = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])  # by initial (other, s, u, a) and state
_NEXT = np.array([2, 2, 3, 2])  # the role that a new row can have: user, but assistant after user
_INITIALS, _EDITS, _NEVER = " sua", "DIKR", 1 << 40
_ENDS, _SPACE = ".!?", " \t\n\v\f\r"

_KEYS = [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32())]
_WORDS, _NUMBERS = pa.list_(pa.string()), pa.list_(pa.int64())
#: Of a piece's turns: the least and the greatest, how many there are, and those of its first and last row.
_TURNS = [(n, pa.int64()) for n in ("low", "high", "turns", "first", "last")]
_PIECES = pa.schema([*_KEYS, ("alone", pa.bool_()), *_TURNS, ("roles", _WORDS), ("texts", _WORDS)])
_SOLVED = pa.schema([*_KEYS, ("initials", pa.string()), ("faults", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_FACTS = pa.schema([*_KEYS, ("initials", pa.string()), ("faults", pa.string()), ("matrix", _NUMBERS)])
_WAYS = pa.schema([*_KEYS, ("audits", _WORDS), ("exits", _NUMBERS)])
_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_REPORT = pa.schema([("conv_id", pa.int64()), *[(f, pa.int64()) for f in _FIGURES], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_DDL = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string", _WORDS: "array<string>", _NUMBERS: "array<long>"}


def _mapped(rows: DataFrame, work: Callable[[list[dict]], list[dict]], schema: pa.Schema) -> DataFrame:
    """work on each batch of rows as dictionaries (whole numbers with nulls stay exact, which pandas would not keep)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                yield pa.RecordBatch.from_pylist(work(batch.slice(at, _BATCH).to_pylist()), schema)

    return rows.mapInArrow(each, _ddl(schema))


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def _cut(piece_rows: int, piece_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows as pieces. A piece is alone if it surely is its whole conversation: not at an edge of what the task reads."""
        part, seq, size, ready = TaskContext.get().partitionId(), 0, 0, []
        now: dict | None = None
        turns: list[int | None] = []

        def close(more: bool) -> None:
            known = [t for t in turns if t is not None]
            now.update(low=min(known, default=None), high=max(known, default=None), turns=len(set(known)), first=turns[0], last=turns[-1])
            now["alone"] = not (now.pop("continues") or more)
            ready.append(now)

        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                same = now is None or conv == now["conv_id"]  # before the first row of all, another task may have its conversation
                if now is None or not same or len(turns) >= piece_rows or size >= piece_bytes:
                    if now is not None:
                        close(same)
                        if len(ready) >= _BATCH or size >= piece_bytes:
                            yield pa.RecordBatch.from_pylist(ready, _PIECES)
                            ready = []
                    now = {"conv_id": conv, "part": part, "seq": seq, "continues": same, "roles": [], "texts": []}
                    turns, size, seq = [], 0, seq + 1
                turns.append(turn)
                now["roles"].append(role)
                now["texts"].append(text)
                size += len(text)
        if now is not None:
            close(True)
            yield pa.RecordBatch.from_pylist(ready, _PIECES)

    return cut


def _faults(roles: list[str], texts: list[str], firsts: list[int] | None) -> str:
    """A letter a row: blank, duplicate, truncated or none. firsts: places of rows seen for the first time, if other pieces count."""
    seen, out = set(), []
    known = None if firsts is None else set(firsts)
    for i, (role, text) in enumerate(zip(roles, texts)):
        new = (role, text) not in seen if known is None else i in known
        seen.add((role, text))
        stripped = text.rstrip(_SPACE)
        out.append("b" if not stripped else "d" if not new else "t" if stripped[-1] not in _ENDS else "-")
    return "".join(out)


def _initials(roles: list[str]) -> str:
    return "".join(r[:1] or " " for r in roles)


def _closed(v: np.ndarray) -> np.ndarray:
    """Costs to go, where rows can be inserted first."""
    out = v.copy()
    out[..., 2] = np.minimum(v[..., 2], INSERT + v[..., 3])
    out[..., 3] = np.minimum(v[..., 3], INSERT + v[..., 2])
    out[..., :2] = np.minimum(v[..., :2], INSERT + out[..., 2:3])
    return out


#: Costs to go when all rows are used up.
_OVER = _closed(np.array([0, _NEVER, _NEVER, 0]))


class _Layers:
    """Pieces of like length, padded: the initials' codes, rows that have to go, truncated rows, and lengths."""

    def __init__(self, pieces: list[tuple[str, str]]) -> None:
        self.n = np.array([len(i) for i, _ in pieces])
        wide = int(self.n.max(initial=0))
        text = lambda k: np.array([list(p[k].ljust(wide)) for p in pieces], dtype="U1").reshape(len(pieces), wide)
        initials, faults = text(0), text(1)
        self.code = sum(k * (initials == c) for k, c in enumerate(_INITIALS) if k)
        self.gone, self.extra = (faults == "b") | (faults == "d"), TRUNCATED * (faults == "t")

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Costs to go of all nodes, by piece, layer and state; ends: those at each piece's end."""
        m, wide = self.code.shape
        v = np.full((m, wide + 1, 4), _NEVER)
        v[np.arange(m), self.n] = ends
        for t in range(wide - 1, -1, -1):
            after, extra = v[:, t + 1], self.extra[:, t, None]
            to = _KEPT[self.code[:, t]]
            kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1) + KEEP + extra, _NEVER)
            moved = np.minimum(kept, REROLE + extra + after[:, _NEXT])
            best = np.minimum(DELETE + after, np.where(self.gone[:, t, None], _NEVER, moved))
            v[:, t] = np.where((t < self.n)[:, None], np.minimum(_closed(best), _NEVER), v[:, t])
        return v

    def arcs(self, v: np.ndarray, closing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For D, I, K, R: which arcs are optimal, and the nodes that they lead to. closing: pieces that end their conversation."""
        m, layers, _ = v.shape
        node = np.arange(v.size).reshape(v.shape)
        here = np.arange(layers)[None, :, None] < self.n[:, None, None]
        after = np.concatenate((v[:, 1:], v[:, -1:]), axis=1)
        pad = lambda x, fill: np.concatenate((x, np.full((m, 1), fill)), axis=1)[:, :, None]
        extra, stays = pad(self.extra, 0), here & ~pad(self.gone, False)
        to = _KEPT[pad(self.code, 0)[:, :, 0]]
        base = node[:, :, :1]
        targets = np.stack((node + 4, base + _NEXT, base + 4 + np.maximum(to, 0), base + 4 + _NEXT))
        inserts = (here | (closing[:, None, None] & (np.arange(layers)[None, :, None] == self.n[:, None, None]))) & (INSERT + v[:, :, _NEXT] == v)
        optimal = np.stack((
            here & (DELETE + after == v), inserts, stays & (to >= 0) & (KEEP + extra + np.take_along_axis(after, np.maximum(to, 0), 2) == v),
            stays & (REROLE + extra + after[:, :, _NEXT] == v),
        ))
        return optimal.reshape(4, -1), np.where(optimal, targets, 0).reshape(4, -1)

    def least(self, v: np.ndarray, closing: np.ndarray, entry: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The audit of each piece's least path from its entry state, and the state that it ends in."""
        optimal, targets = self.arcs(v, closing)
        nodes, ends = np.arange(v.size), ~optimal.any(0)
        doublings = int(2 * self.n.max(initial=0) + 3).bit_length()
        step = np.where(ends, nodes, np.take_along_axis(targets, optimal.argmax(0)[None], 0)[0])
        rank, to = np.where(ends, 0, 1 + optimal.argmax(0)), step
        for _ in range(doublings):  # ranks of the audits of 1, 2, 4, ... initials
            rank, to = np.unique(rank * (v.size + 5) + rank[to], return_inverse=True)[1], to[to]
        # Of a node's optimal arcs the one with the least initial, then rank of what follows.
        keys = np.where(optimal, np.arange(4)[:, None] * v.size + rank[targets], 4 * v.size)
        chosen = keys.argmin(0)
        to = np.where(ends, nodes, np.take_along_axis(targets, chosen[None], 0)[0])
        label = np.where(ends, 0, 1 + chosen)
        path = (np.arange(len(self.n)) * v.shape[1] * 4 + entry)[:, None]
        for _ in range(doublings):
            path, to = np.concatenate((path, to[path]), axis=1), to[to]
        letters = np.frombuffer(("\0" + _EDITS).encode(), np.uint8)[label[path]]
        return [row[row > 0].tobytes().decode() for row in letters], path[:, -1] % 4


def _alike(pieces: list[tuple[str, str]]) -> Iterator[np.ndarray]:
    """Pieces in lots of like length, so that padding at most doubles them."""
    sizes = np.array([len(i) for i, _ in pieces])
    classes = np.array([int(n).bit_length() for n in sizes])
    for c in np.unique(classes):
        of_class = np.flatnonzero(classes == c)
        lot = max(1, _AT_ONCE >> int(c))
        yield from (of_class[at : at + lot] for at in range(0, len(of_class), lot))


def _replayed(audit: str, state: int, roles: list[str], texts: list[str]) -> list[dict]:
    """The repaired rows that an audit makes."""
    out, at = [], 0
    for edit in audit:
        if edit == "K":
            out.append({"role": roles[at], "text": texts[at]})
            state = int(_KEPT[_INITIALS.index(roles[at][:1]), state])
        elif edit != "D":
            state = int(_NEXT[state])
            out.append({"role": "user" if state == 2 else "assistant", "text": texts[at] if edit == "R" else ""})
        at += edit != "I"
    return out


def _described(rows: list[dict]) -> list[tuple[str, str]]:
    return [(_initials(r["roles"]), _faults(r["roles"], r["texts"], r.get("firsts", []))) for r in rows]


def _solve_alone(rows: list[dict]) -> list[dict]:
    """Whole conversations, one piece each."""
    pieces = _described([r | {"firsts": None} for r in rows])
    out = [{k: r[k] for k in ("conv_id", "part", "seq")} | {"initials": i, "faults": f} for r, (i, f) in zip(rows, pieces)]
    for lot in _alike(pieces):
        layers = _Layers([pieces[i] for i in lot])
        v = layers.costs(np.tile(_OVER, (len(lot), 1)))
        audits, _ = layers.least(v, np.ones(len(lot), bool), np.zeros(len(lot), int))
        for i, audit, cost in zip(lot, audits, v[:, 0, 0]):
            out[i] |= {"audit": audit, "cost": int(cost)}
    return out


def _describe(rows: list[dict]) -> list[dict]:
    """What the other pieces of a conversation need to know of each piece; matrix: costs by entry and exit state."""
    pieces = _described([r | {"firsts": r["firsts"] or []} for r in rows])
    out = [{k: r[k] for k in ("conv_id", "part", "seq")} | {"initials": i, "faults": f} for r, (i, f) in zip(rows, pieces)]
    for lot in _alike(pieces):
        layers = _Layers([pieces[i] for i in lot])
        by_exit = [layers.costs(np.tile(np.where(np.arange(4) == e, 0, _NEVER), (len(lot), 1)))[:, 0] for e in range(4)]
        for i, matrix in zip(lot, np.stack(by_exit, axis=2)):
            out[i]["matrix"] = matrix.ravel().tolist()
    return out


def _chain_back(group: pd.DataFrame) -> pd.DataFrame:
    """Costs to go at the end of each piece of a conversation; the whole cost stands at its first piece."""
    group = group.sort_values(["part", "seq"])
    ends, v = [], _OVER
    for matrix in reversed(group["matrix"].tolist()):
        ends.append(v.tolist())
        v = np.minimum((np.array(matrix).reshape(4, 4) + v).min(1), _NEVER)
    last = np.arange(len(group)) == len(group) - 1
    return pd.DataFrame({"part": group["part"].to_numpy(), "seq": group["seq"].to_numpy(), "ends": ends[::-1], "closing": last, "cost": [int(v[0])] + [0] * (len(group) - 1)})


def _all_ways(rows: list[dict]) -> list[dict]:
    """The least audit of a piece from each entry state, and the state that it leads to."""
    out = [{k: r[k] for k in ("conv_id", "part", "seq")} | {"audits": [], "exits": []} for r in rows]
    pieces = [(r["initials"], r["faults"]) for r in rows]
    for lot in _alike(pieces):
        layers = _Layers([pieces[i] for i in lot])
        v, closing = layers.costs(np.array([rows[i]["ends"] for i in lot])), np.array([rows[i]["closing"] for i in lot])
        for entry in range(4):
            audits, exits = layers.least(v, closing, np.full(len(lot), entry))
            for i, audit, state in zip(lot, audits, exits):
                out[i]["audits"].append(audit)
                out[i]["exits"].append(int(state))
    return out


def _chain_on(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece is entered."""
    group = group.sort_values(["part", "seq"])
    entries, state = [], 0
    for exits in group["exits"]:
        entries.append(state)
        state = int(exits[state])
    return pd.DataFrame({"part": group["part"].to_numpy(), "seq": group["seq"].to_numpy(), "entry": entries})


def _played(audit: pd.Series, entry: pd.Series, roles: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series([_replayed(*x) for x in zip(audit, entry, roles, texts)], dtype=object)


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Pieces of repaired conversations, a written table: conv_id, part and seq (their order), alone, counts, cost, audit, turns.

    rows has conv_id, turn, role and text; other columns aren't read. Rows of a conversation go by turn, nulls
    first; ties by role, then MD5 of the text. A null role or text counts as one space; null conv_ids are one conversation. Empty
    and very long texts are treated whole, repeated rows are duplicates of their first. `alone` says that a piece is
    a whole conversation; of others the figures add up over the pieces, and audits and turns follow each other. A
    conversation without rows has none. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    space = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(" ")).alias(name)
    plain = rows.select("conv_id", "turn", space("role"), space("text")).withColumns({"tie": F.md5("text"), "salt": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "tie", "salt"]  # the salt lets rows that are the same spread
    laid = plain.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    key = ["part", "seq"]
    with Scratch(spark) as scratch:
        pieces = scratch.write(laid.mapInArrow(_cut(piece_rows, piece_bytes), _ddl(_PIECES)))
        alone, several = pieces.filter("alone"), pieces.filter("not alone")
        # Whole conversations.
        solved = _mapped(alone.select("conv_id", *key, "roles", "texts"), _solve_alone, _SOLVED).withColumn("entry", F.lit(0))
        # The others: first places of each (role, text), costs back over the pieces, states on over them.
        each = several.select("conv_id", *key, "roles", F.transform("texts", F.md5).alias("sums"))
        each = each.select("conv_id", *key, F.posexplode(F.arrays_zip("roles", "sums")).alias("at", "row"))
        firsts = each.groupBy("conv_id", "row").agg(F.min(F.struct(*key, "at")).alias("f")).select("f.*")
        firsts = firsts.groupBy(*key).agg(F.collect_list("at").alias("firsts"))
        shown = several.select("conv_id", *key, "roles", "texts").join(firsts, key, "left").select("conv_id", *key, "roles", "texts", "firsts")
        facts = scratch.write(_mapped(shown, _describe, _FACTS))
        back = scratch.write(facts.groupBy("conv_id").applyInPandas(_chain_back, "part int, seq int, ends array<long>, closing boolean, cost long"))
        ways = facts.drop("matrix").join(back.drop("cost"), key).select("conv_id", *key, "initials", "faults", "ends", "closing")
        ways = scratch.write(_mapped(ways, _all_ways, _WAYS))
        entries = ways.select("conv_id", *key, "exits").groupBy("conv_id").applyInPandas(_chain_on, "part int, seq int, entry int")
        known = ways.join(entries, key).select(*key, "entry", F.get("audits", "entry").alias("audit"))
        found = facts.drop("matrix").join(back.select(*key, "cost"), key).join(known, key)
        # Every piece again with its rows; figures that lie between two pieces count at the later one.
        found = scratch.write(solved.unionByName(found.select(solved.columns)))
        before = lambda c: F.lag(c).over(W.partitionBy("conv_id").orderBy(*key))
        between = pieces.filter("not alone").drop("roles", "texts").join(found.select(*key, "initials"), key).select(
            *key, (before("last") == F.col("first")).cast("long").alias("again"), F.right(before("initials"), F.lit(1)).alias("edge"),
            *[F.when(before("seq").isNull(), f(c).over(W.partitionBy("conv_id"))).alias(f"all_{c}") for f, c in ((F.min, "low"), (F.max, "high"))],
        )
        rows = pieces.drop("conv_id").join(found, key).join(between, key, "left")
        span = F.when(F.col("alone"), F.col("high") - F.col("low")).otherwise(F.col("all_high") - F.col("all_low")) + 1
        pairs = F.concat(F.coalesce("edge", F.lit("")), "initials")
        illegal = F.expr("size(filter(sequence(1, length(pairs)), i -> i < length(pairs) and substring(pairs, i, 2) not in ('su', 'ua', 'au')))")
        letters = lambda c: (F.length("faults") - F.length(F.replace("faults", F.lit(c)))).cast("long")
        return written(rows.withColumn("pairs", pairs).select(
            "conv_id", *key, "alone", (F.coalesce(span, F.lit(0)) - F.col("turns") + F.coalesce("again", F.lit(0))).alias("gaps"), letters("b").alias("blank"),
            letters("d").alias("duplicate"), letters("t").alias("truncated"), illegal.cast("long").alias("illegal"), "cost", "audit",
            F.pandas_udf(_played, "array<struct<role:string,text:string>>")("audit", "entry", "roles", "texts").alias("turns"),
        ))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one row a conversation; texts are hashed as they come, none is kept."""
    now: dict | None = None
    sha, sign = hashlib.sha256(), ""

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([now | {"audit": "".join(now["audit"]), "repaired_sha256": sha.hexdigest()}], _REPORT)

    for batch in batches:
        for r in (x for at in range(batch.num_rows) for x in batch.slice(at, 1).to_pylist()):
            if now is None or r["conv_id"] != now["conv_id"]:
                if now is not None:
                    yield row()
                now, sha, sign = {"conv_id": r["conv_id"], "audit": [], **dict.fromkeys(_FIGURES, 0)}, hashlib.sha256(), ""
            now |= {n: now[n] + r[n] for n in _FIGURES}
            now["audit"].append(r["audit"])
            for turn in r["turns"]:
                sha.update(f"{sign}{turn['role']}:{turn['text']}".encode())
                sign = "\n"
    if now is not None:
        yield row()


def report(solved: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of conversations: gaps, faults, cost, audit and the SHA-256 of the repaired `role:text`, newline-joined."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    alone = solved.filter("alone").select("conv_id", *_FIGURES, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    several = solved.filter("not alone").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    found = alone.unionByName(several.mapInArrow(_hashed, _ddl(_REPORT))).withColumnRenamed("conv_id", "found")
    ids = conversations.select("conv_id").distinct()
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id", *[F.coalesce(f, F.lit(0)).alias(f) for f in _FIGURES], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text) that a hash of conv_id and turn drops, empties, strips of sentence ends, repeats or gives the role user."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), h.alias("h")).filter("h != 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", _ENDS, "")).otherwise(F.col("text"))
    role: Column = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


# Costs from the end, then edits from the start, the first letter that keeps to the costs: D, I, K, R. No ties of turns are expected.
ORACLE = rf"""
WITH RECURSIVE {CRC_STEPS},
hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations, steps),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE h <> 0),
placed AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, role[1] AS c, lead(role[1]) OVER w AS c2,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '-' END AS fault
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
back AS (
  SELECT conv_id, n + 1 AS i, 0 AS v0, 6 AS v1, 3 AS v2, 0 AS v3 FROM placed WHERE i = 1
  UNION ALL
  SELECT conv_id, i, least(b0, 3 + least(b2, 3 + b3)), least(b1, 3 + least(b2, 3 + b3)), least(b2, 3 + b3), least(b3, 3 + b2) FROM (
    SELECT p.conv_id, p.i,
      least(4 + v0, CASE WHEN must THEN 999999999 ELSE e + least(CASE c WHEN 's' THEN v1 WHEN 'u' THEN v2 ELSE 999999999 END, 3 + v2) END) AS b0,
      least(4 + v1, CASE WHEN must THEN 999999999 ELSE e + least(CASE c WHEN 'u' THEN v2 ELSE 999999999 END, 3 + v2) END) AS b1,
      least(4 + v2, CASE WHEN must THEN 999999999 ELSE e + least(CASE c WHEN 'a' THEN v3 ELSE 999999999 END, 3 + v3) END) AS b2,
      least(4 + v3, CASE WHEN must THEN 999999999 ELSE e + least(CASE c WHEN 'u' THEN v2 ELSE 999999999 END, 3 + v2) END) AS b3
    FROM back b JOIN (SELECT *, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS e FROM placed) p ON p.conv_id = b.conv_id AND p.i = b.i - 1)),
nodes AS (SELECT b.conv_id, b.i, [v0, v1, v2, v3] AS v, lead([v0, v1, v2, v3]) OVER (PARTITION BY b.conv_id ORDER BY b.i) AS w,
  p.role, p.text, p.c, p.fault IN ('b', 'd') AS must, CASE WHEN p.fault = 't' THEN 3 ELSE 0 END AS e FROM back b LEFT JOIN placed p ON p.conv_id = b.conv_id AND p.i = b.i),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS turns FROM placed WHERE i = 1
  UNION ALL
  SELECT conv_id, i + CASE WHEN edit = 'I' THEN 0 ELSE 1 END, CASE edit WHEN 'D' THEN s WHEN 'K' THEN k ELSE r END, audit || edit,
    CASE edit WHEN 'D' THEN turns WHEN 'K' THEN list_append(turns, role || ':' || text)
      ELSE list_append(turns, CASE r WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT *, CASE WHEN w IS NOT NULL AND 4 + w[s + 1] = v[s + 1] THEN 'D' WHEN 3 + v[r + 1] = v[s + 1] THEN 'I'
      WHEN NOT must AND k > 0 AND e + w[k + 1] = v[s + 1] THEN 'K' ELSE 'R' END AS edit
    FROM (SELECT x.*, n.v, n.w, n.role, n.text, n.must, n.e, CASE WHEN s = 2 THEN 3 ELSE 2 END AS r,
        CASE WHEN c = 's' AND s = 0 THEN 1 WHEN c = 'u' AND s <> 2 THEN 2 WHEN c = 'a' AND s = 2 THEN 3 ELSE -1 END AS k
      FROM walk x JOIN nodes n ON n.conv_id = x.conv_id AND n.i = x.i) WHERE NOT (w IS NULL AND s IN (0, 3)))),
done AS (SELECT conv_id, arg_max(audit, (i, length(audit))) AS audit, arg_max(turns, (i, length(audit))) AS turns FROM walk GROUP BY conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (i < n AND coalesce(c || c2, '') NOT IN ('su', 'ua', 'au')) AS illegal FROM placed GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.v0, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id = o.conv_id LEFT JOIN done d ON d.conv_id = o.conv_id
LEFT JOIN back b ON b.conv_id = o.conv_id AND b.i = 1
"""
