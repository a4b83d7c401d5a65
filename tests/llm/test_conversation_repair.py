import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from conftest import SF

from ledgerscope.llm import conversation_repair as repair
from ledgerscope.llm import registry

PATTERN = re.compile("(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        words = BLANK.findall(text)
        out.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def brute(rows):
    """Least (cost, audit) and its rows, over (row, last initial, whether an s stands alone)."""
    marks = faults(rows)

    def legal(state, initial):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[state].find(initial) >= 0 and initial != ""

    best = {(len(rows), s): (0, "", ()) for s in ("", "a")}
    for i in range(len(rows), -1, -1):
        for _ in range(3):  # inserts lead to nodes of the same row
            for s in ("", "s", "u", "a"):
                options = [best[i, s]] if (i, s) in best else []
                for role in ("user", "assistant"):
                    if legal(s, role[0]) and (i, role[0]) in best:
                        cost, audit, kept = best[i, role[0]]
                        options.append((cost + 3, "I" + audit, (f"{role}:", *kept)))
                if i < len(rows):
                    role, text = rows[i]
                    cost, audit, kept = best[i + 1, s]
                    options.append((cost + 4, "D" + audit, kept))
                    if marks[i] not in "bd":
                        extra = 3 * (marks[i] == "t")
                        if legal(s, role[:1]):
                            cost, audit, kept = best[i + 1, role[:1]]
                            options.append((cost + extra, "K" + audit, (f"{role}:{text}", *kept)))
                        for new in ("user", "assistant"):
                            if legal(s, new[0]):
                                cost, audit, kept = best[i + 1, new[0]]
                                options.append((cost + 3 + extra, "R" + audit, (f"{new}:{text}", *kept)))
                if options:
                    best[i, s] = min(options, key=lambda o: o[:2])
    return best[0, ""]


def exhaustive(rows):
    """All lists of edits with at most one insert before each row and two at the end."""
    marks, found = faults(rows), []
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    edits = ["D", "K", "u", "a"]
    for chosen in itertools.product(*[list(itertools.product(inserts, edits)) for _ in rows], inserts):
        cost, audit, initials = 0, "", ""
        for (before, edit), (role, _), mark in zip(chosen, rows, marks):
            cost, audit, initials = cost + 3 * len(before), audit + "I" * len(before), initials + "".join(before)
            if edit != "D" and mark in "bd":
                break
            cost += 4 if edit == "D" else (3 if edit in "ua" else 0) + 3 * (mark == "t")
            audit += "R" if edit in "ua" else edit
            initials += "" if edit == "D" else role[:1] or " " if edit == "K" else edit
        else:
            cost, audit, initials = cost + 3 * len(chosen[-1]), audit + "I" * len(chosen[-1]), initials + "".join(chosen[-1])
            if PATTERN.fullmatch(initials):
                found.append((cost, audit))
    return min(found)


def test_brute_force_against_all_edits():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", " "])) for _ in range(rng.randrange(4))]
        assert brute(rows)[:2] == exhaustive(rows)


def brute_report(conversations):
    """Rows of report for (conv_id, turn, role, text) as they are."""
    out = []
    for conv in {c for c, *_ in conversations}:
        rows = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in conversations if c == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        plain = [r[1:] for r in rows]
        marks, turns = faults(plain), [t for t, *_ in rows if t is not None]
        cost, audit, kept = brute(plain)
        initials = [r[:1] for r, _ in plain]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(marks.count(m) for m in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, conversations):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", "Über", None], ["Hi.", "Why?", "so", "", "\t\n", None, "é!", "Go! "]
    rows = []
    for conv, n in conversations:
        rows += [(conv, rng.choice([None, 2**60 + 1, *range(n)]), rng.choice(roles[:2] * 6 + roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(n)}.") for _ in range(n)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("piece", "parts"), [(4096, 1), (1, 3), (3, 4), (50, 2)])
def test_repair_against_brute_force(spark, piece, parts):
    rows = made(piece, [(1, 90), (None, 30), (2**61 + 1, 7), (5, 1), (-3, 2), *((i, 6) for i in range(10, 30))])
    rows += [(1, 4, "user", "same.")] * 20
    conversations = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", audit string, part int").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = repair.report(repair.repair(conversations, piece_rows=piece), conversations).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, got), key=repr) == brute_report(rows)


def test_turns_of_repaired_conversations(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Why?"), (1, 3, "assistant", "So."), (2, 1, "tool", "x.")]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id").collect()
    assert [(r["audit"], [tuple(t) for t in r["turns"]]) for r in got] == [
        ("KIKK", [("user", "Hi."), ("assistant", ""), ("user", "Why?"), ("assistant", "So.")]), ("D", []),
    ]


def test_conversations_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(7, 1, "user", "x")], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.report(repair.repair(empty), some).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert repair.report(repair.repair(empty), empty).collect() == []


def test_damage(spark):
    rows = [(i, t, r, x) for i in [*range(60), None] for t, r, x in ((0, "user", "A. B!"), (None, None, None), (2, "assistant", "C?"))]
    want = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        want += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    sql, got = con.sql(repair.ORACLE), registry.op12_conversation_repair(spark, SF)
    assert got.columns == sql.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(sql.fetchall(), key=repr)
