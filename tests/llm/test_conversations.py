"""Repair of conversations, held to all ways of editing."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF_DIR
from strata.llm import conversations, queries

LEGAL = re.compile(r"(s?(ua)+)?")


def ways(rows):
    """All edits of some rows with their cost, audit and rows, with insertions of up to two between rows."""
    inserted = [[]] + [[("I", 2, role, "")] for role in ("user", "assistant")]
    inserted += [a + b for a in inserted[1:] for b in inserted[1:]]
    choices = [inserted]
    for role, text, fault in rows:
        more = int(fault == "truncated")
        edits = [[("D", 3, None, None)]]
        if fault in ("", "truncated"):
            edits += [[("K", more, role, text)], [("R", 2 + more, "user", text)], [("R", 2 + more, "assistant", text)]]
        choices += [edits, inserted]
    for way in itertools.product(*choices):
        steps = [step for part in way for step in part]
        kept = [step for step in steps if step[0] != "D"]
        if LEGAL.fullmatch("".join(role[:1] or "?" for _, _, role, _ in kept)):
            yield sum(s[1] for s in steps), "".join(s[0] for s in steps), [(s[2], s[3]) for s in kept]


def faults(rows):
    seen, result = set(), []
    for role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
        seen.add((role, text))
        result.append((role, text, fault))
    return result


def repaired(rows):
    """The columns of the summary for ``(turn, role, text)`` rows, by trying everything."""
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
    judged = faults([row[1:] for row in rows])
    turns = [row[0] for row in rows if row[0] is not None]
    cost, audit, kept = min(ways(judged), key=lambda way: way[:2])
    lines = "\n".join(f"{role}:{text}" for role, text in kept)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{fault: sum(row[2] == fault for row in judged) for fault in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest(),
    }


def drawn_rows(drawn, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "no", " ", "", None, "What? ", "a.", "b.", "c.", "d"]
    return [(drawn.choice([None, 0, 1, 2, 3, 5]), drawn.choice(roles), drawn.choice(texts)) for _ in range(n)]


SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, piece string, id string, row string"


def test_small_conversations(spark):
    drawn = random.Random(3)
    known = {conv: drawn_rows(drawn, conv % 5) for conv in range(1, 60) if conv % 5} | {None: drawn_rows(drawn, 4)}
    rows = [(conv, *row, "k", "p", "i", "r") for conv, turns in known.items() for row in turns]
    summary, _ = conversations.repair(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = {row["id"]: row.asDict() for row in summary.collect()}
    assert got == {conv: {"id": conv} | repaired(turns) for conv, turns in known.items()}


def unlimited(turns):
    """Cost and audit by keeping every best text of edits a place and length, without weights or limits."""
    best = {(conversations.START, 0): (0, "")}

    def inserted(best):
        for _ in range(2):
            for (at, n), (cost, audit) in list(best.items()):
                to = (conversations.NEXT[at, conversations.WANTED[at]], n + 1)
                best[to] = min(best.get(to, (10**9, "")), (cost + 2, audit + "I"))
        return best

    for turn in turns:
        new = {}
        for (at, n), (cost, audit) in inserted(best).items():
            for letter, to, more in turn.edits(at):
                way = (cost + more, audit + conversations.LETTERS[letter])
                new[to, n + 1] = min(new.get((to, n + 1), way), way)
        best = new
    return min(way for (at, _), way in inserted(best).items() if at in (0, 3))


@pytest.mark.parametrize("seed", range(40))
def test_weights_and_pieces_give_the_first_cheapest_way(seed):
    drawn = random.Random(seed)
    letters = drawn.choice(["sua", "ua", "s", "suax", "uuua", "saaa"])
    turns = [conversations.Turn(drawn.choice(letters), drawn.choice(["", "", "", "truncated", "blank"])) for _ in range(40)]
    cost, audit, _ = conversations.cheapest(turns)
    assert (cost, audit) == unlimited(turns)


def test_pieces_equal_whole_conversations(spark):
    drawn = random.Random(8)
    rows = []
    for conv in (None, *range(12)):
        for turn in range(drawn.choice([3, 30, 200])):
            role = drawn.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            text = drawn.choice([f"t{drawn.randint(0, 40)}.", f"cut {turn}", "", f"Good {turn}!"])
            rows.append((conv, drawn.choice([turn, None]), role, text, "k", "p", "i", "r"))
    rows += [(11, 7, "user", "the same turn.", "k", "p", "i", "r")] * 300  # a third of all rows are one
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    whole, _ = conversations.repair(df)
    cut, pieces = conversations.repair(df, piece=9)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.select(whole.columns).collect()))
    assert pieces.where("size(repaired) > 27").count() == 0
    # every piece of a conversation together is the text behind the digest
    lines = {}
    for row in pieces.orderBy("key", "piece").collect():
        lines.setdefault(row["key"], []).extend(f"{turn['role']}:{turn['text']}" for turn in row["repaired"])
    digests = {"" if row["id"] is None else f"={row['id']}": row["repaired_sha256"] for row in cut.collect()}
    assert digests == {key: hashlib.sha256("\n".join(found).encode()).hexdigest() for key, found in lines.items()}


def test_no_conversations(spark):
    summary, pieces = conversations.repair(spark.createDataFrame([], SCHEMA))
    assert (summary.count(), pieces.count()) == (0, 0)


def damaged(conv, turn, role, text):
    name = lambda value: " " if value is None else str(value)
    kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
    text = "" if kind == 1 else re.sub(r"[.!?]", "", name(text)) if kind == 2 else name(text)
    return [] if kind == 0 else [(turn, "user" if kind == 4 else name(role), text)] * (2 if kind == 3 else 1)


def test_conversation_query(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    known = {}
    for row in table.collect():
        known.setdefault(row["conv_id"], []).extend(damaged(*row))
    got = {row["conv_id"]: row.asDict() for row in queries.QUERIES["op12_conversations"](spark, SF_DIR).collect()}
    assert set(got) == set(known)
    for conv, rows in known.items():
        if len(rows) <= 4:
            assert got[conv] == {"conv_id": conv} | repaired(rows)
        else:
            rows.sort(key=lambda row: row[0])
            turns = [conversations.Turn(role[:1], fault) for role, _, fault in faults([row[1:] for row in rows])]
            assert (got[conv]["cost"], got[conv]["audit"]) == unlimited(turns)
