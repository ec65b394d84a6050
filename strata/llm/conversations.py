"""Repair of the structure of conversations at the least cost.

The roles of a repaired conversation read: nothing, or perhaps a system turn and then one or more times
user, assistant. The edits that lead there are a path through a small graph, and every path is weighed by
one integer: its high digits are the cost, its low digits, of fixed width, are the letters of the edits from
left to right, ended by zeros. The least integer is then the cheapest path and, among equal costs, the one
whose letters come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle

# Rows of one conversation that are looked at together.
PIECE = 1_000

BLANKS = " \t\n\v\f\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")

# The letters of an audit in ASCII order, as digits; 0 stands for the end.
LETTERS = "\0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
BASE = len(LETTERS)
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}

# Places in a conversation: its start, after system, after user, after assistant; what may follow; where it may end.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLES = {"u": "user", "a": "assistant"}
# What it costs at most to come from each place to an end by insertion.
ENDING = (0, 4, 2, 0)
# No place is worth more than this against another: two insertions or, for a system turn that can no longer
# be kept, one deletion and one insertion. A path that is dearer by more than this is never the cheapest.
SLACK = 5
FAR = 10**9


@dataclass(frozen=True)
class Turn:
    """What an edit of a row depends on."""

    initial: str
    fault: str  # "", "blank", "duplicate" or "truncated"

    def edits(self, place: int) -> Iterator[tuple[int, int, int]]:
        """Letter, place after it and cost of every edit of this row at a place."""
        yield DELETE, place, COST[DELETE]
        if self.fault in ("", "truncated"):
            more = int(self.fault == "truncated")
            if (place, self.initial) in NEXT:
                yield KEEP, NEXT[place, self.initial], COST[KEEP] + more
            yield REROLE, NEXT[place, WANTED[place]], COST[REROLE] + more


def classify(rows: Sequence[dict]) -> list[Turn]:
    """Initial and first fault of every row; ``again`` marks rows known to repeat an earlier one."""
    seen, turns = set(), []
    for row in rows:
        role, text = row["role"], row["text"]
        written = text.rstrip(BLANKS)
        if not written:
            fault = "blank"
        elif row["again"] or (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if written[-1] in ENDS else "truncated"
        seen.add((role, text))
        turns.append(Turn(role[:1], fault))
    return turns


def cheapest(turns: Sequence[Turn], place: int = START, after: Sequence[int] | None = None) -> tuple[int, str, int]:
    """Cost, letters and last place of the best way through some rows.

    ``after`` is the cost of what follows from each place; none means that the conversation ends here.
    Nodes are a row, a place and the number of letters so far, which fixes the digit of the next letter.
    More than two insertions in a row lead to a place that fewer lead to.
    """
    width = 3 * len(turns) + 2
    units = [BASE**k for k in range(width - 1, -1, -1)]
    high = BASE**width
    nodes = {(place, 0): 0}

    def with_insertions(nodes: dict) -> dict:
        result, new = dict(nodes), nodes
        for _ in range(2):
            more: dict = {}
            for (at, n), weight in new.items():
                to = (NEXT[at, WANTED[at]], n + 1)
                value = weight + COST[INSERT] * high + INSERT * units[n]
                if value < result.get(to, value + 1):
                    result[to] = more[to] = value
            new = more
        return result

    for turn in turns:
        reached: dict = {}
        for (at, n), weight in with_insertions(nodes).items():
            for letter, to, cost in turn.edits(at):
                value = weight + cost * high + letter * units[n]
                if value < reached.get((to, n + 1), value + 1):
                    reached[to, n + 1] = value
        limit = (min(reached.values()) // high + SLACK + 1) * high
        nodes = {node: weight for node, weight in reached.items() if weight < limit}
    if after is None:
        ends = {node: weight for node, weight in with_insertions(nodes).items() if node[0] in (START, ASSISTANT)}
    else:
        ends = {node: weight + after[node[0]] * high for node, weight in nodes.items()}
    (last, n), weight = min(ends.items(), key=lambda end: end[1])
    cost, digits = divmod(weight, high)
    letters = "".join(LETTERS[digits // unit % BASE] for unit in units[:n])
    return cost - (after[last] if after is not None else 0), letters, last


def least_costs(turns: Sequence[Turn]) -> list[int]:
    """The least cost from each place to each place through some rows, row by row of a matrix."""
    matrix = []
    for start in range(4):
        costs = [FAR] * 4
        costs[start] = 0
        for turn in turns:
            for _ in range(2):
                for at in range(4):
                    to = NEXT[at, WANTED[at]]
                    costs[to] = min(costs[to], costs[at] + COST[INSERT])
            found = [FAR] * 4
            for at in range(4):
                for _, to, cost in turn.edits(at):
                    found[to] = min(found[to], costs[at] + cost)
            costs = [min(cost, FAR) for cost in found]
        matrix += costs
    return matrix


def apply(rows: Sequence[dict], letters: str, place: int = START) -> list[dict]:
    """The rows after the edits."""
    result, at = [], iter(rows)
    for letter in letters:
        if letter == "I":
            role, text = ROLES[WANTED[place]], ""
        else:
            row = next(at)
            if letter == "D":
                continue
            role, text = (row["role"] if letter == "K" else ROLES[WANTED[place]]), row["text"]
        result.append({"role": role, "text": text})
        place = NEXT[place, role[:1]]
    return result


TURNS = "array<struct<role:string,text:string,again:boolean>>"
EDITED = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired array<struct<role:string,text:string>>"


def _records(batch: pa.RecordBatch) -> Iterator[tuple[dict, list[Turn]]]:
    for record in batch.to_pylist():
        yield record, classify(record["turns"])


def _edited(record: dict, turns: list[Turn], cost: int, letters: str, place: int = START) -> dict:
    counts = {fault: sum(t.fault == fault for t in turns) for fault in ("blank", "duplicate", "truncated")}
    pairs = zip(turns, turns[1:])
    return counts | {
        "illegal": record.get("crossing", 0) + sum(a.initial + b.initial not in LEGAL for a, b in pairs),
        "cost": cost,
        "audit": letters,
        "repaired": apply(record["turns"], letters, place),
    }


def _mapped(df: DataFrame, function, passed: Sequence[str], added: str) -> DataFrame:
    """Add to the columns ``passed`` what ``function`` gives for a row and its turns."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in passed), added])
    arrow = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{c: record[c] for c in passed} | function(record, turns) for record, turns in _records(batch)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return df.mapInArrow(run, schema)


def _whole(rows: DataFrame) -> DataFrame:
    """Conversations of at most one piece, edited."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    turns = F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), F.lit(False).alias("again")))
    pieces = rows.groupBy("key").agg(F.lit(0).cast("bigint").alias("piece"), turns.cast(TURNS).alias("turns"))

    def edit(record: dict, turns: list[Turn]) -> dict:
        cost, letters, _ = cheapest(turns)
        return _edited(record, turns, cost, letters)

    return _mapped(pieces, edit, ["key", "piece"], EDITED)


def _backward(pieces: pd.DataFrame) -> pd.DataFrame:
    """For every piece of one conversation: what follows costs from each place, and whether its first pair is illegal."""
    pieces = pieces.sort_values("piece")
    after, costs = list(ENDING), []
    for matrix in reversed(pieces["matrix"].tolist()):
        costs.append(after)
        after = [min(FAR, *(int(matrix[4 * at + to]) + after[to] for to in range(4))) for at in range(4)]
    pairs = pieces["tail"].shift(fill_value="") + pieces["head"]
    crossing = (~pairs.isin(LEGAL)).astype("int64")
    crossing.iloc[0] = 0
    last = [False] * (len(pieces) - 1) + [True]
    return pd.DataFrame(
        {"key": pieces["key"], "piece": pieces["piece"], "after": costs[::-1], "crossing": crossing, "last": last}
    )


def _forward(pieces: pd.DataFrame) -> pd.DataFrame:
    """The place at which every piece of one conversation begins."""
    pieces = pieces.sort_values("piece")
    place, places = START, []
    for lasts in pieces["lasts"]:
        places.append(place)
        place = int(lasts[place])
    return pd.DataFrame({"key": pieces["key"], "piece": pieces["piece"], "place": places})


def _in_pieces(rows: DataFrame, size: int) -> DataFrame:
    """Longer conversations, edited piece by piece.

    All rows are sorted in ranges, so a conversation lies on as many tasks as it needs. A piece gives the
    least costs between places; these are added up from the end of a conversation, whereupon every piece
    finds its best way from each place; the ways are then strung together from the start. Only these few
    numbers a piece of a conversation ever meet in one task.
    """
    order = [F.asc_nulls_first("key"), F.asc_nulls_first("turn"), "role", "text", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = placed.select("key", "role", "text", digest.alias("digest"), F.monotonically_increasing_id().alias("at"))
    placed = settle(placed, "turns")
    first = settle(placed.groupBy("key", "digest").agg(F.min("at").alias("first")), "first-turns")
    turn = F.struct("at", "role", "text", (F.col("at") > F.col("first")).alias("again"))
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), x["again"].alias("again")))
    pieces = placed.join(first, ["key", "digest"]).groupBy("key", F.floor(F.col("at") / size).alias("piece"))
    pieces = settle(pieces.agg(turns.cast(TURNS).alias("turns")), "pieces")

    def measure(record: dict, turns: list[Turn]) -> dict:
        return {"head": turns[0].initial, "tail": turns[-1].initial, "matrix": least_costs(turns)}

    measured = _mapped(pieces, measure, ["key", "piece"], "head string, tail string, matrix array<bigint>")
    known = measured.groupBy("key").applyInPandas(
        _backward, "key string, piece bigint, after array<bigint>, crossing bigint, last boolean"
    )
    known = pieces.join(settle(known, "costs"), ["key", "piece"])

    def ways(record: dict, turns: list[Turn]) -> dict:
        found = [cheapest(turns, place, None if record["last"] else record["after"]) for place in range(4)]
        return {name: [way[i] for way in found] for i, name in enumerate(("costs", "audits", "lasts"))}

    found = _mapped(known, ways, ["key", "piece", "crossing"], "costs array<bigint>, audits array<string>, lasts array<bigint>")
    found = settle(found, "ways")
    places = found.select("key", "piece", "lasts").groupBy("key").applyInPandas(_forward, "key string, piece bigint, place bigint")
    chosen = pieces.join(found.join(settle(places, "places"), ["key", "piece"]), ["key", "piece"])

    def edit(record: dict, turns: list[Turn]) -> dict:
        place = record["place"]
        return _edited(record, turns, record["costs"][place], record["audits"][place], place)

    return _mapped(chosen, edit, ["key", "piece"], EDITED)


def _rows(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    return conversations.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("key"),
        F.col(turn_col).cast("bigint").alias("turn"),
        text(role_col).alias("role"),
        text(text_col).alias("text"),
    )


def repair(
    conversations: DataFrame,
    *,
    piece: int = PIECE,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``(summary, pieces)``: a row a conversation, and its repaired turns in pieces.

    Rows are taken by turn, those without one first, equal turns by role and text. The first fault of a
    row counts: blank, a role and text seen earlier, or a last mark other than ``.!?``. Edits are Keep (0),
    Rerole to user or assistant (2), Delete (3, and asked for where a row is blank or a duplicate) and Insert
    of a user or assistant turn without text (2); a truncated row that stays adds 1. The roles' initials
    then read ``(s?(ua)+)?``; of equally cheap ways the audit that comes first in ASCII is taken.

    The summary has ``id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``: turns
    missing between the least and the greatest, rows by fault, neighbouring roles out of order, cost, the
    edits' initials, and the digest of the lines ``role:text`` of all repaired turns. ``pieces`` has ``key``
    (the id as text after ``=``, empty for NULL), ``piece`` and ``repaired``, the turns in order.

    A conversation of over ``piece`` rows is edited in pieces spread over the tasks, with the same result; only its
    digest, which is sequential by nature, is worked out in one task, a piece at a time. A NULL role or text counts
    as one blank; rows with a NULL id are one conversation; a row given twice is a duplicate. An empty table
    gives no rows. Columns not named are ignored.
    """
    rows = _rows(conversations, id_col, turn_col, role_col, text_col)
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()), "conversations")
    sizes = rows.groupBy("key").agg(
        F.first("id").alias("id"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
    )
    sizes = settle(sizes, "sizes")
    long = sizes.where(F.col("n") > piece).select("key")
    if long.isEmpty():
        pieces = settle(_whole(rows), "repaired")
    else:
        short = _whole(rows.join(long, "key", "left_anti"))
        pieces = settle(short.unionByName(_in_pieces(rows.join(long, "key", "left_semi"), piece)), "repaired")
    lines = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    text = F.array_join(lines, "\n")
    alone = pieces.withColumn("alone", F.col("piece") == 0) if long.isEmpty() else pieces.join(
        long.withColumn("alone", F.lit(False)), "key", "left"
    ).withColumn("alone", F.coalesce("alone", F.lit(True)))
    summed = alone.groupBy("key").agg(
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        F.max(F.when(F.col("alone"), F.sha2(text, 256))).alias("sha256"),
    )
    if not long.isEmpty():
        written = alone.where(~F.col("alone") & (F.size("repaired") > 0)).select("key", "piece", text.alias("text"))
        hashed = written.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(_digests, "key string, long_sha256 string")
        summed = summed.join(hashed, "key", "left").withColumn("sha256", F.coalesce("sha256", "long_sha256")).drop("long_sha256")
    empty = hashlib.sha256().hexdigest()
    summary = sizes.drop("n").join(summed, "key").drop("key")
    return summary.withColumn("repaired_sha256", F.coalesce("sha256", F.lit(empty))).drop("sha256"), pieces


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's texts, joined by line ends; rows come in order of key."""
    last, digest = None, hashlib.sha256()

    def ended() -> pa.RecordBatch:
        return pa.record_batch({"key": [last], "long_sha256": [digest.hexdigest()]})

    for batch in batches:
        for key, text in zip(batch["key"], batch["text"]):
            if key.as_py() != last:
                if last is not None:
                    yield ended()
                last, digest = key.as_py(), hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(text.as_py().encode())
    if last is not None:
        yield ended()
