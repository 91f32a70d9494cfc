"""Conversation structure repair (operator 13): cheapest edits, least audit by prefix-doubling ranks.

A conversation should hold the roles ``(s?(ua)+)?`` (an optional system turn, then user and
assistant in turn). Each row is kept, given the other role, or deleted; rows may be inserted. Costs are
in ``COSTS``; of equally cheap edits those with the ASCII-least audit (the edits' initials) are taken.

1. Rows are dealt by ranges of (conversation, turn, role, digest of the text, copy) and stored in that
   order with a running number, so a long conversation is spread over many files.
2. A row's first fault is found: blank, duplicate (by the digest of role and text: the first number per
   digest is counted before the shuffle), truncated. Role initial and fault make one letter a row.
3. Every range packs its letters into one string per conversation; the strings of a conversation
   are joined to its code. All that follows depends on the code only.
4. Cost DP, backwards: for each node (rows done, state of the roles) the cost still to come. Arcs that
   reach it are optimal; they form an acyclic graph.
5. Prefix doubling over all conversations of a batch: nodes are ranked by the least first edit,
   then by pairs (own rank, rank of the node 2, 4, 8 ... edits ahead), with pointers
   doubled each time. An edit leads from a node to one other node, so a node has one pointer per
   power. Ranks choose the least path; it is read off the doubled pointers.
6. The repaired turns are hashed while the stored rows stream by in order, next to the conversation's audit.

A conversation's code and audit take a byte a row, which the audit's cell takes as well. Texts are never gathered: only
the running hash is held. The hash of one conversation is by nature made by one task.

Defined results: null role and text count as one space, a null id or turn as one space in the damage key;
a null id is a conversation of its own; null turns come first; rows of equal turn are ordered by role,
then by the digest of role and text; repeated rows are rows of their own (and duplicates); a conversation without
rows after damage has zeros, an empty audit and the hash of the empty string; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved

#: Fixed by the contract: costs of the edits, and of leaving a truncated row.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
#: States of the roles so far: nothing, after system, after user, after assistant; and the role due in each.
START, SYSTEM, USER, ASSISTANT = range(4)
DUE, AFTER = (USER, USER, ASSISTANT, USER), {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Letters of a code: role initial (o: any other) and fault as one character.
FAULTS = ("none", "truncated", "blank", "duplicate")
LETTERS = {(r, f): chr(65 + 4 * i + j) for i, r in enumerate("suao") for j, f in enumerate(FAULTS)}
LETTER_OF = {v: k for k, v in LETTERS.items()}
EDITS = "DIKR"  # in ASCII order
FAR = np.int64(2**60)
RANGE_ROWS = 200_000


def damaged(turns: DataFrame, key: Column | None = None) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn``: conv, turn, role, text, copy (0 or 1)."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20) if key is None else key
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("_kind")).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
                       F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))


def stored(rows: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (conv, turn, role, text, copy) in order, with ``part`` and ``pos``, which grows with the order."""
    digest = F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"), 256)
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(core == "", "blank").when(~F.right(core, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("none")
    rows = rows.withColumn("digest", F.unhex(digest)).withColumn("fault", fault)
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "digest", "copy"]
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // range_rows))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return saved(ranged.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()), "turns")


def codes(rows: DataFrame) -> DataFrame:
    """One row per conversation: its letters by range and what the ranges hold of its turns."""
    slim = rows.select("conv", "turn", "part", "pos", "digest", "fault", F.left("role", F.lit(1)).alias("initial"))
    firsts = slim.groupBy("conv", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv").alias("_conv"), F.col("digest").alias("_digest"), "first")
    slim = slim.join(firsts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    fault = F.when((F.col("fault") != "blank") & (F.col("pos") > F.col("first")), "duplicate").otherwise(F.col("fault"))
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = F.create_map(*[F.lit(x) for (r, f), c in LETTERS.items() for x in (r + f, c)])[F.concat(role, fault)]
    # a group here is bounded by its range
    held = F.sort_array(F.collect_list(F.struct("pos", letter.alias("letter"))))
    strings = slim.groupBy("conv", "part").agg(
        F.array_join(held["letter"], "").alias("code"), F.min("turn").alias("least"), F.max("turn").alias("most"),
        F.count_distinct("turn").alias("turns"))
    return strings.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "code", "least", "most", "turns"))).alias("ranges"))


def gaps(ranges: list[dict]) -> int:
    """Turns missing between the first and the last one; ranges of one conversation in order."""
    ranges = [r for r in ranges if r["turns"]]
    if not ranges:
        return 0
    shared = sum(a["most"] == b["least"] for a, b in zip(ranges, ranges[1:]))
    return ranges[-1]["most"] - ranges[0]["least"] + 1 - sum(r["turns"] for r in ranges) + shared


def arcs(code: str) -> tuple[np.ndarray, np.ndarray]:
    """For every node (row * 4 + state) and edit of EDITS: the node it leads to (-1: none) and its cost."""
    n = len(code)
    to, cost = np.full((4 * (n + 1), 4), -1, np.int64), np.zeros((4 * (n + 1), 4), np.int64)
    rows = 4 * np.arange(n + 1)
    letters = [LETTER_OF[c] for c in code]
    due = np.array(DUE)
    insert, delete, keep, rerole = (EDITS.index(e) for e in "IDKR")
    bound = np.array([f in ("blank", "duplicate") for _, f in letters], bool)
    short = np.array([f == "truncated" for _, f in letters], np.int64) * TRUNCATED
    after = np.array([AFTER.get(r, -1) for r, _ in letters], np.int64)
    for state in range(4):
        to[rows + state, insert], cost[rows + state, insert] = rows + due[state], COSTS["I"]
        here, there = rows[:-1] + state, rows[1:]
        to[here, delete], cost[here, delete] = there + state, COSTS["D"]
        to[here, rerole], cost[here, rerole] = np.where(bound, -1, there + due[state]), COSTS["R"] + short
        fits = ~bound & ((after == due[state]) | ((after == SYSTEM) & (state == START)))
        to[here, keep], cost[here, keep] = np.where(fits, there + after, -1), COSTS["K"] + short
    return to, cost


def costs_to_come(to: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Least cost from each node to a complete conversation, rows backwards; inserts are settled within a row."""
    nodes = len(to)
    ahead = [0] * nodes
    targets, prices = to.tolist(), cost.tolist()
    insert = EDITS.index("I")
    for row in range(nodes - 4, -1, -4):
        last = row == nodes - 4
        for v in range(row, row + 4):
            ways = [prices[v][e] + ahead[w] for e, w in enumerate(targets[v]) if w >= 0 and e != insert]
            ahead[v] = min(ways, default=int(FAR))
            if last and v - row in (START, ASSISTANT):
                ahead[v] = 0
        for _ in range(3):  # an insert can lead on to another, through three states at most
            for v in range(row, row + 4):
                ahead[v] = min(ahead[v], prices[v][insert] + ahead[targets[v][insert]])
    return np.array(ahead, np.int64)


def least_paths(found: list[str]) -> list[tuple[int, str]]:
    """Cost and least audit of each code; nodes of all codes are ranked together."""
    tos, ends, starts, costs, at = [], [], [], [], 0
    for code in found:
        to, price = arcs(code)
        ahead = costs_to_come(to, price)
        optimal = (to >= 0) & (price + ahead[to] == ahead[:, None]) & (ahead < FAR)[:, None]
        tos.append(np.where(optimal, to + at, -1))
        done = np.zeros(len(to), bool)
        done[[len(to) - 4 + START, len(to) - 4 + ASSISTANT]] = True
        ends.append(done)
        starts.append(at)
        costs.append(int(ahead[START]))
        at += len(to)
    if not found:
        return []
    to, end = np.concatenate(tos), np.concatenate(ends)
    nodes = np.arange(at)
    stop = end | (to < 0).all(axis=1)  # an audit ends here
    # length 1: the least edit; an ended audit ranks before any that goes on
    edit = np.where(stop, -1, (to >= 0).argmax(axis=1))
    pointer, rank = np.where(stop, nodes, to[nodes, edit]), edit + 1
    pointers, length = [pointer], 1
    longest = 4 * max(len(c) for c in found) + 4
    while length < longest and not stop[pointer].all():
        pair = rank * (int(rank.max()) + 1) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
        length *= 2
    # the ranks' choice among a node's optimal arcs
    choice = np.where(to >= 0, np.arange(4) * (int(rank.max()) + 1) + rank[to], np.iinfo(np.int64).max).argmin(axis=1)
    path = np.array(starts)[:, None]
    for p in pointers:
        path = np.concatenate([path, p[path]], axis=1)
    letters = np.frombuffer((EDITS + " ").encode(), np.uint8)
    audits = letters[np.where(stop[path], 4, choice[path])]
    return [(c, a.tobytes().decode().rstrip()) for c, a in zip(costs, audits)]


def batches_of(found: list[str], letters: int = 200_000) -> Iterator[list[str]]:
    """Codes of like length together, so that paths of one batch take room alike."""
    group, size = [], 0
    for code in sorted(found, key=len):
        if group and (len(group) + 1) * (len(code) + 1) > letters:
            yield group
            group = []
        group.append(code)
    if group:
        yield group


def audited(ranges: DataFrame) -> DataFrame:
    """Counts, cost and audit per conversation."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        faults = {f: "".join(c for (_, g), c in LETTERS.items() if g == f) for f in FAULTS}
        for batch in batches:
            convs, lists = batch.column(0), batch.column(1).to_pylist()
            full = ["".join(r["code"] for r in x) for x in lists]
            by_code = {}
            for group in batches_of(list(set(full))):
                by_code.update(zip(group, least_paths(group)))
            cols = [[gaps(x) for x in lists]]
            cols += [[sum(map(c.count, faults[f])) for c in full] for f in ("blank", "duplicate", "truncated")]
            roles = ["".join(LETTER_OF[x][0] for x in c) for c in full]
            cols += [[sum(a + b not in ("su", "ua", "au") for a, b in zip(r, r[1:])) for r in roles]]
            cols += [[by_code[c][0] for c in full]]
            yield pa.RecordBatch.from_arrays([convs, *(pa.array(c, pa.int64()) for c in cols), pa.array([by_code[c][1] for c in full], pa.string())], names)

    kind = ranges.schema["conv"].dataType.simpleString()
    return ranges.mapInArrow(audit, f"conv {kind}, " + ", ".join(f"{n} long" for n in names[1:-1]) + ", audit string")


class Turns:
    """Repaired turns of one conversation, made from its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _due(self) -> str:
        self.state = DUE[self.state]
        return "user" if self.state == USER else "assistant"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._due(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._due(), text
        elif edit == "K":
            self.state = AFTER[role[0]]
            yield role, text


def repaired(rows: DataFrame, audits: DataFrame, originals: DataFrame) -> DataFrame:
    """Counts, cost and audit with the repaired conversation's hash; ``originals``: one row per conversation (conv).

    Audits and rows of a conversation meet in one task, the audit first, and stream by.
    """
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = [F.lit(None).cast("long").alias(c) for c in counts]
    text = lambda v=None: F.lit(v).cast("string")
    first = originals.select("conv", F.lit(-2).cast("long").alias("pos"), *none, text("").alias("role"), text("").alias("text"))
    second = audits.select("conv", F.lit(-1).cast("long").alias("pos"), *counts, text().alias("role"), F.col("audit").alias("text"))
    third = rows.select("conv", "pos", *none, "role", "text")
    stream = first.unionByName(second).unionByName(third)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = stream.repartition(parts, "conv").sortWithinPartitions(F.asc_nulls_first("conv"), "pos")
    names = ["conv", *counts, "audit", "repaired_sha256"]
    kind = rows.schema["conv"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], None  # now: [conv, counts, Turns, hash, turns so far]

        def add(turns: Iterator[tuple[str, str]]) -> None:
            for role, words in turns:
                now[3].update(("\n" * (now[4] > 0) + f"{role}:{words}").encode())
                now[4] += 1

        def close() -> None:
            if now is not None:
                add(now[2].inserted())
                out.append((now[0], *now[1], now[2].audit, now[3].hexdigest()))

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

        types = None
        for batch in batches:
            types = types or [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            convs, pos = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (conv, p) in enumerate(zip(convs, pos)):
                if p == -2:
                    close()
                    now = [conv, [0] * 6, Turns(""), hashlib.sha256(), 0]
                elif p == -1:
                    now[1], now[2] = [batch.column(c)[i].as_py() for c in range(2, 8)], Turns(batch.column(9)[i].as_py())
                else:
                    add(now[2].row(batch.column(8)[i].as_py(), batch.column(9)[i].as_py()))
            if out:
                yield table()
                out = []
        close()
        if out:
            yield table()

    return stream.mapInArrow(hashed, f"conv {kind}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")


def repair(rows: DataFrame, originals: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Repair conversations given as rows (conv, turn, role, text, copy); see ``damaged`` for the contract's."""
    rows = stored(rows, range_rows)
    return repaired(rows, audited(codes(rows)), originals)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair(damaged(turns), turns.select(F.col("conv_id").alias("conv")).distinct())
    return found.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
