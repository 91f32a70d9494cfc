import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from churnlab.llm import turn_repair as T

SPACES = "[\x20\x09-\x0D]"
SCHEMA = "conv_id long, turn int, role string, text string"


def least(rows):
    """Least (cost, audit) and the turns it leaves; rows are (role, text, fault). Cheapest first, then least audit."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        due = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[due]
        heapq.heappush(heap, (cost + 2, audit + "I", i, due, (*out, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                heapq.heappush(heap, (more + 2, audit + "R", i + 1, due, (*out, f"{name}:{text}")))
                if role[:1] == due or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))


def plain(table):
    """The contract, row by row."""
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        digest = hashlib.sha256(f"{role}\0{text}".encode()).digest()
        convs[conv] += [((turn is not None, turn or 0), role, digest, copy, text) for copy in range(2 if kind == 3 else 1)]
    want = {}
    for conv, rows in convs.items():
        rows.sort()
        seen, faulty = set(), []
        for _, role, digest, _, text in rows:
            core = re.sub(f"{SPACES}+\\Z", "", text)
            fault = "blank" if not core else "duplicate" if digest in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add(digest)
            faulty.append((role, text, fault))
        turns = [t[1] for t, *_ in rows if t[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == x for *_, f in faulty) for x in ("blank", "duplicate", "truncated")]
        illegal = sum((a[0][:1], b[0][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(faulty, faulty[1:]))
        cost, audit, out = least(faulty)
        want[conv] = (conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return want


def run(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("conv", "pos", "part", "_kind", "digest", "copy"):
            df = df.selectExpr("*", f"'x' as {c}")
    from pyspark.sql import functions as F
    found = T.repair(T.damaged(df), df.select(F.col("conv_id").alias("conv")).distinct(), range_rows=50)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len({g[0] for g in got})
    return {g[0]: g for g in got}


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r) for r in T.op13_turn_repair(spark, path).collect()}
    assert got == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "", None, "tool", "ugly", "é", "User"]
    texts = ["Good.", "So?", "no end", "", None, " \t\n", "x. \x0b", "y ", "Good.", "z!　", "a.b.c"]
    rows = [(c, rng.choice([None, *range(6), 9, -4]), rng.choice(roles), rng.choice(texts)) for c in range(150) for _ in range(rng.randint(1, 9))]
    rows += [(None, t, "user", "no id.") for t in range(4)] + [(500, None, None, None)] * 3 + [(501, 0, "user", "w " * 100_000 + ".")] * 2
    rows += [(-3, t % 97, roles[t % 3], texts[t % 3] + str(t % 200)) for t in range(3000)]  # over many ranges
    assert run(spark, rows, extra=True) == plain(rows)


def test_every_row_dropped_and_empty_table(spark):
    drop = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert run(spark, [(7, drop, "user", "x")])[7] == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert run(spark, []) == {}


@pytest.mark.parametrize("seed", range(4))
def test_ranks_find_the_least_path(seed):
    rng = random.Random(seed)
    codes = ["", *("".join(rng.choices(list(T.LETTERS.values()), k=rng.randint(1, 12))) for _ in range(800)),
             "".join(rng.choices(list(T.LETTERS.values()), k=400))]
    rows = lambda c: [({"o": "tool"}.get(r, r), "", "" if f == "none" else f) for r, f in map(T.LETTER_OF.get, c)]
    assert T.least_paths(codes) == [least(rows(c))[:2] for c in codes]
