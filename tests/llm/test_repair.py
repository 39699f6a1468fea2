"""Conversation repair against a plain row-by-row version and an exhaustive search over edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from conftest import TINY
from vigil.llm import repair
from vigil.llm.queries import CATALOGUE

WHITE = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string, score double, first string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 0:
            continue
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub(r"[.!?]", "", text)
        if d == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if d == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _conv, _turn, role, text in rows:
        if not WHITE.search(text):
            f = "b"
        elif (role, text) in seen:
            f = "d"
        else:
            marks = WHITE.findall(text)
            f = "t" if marks[-1] not in ".!?" else "c"
        seen.add((role, text))
        out.append(f)
    return out


def plain(rows):
    """Per conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha) by a row-by-row DP."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damage(rows):
        convs[r[0]].append(r)
    result = {}
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        fs = faults(rs)
        turns = {r[1] for r in rs if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        inits = [r[2][:1] for r in rs]
        illegal = sum(a + b not in {"su", "ua", "au"} for a, b in zip(inits, inits[1:]))
        n = len(rs)
        INF = 1 << 40
        cost = [[INF] * 4 for _ in range(n + 1)]
        cost[n] = list(repair.FINAL)
        for i in range(n - 1, -1, -1):
            for _ in range(3):  # inserts reach a fixed point within three rounds
                for s in range(4):
                    best = min(c + cost[i + 1][t] for _, t, c in repair.actions(s, inits[i], fs[i]))
                    best = min(best, repair.INSERT + cost[i][repair.NEXT[s]])
                    cost[i][s] = min(cost[i][s], best)
        state, edits, i = 0, [], 0
        while i < n or repair.FINAL[state] > 0:
            options = []
            if i < n:
                options += [(e, t, c + cost[i + 1][t], True) for e, t, c in repair.actions(state, inits[i], fs[i])]
            options.append(("I", repair.NEXT[state], repair.INSERT + (cost[i][repair.NEXT[state]] if i < n else repair.FINAL[repair.NEXT[state]]), False))
            target = cost[i][state] if i < n else repair.FINAL[state]
            e, t, _, moves = min(o for o in options if o[2] == target)
            edits.append((e, i if moves else None, t))
            state = t
            i += moves
        lines = []
        for e, i, t in edits:
            if e == "K":
                lines.append(f"{rs[i][2]}:{rs[i][3]}")
            elif e == "R":
                lines.append(f"{repair.NAME[t]}:{rs[i][3]}")
            elif e == "I":
                lines.append(f"{repair.NAME[t]}:")
        result[conv] = (gaps, fs.count("b"), fs.count("d"), fs.count("t"), illegal, cost[0][0] if n else 0,
                        "".join(e for e, _, _ in edits), hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def exhaustive(symbols):
    """Cheapest (cost, audit) over all edit sequences with at most two inserts before each row and at the end."""
    best = None
    per_row = []
    for initial, fault in symbols:
        per_row.append([e for e in "DKR" if not (fault in "bd" and e != "D")])
    for choice in itertools.product(*per_row):
        for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
            state, cost, audit, ok = 0, 0, "", True
            for k in range(len(symbols) + 1):
                for _ in range(inserts[k]):
                    state, cost, audit = repair.NEXT[state], cost + repair.INSERT, audit + "I"
                if k == len(symbols):
                    break
                (initial, fault), e = symbols[k], choice[k]
                extra = repair.UNFINISHED if fault == "t" and e != "D" else 0
                if e == "D":
                    cost += repair.DELETE
                elif e == "K":
                    if (state, initial) not in repair.LEGAL:
                        ok = False
                        break
                    state = repair.LEGAL[(state, initial)]
                else:
                    state, cost = repair.NEXT[state], cost + repair.REROLE
                cost += extra
                audit += e
            if ok and state in repair.ACCEPTING and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_run_length_walk_equals_exhaustive_search():
    rng = random.Random(7)
    rules = repair.Rules()
    for _ in range(150):
        symbols = [(rng.choice("suax"), rng.choice("cctbd")) for _ in range(rng.randint(0, 5))]
        units = [("sys" if i == "s" else "usr" if i == "u" else "ast" if i == "a" else "x", f"t{k}", 1, f, "d") for k, (i, f) in enumerate(symbols)]
        cost, audit, _ = repair._solve_whole(rules, units)
        assert (cost, audit) == exhaustive(symbols)


def test_long_runs_equal_the_plain_version(spark):
    rows = [(1, t, "user", "same text.") for t in range(300)] + [(1, 300 + t, "assistant", f"no end {t}") for t in range(200)]
    rows += [(2, t, ["system", "user", "assistant"][t % 3], f"x{t}.") for t in range(400)]
    check(rows, None, spark)
    check(rows, 5, spark)


def check(rows, partitions, spark):
    df = spark.createDataFrame([(*r, 0.5, "clash") for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(df, partitions).collect()}
    assert got == plain(rows)


def test_whole_table_equals_the_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TINY}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in CATALOGUE["op12_repair"](spark, TINY).collect()}
    assert got == plain(rows)


def test_hot_conversation_over_many_partitions(spark):
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "user", "assistant", None, "tool"]
    rows = [(7, rng.randint(0, 900), rng.choice(roles), rng.choice(["Hi.", "Hi", "ok!", " ", None, "why?", "sure"])) for _ in range(3000)]
    rows += [(c, t, rng.choice(roles), rng.choice(["a.", "b", ""])) for c in range(20) for t in range(5)]
    rows += [(None, 1, "user", "q?"), (None, None, "assistant", "a."), (8, None, None, None)]
    check(rows, 13, spark)


def test_empty_and_fully_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty).count() == 0
    # a conversation whose only row is dropped by the damage rule keeps zeros and the empty hash
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repair(spark.createDataFrame([(dropped, 0, "user", "x.", 1.0, "y")], SCHEMA)).collect()[0]
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", repair.EMPTY_SHA)
