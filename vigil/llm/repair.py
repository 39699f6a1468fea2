"""Conversation structure repair by a run-length min-plus DP.

A conversation after damage is a sequence of rows, each a symbol (role initial, fault). The cheapest edits that give role
initials ``(s?(ua)+)?`` follow a four-state automaton (start, after system, after user, after assistant). One row with
the inserts before it moves a cost vector by a 4 x 4 min-plus matrix of its symbol. Equal consecutive symbols collapse
into runs; a run of length L moves by M^L, made from cached binary powers M, M^2, M^4, ... of its symbol. The cost-to-go
vectors before every run then let the walk go forward and take, at each row, the ASCII-least edit that stays optimal
(Delete < Insert < Keep < Rerole); inside a run the vectors are normalised and repeat after a few rows, so they are kept
only up to the first repeat.

Scale: rows are pre-aggregated (equal rows of one turn become one unit with a count), range-partitioned by
(conv_id, turn, role, text), so that a conversation with a third of all rows is cut over many tasks, and checkpointed.
A conversation inside one partition is finished there. Only the first and last conversation of a partition can reach
over its edges; their pieces (at most two per partition, a bound by the partition count) are joined on the driver:
backward vectors over pieces, then the exit state each piece's walk gives for each entry state, composed in order.
Their repaired lines are hashed by one streaming pass per conversation (SHA-256 cannot be split).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import shared_dir

INF = 1 << 40
# Fixed values of the contract: edit costs and the damage rule.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
DAMAGE_MODULUS = 20
#: Automaton of role initials: (state, initial) -> state; states 0 start, 1 after s, 2 after u, 3 after a.
LEGAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role that an inserted or rerolled row must take in each state, as the state it leads to.
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
NAME = {2: "user", 3: "assistant"}
ACCEPTING = (0, 3)
PAIRS = {"su", "ua", "au"}
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _closure() -> list[list[int]]:
    """Cheapest inserts from state to state (0 to itself)."""
    e = [[INF] * 4 for _ in range(4)]
    for s in range(4):
        cost, t = 0, s
        for _ in range(4):
            e[s][t] = min(e[s][t], cost)
            t, cost = NEXT[t], cost + INSERT
    return e


E = _closure()
FINAL = tuple(min(E[s][t] for t in ACCEPTING) for s in range(4))


def mat(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def apply(m, v):
    return tuple(min(min(m[i][k] + v[k] for k in range(4)), INF) for i in range(4))


IDENTITY = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))


def actions(state: int, initial: str, fault: str):
    """(edit, next state, cost) of one row in a state, ASCII order of edits; inserts are handled apart."""
    extra = UNFINISHED if fault == "t" else 0
    out = [("D", state, DELETE)]
    if fault in "bd":
        return out
    keep = LEGAL.get((state, initial))
    if keep is not None:
        out.append(("K", keep, KEEP + extra))
    out.append(("R", NEXT[state], REROLE + extra))
    return out


class Rules:
    """Matrices of symbols and their cached binary powers."""

    def __init__(self):
        self.powers: dict[tuple[str, str], list] = {}

    def matrix(self, symbol):
        got = self.powers.get(symbol)
        if got is None:
            a = [[INF] * 4 for _ in range(4)]
            for s in range(4):
                for _, t, c in actions(s, *symbol):
                    a[s][t] = min(a[s][t], c)
            got = self.powers[symbol] = [mat(E, a)]
        return got[0]

    def power(self, symbol, length: int):
        self.matrix(symbol)
        cache, out, k = self.powers[symbol], IDENTITY, 0
        while length:
            if k == len(cache):
                cache.append(mat(cache[-1], cache[-1]))
            if length & 1:
                out = mat(out, cache[k])
            length >>= 1
            k += 1
        return out


def _runs(units):
    """Runs [symbol, length, [(unit, rows)]] of a piece's units (role, text, n, first fault, later fault)."""
    runs = []
    for u, (role, _text, n, first, later) in enumerate(units):
        initial = role[:1]
        for symbol, count in (((initial, first), 1), ((initial, later), n - 1)):
            if count <= 0:
                continue
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += count
                runs[-1][2].append((u, count))
            else:
                runs.append([symbol, count, [(u, count)]])
    return runs


def _illegal(units) -> int:
    bad, last = 0, None
    for role, _t, n, _f, _l in units:
        initial = role[:1]
        if last is not None and last + initial not in PAIRS:
            bad += 1
        bad += n - 1  # equal initials side by side
        last = initial
    return bad


def _product(rules, runs):
    out = IDENTITY
    for symbol, length, _ in runs:
        out = mat(out, rules.power(symbol, length))
    return out


def _normal(v):
    low = min(v)
    return tuple(x - low if x < INF else INF for x in v)


def _walk(rules, units, runs, entry: int, after, emit):
    """Walk a piece forward from ``entry`` with cost-to-go ``after`` at its end; ``emit(edit, unit, state)`` gets every
    edit in order (unit None for inserts). Returns the exit state.

    Only differences inside a cost vector and the step between neighbouring vectors decide an edit, so each run keeps
    its normalised vectors (k rows before its end) up to the first that repeats; later ones follow by the period.
    """
    before = [None] * (len(runs) + 1)
    before[-1] = tuple(after)
    for r in range(len(runs) - 1, -1, -1):
        before[r] = apply(rules.power(runs[r][0], runs[r][1]), before[r + 1])
    state = entry
    for r, (symbol, length, members) in enumerate(runs):
        m = rules.matrix(symbol)
        norms, seen, v, start, period = [], {}, _normal(before[r + 1]), 0, 0
        for k in range(length + 1):
            if v in seen:
                start, period = seen[v], k - seen[v]
                break
            seen[v] = k
            norms.append(v)
            v = _normal(apply(m, v))
        steps = [min(apply(m, n)) for n in norms]

        def index(k):
            return k if k < len(norms) else start + (k - start) % period

        queue, q = members, 0
        left = queue[0][1]
        for j in range(length):
            k = length - j
            here, below = norms[index(k)], index(k - 1)
            there, gap = norms[below], steps[below]
            while True:
                chosen = None
                for edit, t, c in actions(state, *symbol):
                    if edit != "D" and chosen is None and INSERT + here[NEXT[state]] == here[state]:
                        chosen = ("I", NEXT[state])
                    if chosen is None and there[t] < INF and c + there[t] == here[state] + gap:
                        chosen = (edit, t)
                if chosen is None:
                    chosen = ("I", NEXT[state])
                edit, t = chosen
                emit(edit, None if edit == "I" else queue[q][0], t)
                state = t
                if edit != "I":
                    break
            left -= 1
            if left == 0 and q + 1 < len(queue):
                q += 1
                left = queue[q][1]
    return state


def _finish(state, emit):
    """Inserts after the last row until the automaton accepts."""
    while FINAL[state] > 0:
        state = NEXT[state]
        emit("I", None, state)
    return state


def _lines(units, edits):
    for edit, u, t in edits:
        if edit == "K":
            yield f"{units[u][0]}:{units[u][1]}"
        elif edit == "R":
            yield f"{NAME[t]}:{units[u][1]}"
        elif edit == "I":
            yield f"{NAME[t]}:"


def _solve_whole(rules, units):
    """Cost, audit, repaired SHA-256 and illegal pairs of a conversation all in one piece."""
    runs = _runs(units)
    cost = apply(_product(rules, runs), FINAL)[0]
    edits = []
    emit = lambda e, u, t: edits.append((e, u, t))
    _finish(_walk(rules, units, runs, 0, FINAL, emit), emit)
    digest = hashlib.sha256("\n".join(_lines(units, edits)).encode()).hexdigest()
    return cost, "".join(e for e, _, _ in edits), digest


def _fault_columns(units: DataFrame) -> DataFrame:
    """First and later fault of each unit: b blank, d duplicate, t truncated, c clean."""
    white = "[\\x20\\x09-\\x0D]"
    blank = ~F.col("text").rlike(f"[^{white[1:]}")
    last = F.regexp_extract("text", f"([^{white[1:]}){white}*$", 1)
    truncated = ~last.isin(".", "!", "?")
    return units.select(
        "*",
        F.when(blank, "b").when(~F.col("first_seen"), "d").when(truncated, "t").otherwise("c").alias("first"),
        F.when(blank, "b").otherwise("d").alias("later"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage, equal rows of a conversation and turn pre-aggregated: (conv_id, turn, role, text, n)."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = (F.crc32(key.cast("binary")) % DAMAGE_MODULUS).alias("d")
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = c.select("conv_id", "turn", role.alias("role"), text.alias("text"), d).where("d <> 0")
    rows = rows.select(
        "conv_id", "turn",
        F.when(F.col("d") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, F.lit("")).when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("d") == 3, 2).otherwise(1).alias("n"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").cast("long").alias("n"))


def _units(conversations: DataFrame) -> DataFrame:
    units = damaged(conversations)
    order = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"))
    firsts = units.groupBy("conv_id", "role", "text").agg(F.min(order).alias("first_order"))
    joined = units.alias("u").join(
        firsts.alias("f"),
        F.col("u.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("u.role") == F.col("f.role")) & (F.col("u.text") == F.col("f.text")),
    )
    seen = joined.select("u.*", (order == F.col("f.first_order")).alias("first_seen"))
    return _fault_columns(seen)


SCHEMA_A = (
    "conv_id long, part int, edge boolean, cost long, audit string, repaired_sha256 string, illegal long, "
    "matrix array<long>, first_initial string, last_initial string"
)


def _pieces(rows):
    """Consecutive units of one conversation in a sorted partition, as lists of tuples."""
    current, key = [], object()
    for batch in rows:
        cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv, role, text, n, first, later in zip(*cols):
            if conv != key and current:
                yield key, current
                current = []
            key = conv
            current.append((role, text, n, first, later))
    if current:
        yield key, current


def _arrow(spec: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([pa.field(n, kinds[k]) for n, k in (f.split(" ", 1) for f in spec.split(", "))])


def _pass_whole(rows):
    """Interior conversations of a sorted partition are finished; its first and last become matrices.

    Holds one conversation's units of this partition at a time (the pending one)."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    rules, out = Rules(), []

    def edge(conv, units):
        m = _product(rules, _runs(units))
        out.append((conv, part, True, None, None, None, _illegal(units), [x for row in m for x in row], units[0][0][:1], units[-1][0][:1]))

    pending, k = None, 0
    for conv, units in _pieces(rows):
        if k == 0:
            edge(conv, units)
        elif pending is not None:
            cost, audit, digest = _solve_whole(rules, pending[1])
            out.append((pending[0], part, False, cost, audit, digest, _illegal(pending[1]), None, None, None))
            pending = (conv, units)
        else:
            pending = (conv, units)
        k += 1
    if pending is not None:
        edge(*pending)
    schema = _arrow(SCHEMA_A)
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)


def _pass_edges(plan: dict):
    """The walk of edge pieces: with ``record`` False the exit state for every entry state, else the edits."""
    def run(rows):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rules = Rules()
        for conv, units in _pieces(rows):
            info = plan.get((conv, part))
            if info is None:
                continue
            runs = _runs(units)
            if info["entry"] is None:
                exits = []
                for e in range(4):
                    reach = apply(_product(rules, runs), info["after"])[e] < INF
                    exits.append(_walk(rules, units, runs, e, info["after"], lambda *a: None) if reach else -1)
                yield pa.RecordBatch.from_pylist([{"conv_id": conv, "part": part, "exits": exits}], schema=_arrow("conv_id long, part int, exits array<long>"))
                continue
            edits = []
            emit = lambda e, u, t: edits.append((e, u, t))
            state = _walk(rules, units, runs, info["entry"], info["after"], emit)
            if info["last"]:
                _finish(state, emit)
            lines = list(_lines(units, edits))
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "part": part, "audit": "".join(e for e, _, _ in edits), "seq": i, "line": line} for i, line in enumerate(lines)]
                or [{"conv_id": conv, "part": part, "audit": "".join(e for e, _, _ in edits), "seq": -1, "line": None}],
                schema=_arrow("conv_id long, part int, audit string, seq long, line string"),
            )
    return run


def _stream_hash(rows):
    """SHA-256 of the repaired lines of each conversation, fed in (part, seq) order."""
    conv, h, first, started = None, None, True, False
    out = []
    for batch in rows:
        for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not started or c != conv:
                if started:
                    out.append({"conv_id": conv, "repaired_sha256": h.hexdigest()})
                conv, h, first, started = c, hashlib.sha256(), True, True
            if line is not None:
                h.update((line if first else "\n" + line).encode())
                first = False
    if started:
        out.append({"conv_id": conv, "repaired_sha256": h.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, schema=_arrow("conv_id long, repaired_sha256 string"))


def _in(keys) -> F.Column:
    ids = [k for k in keys if k is not None]
    cond = F.col("conv_id").isin(ids) if ids else F.lit(False)
    return cond | (F.col("conv_id").isNull() & F.lit(None in keys))


def repair(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per original conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Damage by crc32 of ``conv_id:turn`` (a null part written as one space) modulo 20: 0 drops the row, 1 empties the
    text, 2 removes ``[.!?]``, 3 repeats the row, 4 makes the role user. Null role and text count as one space.
    Rows of a conversation are ordered by turn (nulls first), then role, then text; equal rows are interchangeable.
    A row's first fault counts: blank, then duplicate (role and text seen in an earlier row), then truncated. gaps is
    maxTurn - minTurn + 1 - distinct turns over non-null turns (0 if none). illegal counts neighbouring rows whose role
    initials are not su, ua or au; a role's initial is its first character (empty role: none, always illegal).
    A null conv_id is one conversation with a null key. A conversation with no rows after damage gets zeros, an empty
    audit and the SHA-256 of the empty string; so does an empty table (which gives no rows). Extra columns are ignored.
    """
    spark = conversations.sparkSession
    units = _units(conversations)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    shared_dir(spark, "repair")  # makes sure the session has a shared checkpoint folder
    ordered = units.select("conv_id", "turn", "role", "text", "n", "first", "later").repartitionByRange(parts, *keys).sortWithinPartitions(*keys).checkpoint()
    body = ordered.select("conv_id", "role", "text", "n", "first", "later")
    whole = body.mapInArrow(_pass_whole, SCHEMA_A).checkpoint()
    done = whole.where(~F.col("edge")).select("conv_id", "cost", "audit", "repaired_sha256", "illegal")

    # Edge pieces: at most two a partition, so this list is bounded by the partition count.
    edges = whole.where("edge").select("conv_id", "part", "illegal", "matrix", "first_initial", "last_initial").collect()
    by_conv: dict = {}
    for r in edges:
        by_conv.setdefault(r.conv_id, []).append(r)
    plan, totals = {}, {}
    for conv, pieces in by_conv.items():
        pieces.sort(key=lambda r: r.part)
        after = FINAL
        for r in reversed(pieces):
            plan[(conv, r.part)] = {"after": after, "entry": None, "last": r is pieces[-1]}
            m = tuple(tuple(r.matrix[4 * i:4 * i + 4]) for i in range(4))
            after = apply(m, after)
        illegal = sum(r.illegal for r in pieces) + sum(a.last_initial + b.first_initial not in PAIRS for a, b in zip(pieces, pieces[1:]))
        totals[conv] = (after[0], illegal)
    edge_rows = body.where(_in(list(by_conv)))
    exits = {}
    if plan:
        for r in edge_rows.mapInArrow(_pass_edges(plan), "conv_id long, part int, exits array<long>").collect():
            exits[(r.conv_id, r.part)] = r.exits
    for conv, pieces in by_conv.items():
        state = 0
        for r in pieces:
            plan[(conv, r.part)]["entry"] = state
            state = exits[(conv, r.part)][state]
    edited = edge_rows.mapInArrow(_pass_edges(plan), "conv_id long, part int, audit string, seq long, line string")
    edited = edited.checkpoint() if plan else edited
    audits = (
        edited.where("seq <= 0").groupBy("conv_id")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    )
    hashed = (
        edited.where("seq >= 0").select("conv_id", "part", "seq", "line")
        .repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").select("conv_id", "line")
        .mapInArrow(_stream_hash, "conv_id long, repaired_sha256 string")
    )
    total_rows = [(c, t[0], t[1]) for c, t in totals.items()]
    total_df = spark.createDataFrame(total_rows, "conv_id long, cost long, illegal long")
    edge_done = (
        total_df.alias("t").join(audits.alias("a"), F.col("t.conv_id").eqNullSafe(F.col("a.conv_id")), "left")
        .join(hashed.alias("h"), F.col("t.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
        .select("t.conv_id", "t.cost", F.coalesce("a.audit", F.lit("")).alias("audit"),
                F.coalesce("h.repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"), "t.illegal")
    )
    solved = done.unionByName(edge_done)

    counts = units.groupBy("conv_id").agg(
        F.sum(F.when(F.col("first") == "b", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("first") == "b", 0).otherwise(F.col("n") - F.when(F.col("first_seen"), 1).otherwise(0))).alias("duplicate"),
        F.sum(F.when(F.col("first") == "t", 1).otherwise(0)).alias("truncated"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
    )
    originals = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = F.lit(0).cast("long")
    return (
        originals.alias("o")
        .join(counts.alias("c"), F.col("o.conv_id").eqNullSafe(F.col("c.conv_id")), "left")
        .join(solved.alias("s"), F.col("o.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
        .select(
            "o.conv_id",
            *[F.coalesce(F.col(f"c.{n}").cast("long"), zero).alias(n) for n in ("gaps", "blank", "duplicate", "truncated")],
            F.coalesce(F.col("s.illegal"), zero).alias("illegal"),
            F.coalesce(F.col("s.cost"), zero).alias("cost"),
            F.coalesce(F.col("s.audit"), F.lit("")).alias("audit"),
            F.coalesce(F.col("s.repaired_sha256"), F.lit(EMPTY_SHA)).alias("repaired_sha256"),
        )
    )
