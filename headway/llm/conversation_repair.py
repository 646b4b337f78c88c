"""Conversation repair: cheapest role-legal edit scripts by the auction shortest-path algorithm.

A conversation is legal if its role initials read ``(s?(ua)+)?``.  Its rows and
the four states of that pattern (nothing yet, after s, after u, after a) make a
lattice: node (i, state) has i rows behind it, arcs keep, rerole or delete the
next row or insert an empty one, at whole costs.  The auction algorithm keeps a
price for each node and a path from the start: the path's last node is extended
along an arc whose cost the prices meet, or its price is raised to the best arc
and the path contracts by it.  When the path arrives, the prices show the arcs
that cheapest scripts use (the tight ones), and the least script in ASCII order
is traced along those.

The lattice is cut into blocks of ``BLOCK`` rows, so a conversation of any
length spreads over tasks: blocks give the cost between every pair of their
end states, one stream a conversation carries the prices of later blocks
backward (four numbers of state), blocks trace their scripts, and a last stream
applies them to the rows.  The streams read a conversation's rows in order and
hold one batch; the repaired text is hashed there, in its order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.store import materialise

#: Rows of one block of a lattice.
BLOCK = 64
#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: A price that no script has.
NEVER = 1 << 60
BLANKS = " \t\n\x0b\x0c\r"

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
#: States from which an end state can be reached.
_REACH = ((0,), (0, 1), (0, 1, 2, 3), (0, 1, 2, 3))
_AT_END = (0, NEVER, NEVER, 0)

#: Codes: a row's role initial (s, u, a, other) by its first fault.
CODES = {"none": "suax", "truncated": "SUAX", "blank": "1234", "duplicate": "5678"}
_CLASS = {c: "suax"[k] for codes in CODES.values() for k, c in enumerate(codes)}
_TRUNCATED = set(CODES["truncated"])
_DOOMED = set(CODES["blank"] + CODES["duplicate"])


# ── the lattice of a block ───────────────────────────────────────────────────


def _least_cost(code: str) -> int:
    """What a row costs at the least, wherever it stands."""
    if code in _DOOMED:
        return DELETE
    more = TRUNCATED if code in _TRUNCATED else 0
    return min(REROLE + more, DELETE) if _CLASS[code] == "x" else more


def _lattice(codes: str, exits: tuple[int, ...], more_follow: bool = False) -> tuple[list[list[tuple[str, int, int]]], list[int]]:
    """Arcs (edit, cost, node) of each node in the edits' ASCII order, and prices to start from.

    Node 4 * i + state; the last node is the sink, which ``exits`` lead to.  Where
    more rows follow, nothing is inserted after the last one: the next block
    does that, and tells whether a delete comes before it."""
    n, sink = len(codes), 4 * (len(codes) + 1)
    wanted = {s for t, cost in enumerate(exits) if cost < NEVER for s in _REACH[t]}
    arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(sink + 1)]
    for i in range(n + 1):
        for s in range(4):
            out = arcs[4 * i + s]
            to = _NEXT[s]
            if i < n:
                out.append(("D", DELETE, 4 * (i + 1) + s))
            if to in wanted and not (i == n and more_follow):
                out.append(("I", INSERT, 4 * i + to))
            if i < n and codes[i] not in _DOOMED:
                more = TRUNCATED if codes[i] in _TRUNCATED else 0
                kept = {"s": 1 if s == 0 else None, "u": 2, "a": 3, "x": None}[_CLASS[codes[i]]]
                if kept == to or (kept == 1 and 1 in wanted):
                    out.append(("K", more, 4 * (i + 1) + kept))
                if kept != to and to in wanted:
                    out.append(("R", REROLE + more, 4 * (i + 1) + to))
            if i == n and exits[s] < NEVER:
                out.append(("", exits[s], sink))
    price = [0] * (sink + 1)
    floor = min(exits)
    for i in range(n, -1, -1):
        if i < n:
            floor += _least_cost(codes[i])
        price[4 * i : 4 * i + 4] = [floor] * 4
    return arcs, price


def auction(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int) -> int:
    """Raise ``price`` until a path of tight arcs leads from ``origin`` to the last node; its length.

    Every arc's cost must be at least the difference of its ends' prices, and
    stays so.  NEVER if no path leads there."""
    sink = len(arcs) - 1
    path = [origin]
    while path[-1] != sink:
        node = path[-1]
        best, to = NEVER, -1
        for _, cost, nxt in arcs[node]:
            if cost + price[nxt] < best:
                best, to = cost + price[nxt], nxt
        if price[node] < best:  # contract
            price[node] = best
            if len(path) > 1:
                path.pop()
            elif best >= NEVER:
                return NEVER
        else:  # extend
            if to < 0:
                return NEVER
            path.append(to)
    return price[origin] - price[sink]


@lru_cache(1 << 14)
def block_costs(codes: str) -> tuple[int, ...]:
    """Cheapest cost from each entry state to each end state, at 4 * entry + end."""
    found = [NEVER] * 16
    for end in range(4):
        arcs, price = _lattice(codes, tuple(0 if s == end else NEVER for s in range(4)))
        for entry in _REACH[end]:
            found[4 * entry + end] = auction(arcs, price, entry)
    return tuple(found)


@lru_cache(1 << 14)
def block_scripts(codes: str, exits: tuple[int, ...], entries: tuple[int, ...]) -> tuple[tuple[str, int] | None, ...]:
    """For each entry state the ASCII-least of its cheapest scripts, and the state it ends in."""
    arcs, price = _lattice(codes, exits, more_follow=exits != _AT_END)
    sink = len(arcs) - 1
    costs = {e: auction(arcs, price, e) for e in entries}
    # Tight arcs, and the nodes from which they lead to the sink.
    tight = [[(x, to) for x, cost, to in out if price[node] == cost + price[to]] for node, out in enumerate(arcs)]
    good = [False] * sink + [True]
    for i in range(len(codes), -1, -1):
        for _ in range(3):  # at most two inserts follow one another
            for node in range(4 * i, 4 * i + 4):
                good[node] = good[node] or any(good[to] for _, to in tight[node])
    scripts: list[tuple[str, int] | None] = [None] * 4
    for entry in entries:
        if costs[entry] >= NEVER:
            continue
        node, script, end = entry, [], entry
        while node != sink:
            # an edit leads to one node only, so the least edit is on the least script
            edit, to = next((x, to) for x, to in tight[node] if good[to])
            script.append(edit)
            end, node = node % 4, to
        scripts[entry] = ("".join(script), end)
    return tuple(scripts)


# ── Spark stages ─────────────────────────────────────────────────────────────


def damage(rows: DataFrame) -> DataFrame:
    """The rows after damage by crc32 of ``conv_id:turn`` modulo 20 (nulls as one space)."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    hit = F.crc32(F.concat(as_text[0], F.lit(":"), as_text[1]).cast("binary")) % 20
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", "turn", as_text[2].alias("role"), as_text[3].alias("text"), hit.alias("hit"))
        .where("hit <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
    )


def _coded(rows: DataFrame) -> DataFrame:
    """Rows in one global order (``at``) with their code."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text_key"]
    keyed = rows.select("conv_id", "turn", "role", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"))
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialise(placed, "turns")
    firsts = placed.groupBy("conv_id", "role", "text_key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(body == "", "blank")
        .when(F.col("is_first").isNull(), "duplicate")
        .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("none")
    )
    return (
        placed.join(firsts, "at", "left")
        .withColumn("code", _code(F.left(F.col("role"), F.lit(1)), fault))
        .select("conv_id", "at", "turn", "role", "text", "code")
    )


def _code(initial: Column, fault: Column) -> Column:
    k = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    codes = F.lit(None)
    for name, letters in CODES.items():
        codes = F.when(fault == name, F.lit(letters)).otherwise(codes)
    return codes.substr(k, F.lit(1))


def _with_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = [
            None if alone else list(block_costs(codes))
            for codes, alone in zip(batch.column("codes").to_pylist(), batch.column("alone").to_pylist(), strict=True)
        ]
        yield batch.append_column("costs", pa.array(costs, pa.list_(pa.int64())))


def _with_exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation from last to first: what the states at a block's end still cost."""
    begun, conv, ahead = False, None, _AT_END
    for batch in batches:
        exits = []
        for now, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist(), strict=True):
            if not begun or now != conv:
                begun, conv, ahead = True, now, _AT_END
            exits.append(list(ahead))
            if costs is not None:
                ahead = tuple(min(NEVER, *(costs[4 * s + t] + ahead[t] for t in range(4))) for s in range(4))
        kept = batch.select(["conv_id", "at", "codes", "is_first"])
        yield kept.append_column("exits", pa.array(exits, pa.list_(pa.int64())))


def _with_scripts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("codes", "exits", "is_first")]
        found = [
            block_scripts(codes, tuple(exits), (0,) if is_first else (0, 1, 2, 3))
            for codes, exits, is_first in zip(*columns, strict=True)
        ]
        scripts = pa.array([[x and x[0] for x in f] for f in found], pa.list_(pa.string()))
        ends = pa.array([[x and x[1] for x in f] for f in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("at"), scripts, ends], ["conv_id", "at", "scripts", "ends"])


def scripts(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, at, scripts, ends) of each block of rows: a script for each state it may be entered in."""
    conv = coded.schema["conv_id"].dataType.simpleString()
    blocks = (
        coded.groupBy("conv_id", F.floor(F.col("at") / block).alias("block"))
        .agg(F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))  # at most BLOCK
        .select("conv_id", "at", F.array_join(F.col("rows.code"), "").alias("codes"))
    )
    ends = blocks.groupBy("conv_id").agg(F.min("at").alias("at"), F.max("at").alias("last"))
    marked = blocks.join(ends.select("at", F.lit(True).alias("is_first"), "last"), "at", "left").select(
        "conv_id", "at", "codes", F.coalesce("is_first", F.lit(False)).alias("is_first"), F.coalesce(F.col("last") == F.col("at"), F.lit(False)).alias("alone")
    )
    costed = marked.mapInArrow(_with_costs, f"conv_id {conv}, at long, codes string, is_first boolean, alone boolean, costs array<long>")
    backward = costed.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at"))
    exits = backward.mapInArrow(_with_exits, f"conv_id {conv}, at long, codes string, is_first boolean, exits array<long>")
    return exits.repartition("at").mapInArrow(_with_scripts, f"conv_id {conv}, at long, scripts array<string>, ends array<int>")


class _Applied:
    """Repaired rows of the conversation that a stream stands in."""

    def __init__(self) -> None:
        self.state, self.todo, self.entry, self.last = 0, iter(""), 0, None
        self.out: list[tuple] = []

    def inserts(self, conv) -> str:
        """Apply inserts; the next other edit, or '' at the script's end."""
        for edit in self.todo:
            if edit != "I":
                return edit
            self.state = _NEXT[self.state]
            self.out.append((conv, "I", _ROLE[self.state], "", None, None, False))
        return ""

    def block(self, conv, scripts, ends) -> None:
        self.inserts(conv)
        self.todo = iter(scripts[self.entry])
        self.entry = ends[self.entry]

    def row(self, conv, turn, role, text, code) -> None:
        kind = _CLASS[code]
        illegal = self.last is not None and self.last + kind not in ("su", "ua", "au")
        self.last = kind
        edit = self.inserts(conv)
        if edit == "D":
            role = text = None
        elif edit == "K" and kind == "s":
            self.state = 1
        else:
            self.state = _NEXT[self.state]
            role = _ROLE[self.state] if edit == "R" else role
        self.out.append((conv, edit, role, text, turn, code, illegal))


_REPAIRED = "conv_id {}, edit string, role string, text string, turn {}, code string, illegal boolean"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begun, conv, now = False, None, _Applied()
    schema = None
    for batch in batches:
        kinds = {f.name: f.type for f in batch.schema}
        schema = [kinds["conv_id"], pa.string(), pa.string(), pa.string(), kinds["turn"], pa.string(), pa.bool_()]
        out: list[tuple] = []
        for r in batch.to_pylist():
            if not begun or r["conv_id"] != conv:
                now.inserts(conv)
                out += now.out
                begun, conv, now = True, r["conv_id"], _Applied()
            if r["kind"] == 0:
                now.out.append((conv, "", None, None, None, None, False))
            elif r["kind"] == 1:
                now.block(conv, r["scripts"], r["ends"])
            else:
                now.row(conv, r["turn"], r["role"], r["text"], r["code"])
        out += now.out
        now.out = []
        yield _rows(out, schema)
    if begun:
        now.inserts(conv)
        yield _rows(now.out, schema)


def _rows(out: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    names = ["conv_id", "edit", "role", "text", "turn", "code", "illegal"]
    columns = list(zip(*out, strict=True)) if out else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Edit, role and text of each row of the repaired conversations, each conversation in order.

    ``rows``: conv_id, turn, role, text without nulls in role and text.  Edits: K
    keep, R rerole, D delete (role and text null), I insert (turn and code null).
    One row with an empty edit goes before each conv_id of ``every``.  Rows of
    one turn stand by role, then by MD5 of the text.  The result is sorted by
    conversation within partitions.
    """
    coded = materialise(_coded(rows), "turns-coded")
    every = every.select("conv_id").distinct()
    marks = every.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind"))
    plans = scripts(coded).withColumn("kind", F.lit(1))
    merged = marks.unionByName(plans, allowMissingColumns=True).unionByName(coded.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    ordered = merged.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    types = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    return ordered.mapInArrow(_apply, _REPAIRED.format(*types))


_DIGEST = (
    "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_COSTS = {"": 0, "D": DELETE, "I": INSERT, "K": 0, "R": REROLE}


class _Digest:
    def __init__(self) -> None:
        self.first_turn = self.turn = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(CODES, 0)
        self.audit: list[str] = []
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, edit, role, text, turn, code, illegal) -> None:
        self.audit.append(edit)
        self.cost += _COSTS[edit] + (TRUNCATED if code in _TRUNCATED and edit != "D" else 0)
        self.illegal += illegal
        if code:
            self.faults[next(name for name, letters in CODES.items() if code in letters)] += 1
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn, self.turns = turn, self.turns + 1
        if role is not None:
            self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
            self.lines += 1

    def result(self, conv) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.first_turn + 1 - self.turns
        faults = [self.faults[k] for k in ("blank", "duplicate", "truncated")]
        return (conv, gaps, *faults, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begun, conv, now, types = False, None, _Digest(), []
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def made(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        types = [batch.column("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        done = []
        for r in batch.to_pylist():
            if not begun or r["conv_id"] != conv:
                if begun:
                    done.append(now.result(conv))
                begun, conv, now = True, r["conv_id"], _Digest()
            now.add(r["edit"], r["role"], r["text"], r["turn"], r["code"], r["illegal"])
        yield made(done)
    if begun:
        yield made([now.result(conv)])


def conversation_repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows``: faults after damage, the cheapest repair, its digest.

    Null conv_id: one conversation.  Null turn: first in its conversation, no
    part in the gaps.  Null role or text: one space (such a text is blank, such
    a role is neither s, u nor a; nor is an empty role).  Repeated rows: later
    ones are duplicates.  A conversation that damage leaves without rows: zeros
    and the hash of the empty text.  An empty table gives an empty result.
    Other columns of ``rows`` are not looked at.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()
    return repair(damage(rows), rows).mapInArrow(_digests, _DIGEST.format(conv))


def _plus(value: str, cost: str, letter: str) -> str:
    """SQL: a script (nine digits of cost, then edits) with one more edit before it."""
    return f"CASE WHEN {value} = '~' THEN '~' ELSE lpad(cast(cast(left({value}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({value}, 10) END"


def _arcs(state: int) -> str:
    """SQL: cheapest script of row r from ``state``, before inserts."""
    to = _NEXT[state]
    kept = f"WHEN r.initial = '{'_sua'[to]}' THEN {_plus(f'w.v{to}', 'r.more', 'K')}"
    if state == 0:
        kept += f" WHEN r.initial = 's' THEN least({_plus('w.v1', 'r.more', 'K')}, {_plus(f'w.v{to}', 'r.more + 2', 'R')})"
    stays = f"CASE WHEN r.doomed THEN '~' {kept} ELSE {_plus(f'w.v{to}', 'r.more + 2', 'R')} END"
    return f"least({_plus(f'w.v{state}', '3', 'D')}, {stays})"


def _inserts(base: str) -> str:
    v2 = f"least({base}.b2, {_plus(f'{base}.b3', '2', 'I')})"
    return (
        f"least({base}.b0, {_plus(f'({v2})', '2', 'I')}) AS v0, least({base}.b1, {_plus(f'({v2})', '2', 'I')}) AS v1, "
        f"{v2} AS v2, least({base}.b3, {_plus(f'{base}.b2', '2', 'I')}) AS v3"
    )


_SQL_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_REPAIR = f"""
WITH RECURSIVE table256 AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS bytes
    FROM conversations
),
struck AS (
    SELECT conv_id, turn, role, text,
           xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS hit
    FROM keyed, table256
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
           CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE hit WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM struck
),
numbered AS (
    SELECT *, rtrim(text, {_SQL_BLANKS}) AS body,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS repeated
    FROM damaged
),
turns AS (
    SELECT conv_id, i, turn, role, text, left(role, 1) AS initial,
           body = '' AS blank, body <> '' AND repeated AS duplicate,
           body <> '' AND NOT repeated AND right(body, 1) NOT IN ('.', '!', '?') AS truncated,
           body = '' OR repeated AS doomed,
           CASE WHEN body <> '' AND NOT repeated AND right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS more,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
    FROM numbered
),
sums AS (
    SELECT c.conv_id, count(r.i) AS n,
           coalesce(max(r.turn) - min(r.turn) + 1 - count(DISTINCT r.turn), 0) AS gaps,
           count(*) FILTER (WHERE r.blank) AS blank, count(*) FILTER (WHERE r.duplicate) AS duplicate,
           count(*) FILTER (WHERE r.truncated) AS truncated,
           count(*) FILTER (WHERE r.i > 1 AND r.earlier || r.initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN turns r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i IS NOT NULL
    GROUP BY c.conv_id
),
walk AS (
    SELECT conv_id, n + 1 AS i, {_inserts("e")}
    FROM sums, (SELECT '000000000' AS b0, '~' AS b1, '~' AS b2, '000000000' AS b3) e
    UNION ALL
    SELECT conv_id, i, {_inserts("e")}
    FROM (SELECT w.conv_id, r.i, {", ".join(f"{_arcs(s)} AS b{s}" for s in range(4))}
          FROM walk w JOIN turns r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i - 1) e
),
script AS (SELECT conv_id, cast(left(v0, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM walk WHERE i = 1),
edits AS (
    SELECT conv_id, audit, p, substr(audit, p, 1) AS edit, p - length(translate(left(audit, p), 'DKR', '')) AS i,
           length(replace(left(audit, p), 'D', '')) AS k
    FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM script)
),
outcome AS (
    SELECT e.*, r.role, r.text, first_value(e.edit = 'K' AND r.initial = 's') OVER (PARTITION BY e.conv_id ORDER BY p)::INT AS systems
    FROM edits e LEFT JOIN turns r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i AND e.edit <> 'I'
    WHERE e.edit <> 'D'
),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS body
    FROM outcome GROUP BY conv_id
)
SELECT s.conv_id, cast(s.gaps AS BIGINT) AS gaps, s.blank, s.duplicate, s.truncated, s.illegal, c.cost, c.audit,
       sha256(coalesce(p.body, '')) AS repaired_sha256
FROM sums s JOIN script c ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
"""
