"""Conversation repair against exhaustive search, dynamic programming and the oracle SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from headway.llm import conversation_repair as cr

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, at long, kind int, code string"


def best(kinds, doomed, truncated):
    """(cost, audit) of the cheapest, then ASCII-least script, by dynamic programming from the end."""
    n = len(kinds)
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    value = {("", n): (0, ""), ("a", n): (0, ""), ("s", n): (10**9, ""), ("u", n): (10**9, "")}
    for i in range(n, -1, -1):
        for _ in range(4):
            for s, nxt in after.items():
                found = [value.get((s, i), (10**9, ""))]
                found += [(2 + value[t, i][0], "I" + value[t, i][1]) for t in nxt if t in "ua" and (t, i) in value]
                if i < n:
                    found.append((3 + value[s, i + 1][0], "D" + value[s, i + 1][1]))
                    if not doomed[i]:
                        for t in nxt:
                            more = truncated[i]
                            c, rest = value[t, i + 1]
                            if t == kinds[i]:
                                found.append((more + c, "K" + rest))
                            elif t in "ua":
                                found.append((2 + more + c, "R" + rest))
                value[s, i] = min(found)
    return value["", 0]


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        kept = convs.setdefault(c, [])
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    out = []
    for c, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in kept:
            body = text.rstrip(cr.BLANKS)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        kinds = [r[1][:1] for r in kept]
        cost, audit = best(kinds, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        lines, state, left = [], "", iter(kept)
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            if edit == "K" and row[1][:1] == "s":
                state = "s"
                lines.append(f"{row[1]}:{row[2]}")
                continue
            state = "a" if state == "u" else "u"
            role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[state]
            lines.append(f"{role}:{row[2] if row else ''}")
        turns = {r[0] for r in kept if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds))
        assert LEGAL.match("".join(x[:1] for x in lines))
        out.append(
            (c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        )
    return sorted(out, key=str)


def repaired(spark, rows):
    got = cr.conversation_repair(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_auction_finds_cheapest_least_scripts():
    """Every code string of up to three rows, random longer ones: cost and script."""
    every = "".join(v[:4] for k, v in cr.CODES.items() if k != "duplicate")
    strings = ["".join(x) for n in range(4) for x in itertools.product(every, repeat=n)]
    rnd = random.Random(4)
    strings += ["".join(rnd.choice("suaxSUAX15") for _ in range(rnd.randrange(4, 40))) for _ in range(150)]
    for codes in strings:
        want = best([cr._CLASS[c] for c in codes], [c in cr._DOOMED for c in codes], [c in cr._TRUNCATED for c in codes])
        assert cr.block_scripts(codes, cr._AT_END, (0,))[0][0] == want[1], codes
        costs = cr.block_costs(codes)
        assert min(costs[0], costs[3]) == want[0], codes


def random_rows(seed, convs, longest=9):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "so it is", "", " \t", "Why?\n", None, "Étang."] + [f"Answer {k}." for k in range(30)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for c in range(convs):
        for t in range(rnd.randrange(1, longest)):
            rows.append((c if c else None, rnd.choice([t, t, t, t + 3, None]), rnd.choice(roles), rnd.choice(texts)))
    rnd.shuffle(rows)
    return rows


def test_random_conversations(spark):
    rows = random_rows(1, 120)
    assert repaired(spark, rows) == brute(rows)


def test_a_conversation_of_many_blocks(spark):
    """One conversation holds nearly all rows and spans blocks and partitions."""
    rnd = random.Random(9)
    rows = [(7, t, rnd.choice(["user", "assistant", "assistant", "tool"]), f"Line {t}{rnd.choice('.!, ')}") for t in range(600)]
    rows += random_rows(2, 5)
    assert repaired(spark, rows) == brute(rows)


def test_least_script_where_a_block_ends():
    """A delete goes before an insert also where a block ends between them."""
    every = "suaxU1"
    for codes in ("".join(x) for n in range(2, 5) for x in itertools.product(every, repeat=n)):
        want = best([cr._CLASS[c] for c in codes], [c in cr._DOOMED for c in codes], [c in cr._TRUNCATED for c in codes])[1]
        for cut in range(1, len(codes)):
            costs = cr.block_costs(codes[cut:])
            exits = tuple(min(cr.NEVER, *(costs[4 * s + t] + cr._AT_END[t] for t in range(4))) for s in range(4))
            first, end = cr.block_scripts(codes[:cut], exits, (0,))[0]
            assert first + cr.block_scripts(codes[cut:], cr._AT_END, (0, 1, 2, 3))[end][0] == want, (codes, cut)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(*gone, "user", "Hi.")]) == [(gone[0], 0, 0, 0, 0, 0, 0, "", empty)]
    assert repaired(spark, []) == []


@pytest.mark.parametrize("seed", [11])
def test_oracle_on_odd_rows(spark, seed):
    rows = random_rows(seed, 40)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(cr.ORACLE_REPAIR).fetchall(), key=str) == brute(rows)
