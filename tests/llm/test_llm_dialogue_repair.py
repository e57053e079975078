from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tillgrain.llm import dialogue_repair as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def least_edits(rows):
    """(cost, edits, repaired) by all edits of every suffix, no states but the roles' text."""
    grammar = re.compile(r"(s?(ua)+)?")
    prefix = re.compile(r"(s?(ua)*u?)?")
    best = {}

    def solve(i, done):
        """least (cost, edits) from row i on, after roles that end like ``done``"""
        key = (i, done)
        if key in best:
            return best[key]
        options = []
        for extra in ("", "u", "a", "ua", "au"):
            now = done + extra
            if not prefix.fullmatch(now):
                continue
            cost, edits = 2 * len(extra), "I" * len(extra)
            if i == len(rows):
                if grammar.fullmatch(now):
                    options.append((cost, edits))
                continue
            role, _, fault = rows[i]
            moves = [("D", 3, now)]
            if fault not in ("blank", "duplicate"):
                late = int(fault == "truncated")
                if role[:1] in ("s", "u", "a") and role:
                    moves.append(("K", late, now + role[0]))
                moves += [("R", 2 + late, now + r) for r in "ua"]
            for edit, more, then in moves:
                if prefix.fullmatch(then):
                    # Only what the pattern can still tell apart.
                    tail = solve(i + 1, "ua" if then.endswith("a") else then[-1:])
                    options.append((cost + more + tail[0], edits + edit + tail[1]))
        best[key] = min(options)
        return best[key]

    # From the back, so that no call goes deep.
    for i in range(len(rows), 0, -1):
        for done in ("", "s", "u", "ua"):
            solve(i, done)
    cost, edits = solve(0, "")
    out, roles, i = [], "", 0
    for e in edits:
        if e in "IR":
            name = "assistant" if roles.endswith("u") else "user"
            out.append(f"{name}:{rows[i][1] if e == 'R' else ''}")
            roles += name[0]
        elif e == "K":
            out.append(f"{rows[i][0]}:{rows[i][1]}")
            roles += rows[i][0][0]
        i += e != "I"
    return cost, edits, "\n".join(out)


def expected(table):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, rows in convs.items():
        digest = lambda t: hashlib.sha256(t.encode()).digest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[2])))
        seen, marked = set(), []
        for _, role, text in rows:
            solid = text.strip(BLANK)
            if not solid:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = lambda f: sum(m[2] == f for m in marked)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:], strict=False)]
        cost, edits, repaired = least_edits(marked)
        sha = hashlib.sha256(repaired.encode()).hexdigest()
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        faults = (count("blank"), count("duplicate"), count("truncated"), illegal)
        out.append((conv, gaps, *faults, cost, edits, sha))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def reported(spark, table, schema=SCHEMA):
    rows = op.report(spark, spark.createDataFrame(table, schema)).collect()
    return sorted([tuple(r) for r in rows], key=lambda r: (r[0] is None, r[0] or 0))


def invented(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 6 + ["system", "tool", "", "scribe", None]
    texts = ["Yes.", "No!", "Why", "so it is.", " ", "", "ends \n", "What? \t", None, "É.", "a.b"]
    table = []
    for conv in range(conversations):
        for turn in range(rng.randrange(longest)):
            row = (conv, turn + rng.randrange(2), rng.choice(roles), rng.choice(texts))
            table += [row] * (2 if rng.random() < 0.1 else 1)
    return table


def test_equals_brute_force(spark):
    table = invented(1, 400, 9)
    assert reported(spark, table) == expected(table)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_segments_join_to_the_whole_answer(spark, monkeypatch, size):
    monkeypatch.setattr(op, "SEGMENT", size)
    table = invented(size, 60, 30)
    assert reported(spark, table) == expected(table)


def test_search_equals_brute_force_in_every_state():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randrange(7)
        roles = "".join(rng.choice("suax") for _ in range(n))
        marks = "".join(rng.choice("..~#") for _ in range(n))
        ends = [rng.randrange(6) for _ in range(4)]
        for start in op.STATES:
            cost, edits, last = op.repair(roles, marks, start, ends)
            m = op.matrix(roles, marks)
            assert cost + ends[last] == op.backwards(m, ends)[start]
            assert m[4 * start + last] == cost and sum(e != "I" for e in edits) == n


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system"]
    long = [(7, t, rng.choice(roles), f"{t}." if t % 9 else f"{t}") for t in range(1500)]
    long += [(7, 3, "user", "same.")] * 200
    table = long + invented(5, 40, 6)
    assert reported(spark, table) == expected(table)


def test_nulls_empty_and_clashing(spark):
    table = [
        (None, None, None, None),
        (None, 1, "user", "Hi."),
        (None, None, "user", "Hi."),
        (1, None, "assistant", "Ends"),
        (2, 5, "user", "x" * 200_000 + "."),
        (3, 0, "", "?"),
    ]
    # Conversations of which nothing is left.
    gone = [c for c in range(100, 200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    table += [(c, 0, "user", "Lost.") for c in gone]
    got = reported(spark, table)
    assert got == expected(table)
    nothing = hashlib.sha256(b"").hexdigest()
    assert [r[1:] for r in got if r[0] in gone] == [(0, 0, 0, 0, 0, 0, "", nothing)] * len(gone)
    assert reported(spark, []) == []
    more = SCHEMA + ", seg int, digest int, kind string, n int"
    assert reported(spark, [(*r, 1, 2, "k", 3) for r in table], more) == got
