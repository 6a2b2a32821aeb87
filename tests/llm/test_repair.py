"""Conversation repair against all edits and a plain dynamic programme."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from incident_analytics.llm import queries, repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    """One of blank, duplicate, truncated, '' for each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def plain(rows, found):
    """(cost, audit, lines) by states and rows, with at most one insertion before each row and two at the end."""
    best = {"": (0, "", [])}
    for (role, text), fault in zip(rows, found):
        new = {}
        def offer(state, value):
            if state not in new or value[:2] < new[state][:2]:
                new[state] = value
        for state, (cost, audit, lines) in best.items():
            starts = [(state, cost, audit, lines)]
            add = "a" if state == "u" else "u"
            starts.append((add, cost + 2, audit + "I", [*lines, {"u": "user:", "a": "assistant:"}[add]]))
            for st, c, a, ls in starts:
                offer(st, (c + 3, a + "D", ls))
                if fault in ("blank", "duplicate"):
                    continue
                extra = fault == "truncated"
                allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[st]
                if role[:1] and role[:1] in allowed:
                    offer(role[:1], (c + extra, a + "K", [*ls, f"{role}:{text}"]))
                give = "a" if st == "u" else "u"
                offer(give, (c + 2 + extra, a + "R", [*ls, {"u": "user:", "a": "assistant:"}[give] + text]))
        best = new
    tails = {"": [], "a": [], "u": ["assistant:"], "s": ["user:", "assistant:"]}
    return min((c + 2 * len(tails[s]), a + "I" * len(tails[s]), ls + tails[s]) for s, (c, a, ls) in best.items())


def exhaustive(rows, found):
    """The best of all edit sequences with up to two insertions in each gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    for edits in itertools.product("KDua", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(found, edits)):
            continue
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            roles, cost, audit = "", 0, ""
            for i, g in enumerate(added):
                roles, cost, audit = roles + g, cost + 2 * len(g), audit + "I" * len(g)
                if i < len(rows):
                    e = edits[i]
                    roles += "" if e == "D" else (rows[i][0][:1] or "?") if e == "K" else e
                    cost += {"K": 0, "D": 3}.get(e, 2) + (e != "D" and found[i] == "truncated")
                    audit += {"K": "K", "D": "D"}.get(e, "R")
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def brute(rows):
    """The query's rows; turns of a conversation must differ, but for equal rows."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damage(rows):
        convs[r[0]].append(r[1:])
    out = []
    for key, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        said = [r[1:] for r in mine]
        found = faults(said)
        cost, audit, lines = plain(said, found)
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out.append((key, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def conversation(rng, key, n, roles=("user", "assistant", "system", "assistant", "user", "tool", "", None, "User")):
    texts = ["Yes.", "No", "why? ", "", " \t", "x", "é!", None, "a.\n", "b…"]
    step = rng.choice([1, 1, 2])
    first = [(key, None, rng.choice(roles), rng.choice(texts))] if rng.random() < 0.1 else []
    return first + [(key, i * step, rng.choice(roles[: rng.choice([2, 3, 9])]), rng.choice(texts) if rng.random() < 0.5 else f"t{i}.") for i in range(n)]


def in_pieces(said, found, size):
    """Cost and audit by pieces, chosen as the operator does."""
    kinds = ["s", "u", "a"]
    rows = []
    for (role, _), fault in zip(said, found):
        initial = kinds.index(role[:1]) if role[:1] in kinds and role[:1] else 3
        kind = initial + (4 if fault == "blank" else 8 if fault == "truncated" else 0)
        rows.append((kind, fault != "duplicate", 1))
    return rows


@pytest.mark.parametrize("seed", range(60))
def test_search_is_the_best_of_all_edits(seed):
    rng = random.Random(seed)
    said = [(r[2] or " ", r[3] or " ") for r in conversation(rng, 1, rng.randint(1, 3))]
    found = faults(said)
    best = exhaustive(said, found)
    assert repair.solve(in_pieces(said, found, 0)) == best == plain(said, found)[:2]


def test_search_equals_programme_on_long_conversations():
    rng = random.Random(7)
    for n in (5, 9, 20, 64, 200):
        for _ in range(12):
            said = [(r[2] or " ", r[3] or " ") for r in conversation(rng, 1, n)]
            found = faults(said)
            rows = in_pieces(said, found, 0)
            assert repair.solve(rows) == plain(said, found)[:2]
            bounds = repair.bounds(rows)
            assert bounds[0] <= repair.solve(rows)[0] and bounds[-1] == 0


COLUMNS = "conv_id long, turn long, role string, text string"


def got(spark, rows, parts=5):
    return sorted(map(tuple, queries.repaired_rows(spark.createDataFrame(rows, COLUMNS).repartition(parts)).collect()), key=str)


def test_query_equals_brute_force(spark):
    rng = random.Random(11)
    rows = [r for key in range(60) for r in conversation(rng, key, rng.randint(1, 12))]
    rows += conversation(rng, 100, 900) + conversation(rng, None, 70) + conversation(rng, 101, 64) + conversation(rng, 102, 65)
    rows += [(200, 5, "user", "same.")] * 500 + [(200, 6, "assistant", "x.")] + [(201, t, "user", "same") for t in range(300)]
    rows += [(300, -(2**63), "user", "a."), (300, 2**63 - 1, "assistant", "b."), (301, None, None, None), (302, 0, "user", "long. " * 200_000)]
    want = [r if r[0] != 300 else (r[0], min(r[1], 2**63 - 1), *r[2:]) for r in brute(rows)]
    assert got(spark, rows) == sorted(want, key=str)


def test_empty_and_clashing(spark):
    assert got(spark, []) == []
    rows = conversation(random.Random(3), 1, 9)
    docs = spark.createDataFrame(rows, COLUMNS)
    for name in ("part", "seq", "line", "mark", "times", "kind", "first", "copies", "key", "_fault", "said"):
        docs = docs.selectExpr("*", f"'{name}' as `{name}`")
    assert sorted(map(tuple, queries.repaired_rows(docs).collect()), key=str) == sorted(brute(rows), key=str)


def test_rows_that_are_all_dropped(spark):
    key = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert got(spark, [(key, 0, "user", "a.")]) == [(key, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
