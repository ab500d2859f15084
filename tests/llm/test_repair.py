"""Repair against every edit sequence, against a DP of cost and letters in tuples, and the query against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import cache

from starmart.llm import repair as R
from starmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, key string, block string, place string"
ENDS = re.compile(r"(s?(ua)+)?")
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


sys.setrecursionlimit(20_000)


def cheapest(rows):
    """Cost and letters by tuples, straight from the rules."""
    faults = faults_of(rows)

    @cache
    def best(i, last, inserted=0):
        ways = [(0, "", (0, ""))] if i == len(rows) and last in ("", "a") else []
        if inserted < 2:
            ways.append((2, "I", best(i, DUE[last], inserted + 1)))
        if i < len(rows):
            role, fault = rows[i][0], faults[i]
            ways.append((3, "D", best(i + 1, last)))
            if fault not in ("blank", "duplicate"):
                extra, first = fault == "truncated", role[:1]
                if (first == "s" and last == "") or (first in ("u", "a") and first == DUE[last]):
                    ways.append((extra, "K", best(i + 1, first)))
                ways.append((2 + extra, "R", best(i + 1, DUE[last])))
        return min(((c + rest[0], letter + rest[1]) for c, letter, rest in ways if rest), default=None)

    return best(0, "")


def apply(rows, audit):
    """The repaired rows of an edit sequence, or None if it isn't one."""
    out, i, last = [], 0, ""
    faults = faults_of(rows)
    cost = 0
    for letter in audit:
        if letter == "I":
            last, cost = DUE[last], cost + 2
            out.append(({"u": "user", "a": "assistant"}[last], ""))
            continue
        if i == len(rows):
            return None
        role, text = rows[i]
        fault, i = faults[i], i + 1
        if letter == "D":
            cost += 3
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += (fault == "truncated") + 2 * (letter == "R")
        if letter == "R":
            last = DUE[last]
            out.append(({"u": "user", "a": "assistant"}[last], text))
        elif role[:1] not in DUE or not role:
            return None
        else:
            last = role[:1]
            out.append((role, text))
    initials = "".join(role[:1] for role, _ in out)
    return (cost, out) if i == len(rows) and ENDS.fullmatch(initials) else None


def enumerated(rows, longest):
    """Over every sequence of letters up to a length."""
    best = None
    for n in range(longest + 1):
        for letters in itertools.product("DIKR", repeat=n):
            audit = "".join(letters)
            if sum(x != "I" for x in audit) == len(rows) and (made := apply(rows, audit)):
                best = min(filter(None, (best, (made[0], audit))))
    return best


def random_rows(rng, n):
    texts = ["yes.", "no!", "why?", "cut", " ", "", "so. \n", "a,b", "x.\x0b"]
    return [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "sys"]), rng.choice(texts) if rng.random() < 0.7 else f"t{rng.random()}.") for _ in range(n)]


def coded(rows):
    kinds = {"": R.SOUND, "blank": R.BLANK, "duplicate": R.DUPLICATE, "truncated": R.TRUNCATED}
    return [(R.INITIALS.get(role[:1], R.OTHER), kinds[fault]) for (role, _), fault in zip(rows, faults_of(rows), strict=True)]


def test_least_integer_is_the_best_of_all_edit_sequences():
    rng = random.Random(1)
    for _ in range(120):
        rows = random_rows(rng, rng.randint(1, 4))
        cost, audit, _ = R.joined([R.block_weights(coded(rows))])
        assert (cost, audit) == enumerated(rows, 7) == cheapest(rows), rows


def test_blocks_put_together_are_the_whole():
    rng = random.Random(2)
    for _ in range(150):
        rows = random_rows(rng, rng.randint(1, 60))
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows)) for _ in range(3))})
        blocks = [R.block_weights(coded(rows)[a:b]) for a, b in zip(cuts, cuts[1:])]
        cost, audit, pieces = R.joined(blocks)
        assert (cost, audit) == cheapest(rows) and "".join(p for _, p in pieces) == audit
        assert apply(rows, audit)[0] == cost


def expected(conversations):
    """key: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows."""
    out = {}
    for key, members in conversations.items():
        rows = [(role, text) for _, role, text in members]
        turns = [t for t, _, _ in members if t is not None]
        faults = faults_of(rows)
        pairs = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = cheapest(rows)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[key] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), pairs, cost, audit, apply(rows, audit)[1])
    return out


def collected(made):
    turns = {}
    for r in made.turns.orderBy("key", "block", "place").collect():
        turns.setdefault(r["key"], []).append((r["role"], r["text"]))
    return {r["key"]: (*(r[x] for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")), turns.get(r["key"], [])) for r in made.audits.collect()}


def test_table(spark, monkeypatch):
    """Nulls, repeated rows, one conversation with most rows over many blocks, clashing columns."""
    rng = random.Random(3)
    conversations = {}
    for conv in [*range(40), None]:
        n = 900 if conv == 7 else rng.randint(1, 12)
        rows = random_rows(rng, n)
        turn, members = rng.randint(-300, 5), []
        for role, text in rows:
            turn += rng.choice((1, 1, 1, 2, 300))
            members.append((turn, role, text))
            if rng.random() < 0.1:
                members.append((turn, role, text))
        if conv == 3:
            members = [(None, "user", "Lost."), (None, "user", "Lost."), *members, (turn + 9, "user", "Lost.")]
        conversations[" " if conv is None else str(conv)] = members
    made = [(None if key == " " else int(key), *m, "k", "b", "p") for key, members in conversations.items() for m in members]
    made.append((50, 0, None, None, "k", "b", "p"))
    conversations["50"] = [(0, " ", " ")]
    rng.shuffle(made)
    given = spark.createDataFrame(made, SCHEMA)
    assert collected(R.repair(given)) == expected(conversations)
    monkeypatch.setattr(R, "BLOCK", 5)  # a block with more rows than that is cut again
    assert collected(R.repair(given)) == expected(conversations)


def test_empty_table(spark):
    made = R.repair(spark.createDataFrame([], SCHEMA))
    assert made.audits.count() == 0 and made.turns.count() == 0


def test_query(spark):
    """By the contract, from the given table."""
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    conversations = {}
    for conv, turn, role, text in sorted(((r["conv_id"], r["turn"], r["role"], r["text"]) for r in given)):
        members = conversations.setdefault(conv, [])
        lot = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if lot == 1:
            text = ""
        elif lot == 2:
            text = re.sub("[.!?]", "", text)
        elif lot == 4:
            role = "user"
        members += [(turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)
    found = expected({k: m for k, m in conversations.items() if m})
    wanted = []
    for conv in conversations:
        *numbers, rows = found.get(conv, (0, 0, 0, 0, 0, 0, "", []))
        text = "\n".join(f"{role}:{text}" for role, text in rows)
        wanted.append((conv, *numbers, hashlib.sha256(text.encode()).hexdigest()))
    got = QUERIES["op13_turn_repair"](spark, FOLDER)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    assert sum(r[6] > 0 for r in wanted) > 5
