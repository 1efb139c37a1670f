"""Repair against a plain search over all edits, and the LR tables against the regular form of the grammar."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import product

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lettora.llm.conversation_repair import RepairSpec, chunks, damaged, faulty_turns, repair, repaired_conversations
from lettora.llm.role_grammar import RoleGrammar
from lettora.params import SkewLimits

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(turns):
    """Ways to read the rows, by the language state: 0 nothing yet, 1 behind the system turn, 2 user open, 3 pair closed."""
    faults, seen = [], set()
    for role, text in turns:
        rest = text.rstrip(BLANKS)
        faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    moves = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    ways = {0: (0, "", ())}

    def best(ways):
        ways = list(ways)
        return {state: min(way for s, way in ways if s == state) for state in {s for s, _ in ways}}

    def inserted(ways):
        for _ in range(4):
            more = [(s, w) for s, w in ways.items()]
            for (state, initial), end in moves.items():
                if state in ways and initial in "ua":
                    cost, audit, kept = ways[state]
                    name = {"u": "user:", "a": "assistant:"}[initial]
                    more.append((end, (cost + 3, audit + "I", (*kept, name))))
            ways = best(more)
        return ways

    for (role, text), fault in zip(turns, faults):
        new = []
        for state, (cost, audit, kept) in inserted(ways).items():
            new.append((state, (cost + 4, audit + "D", kept)))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 * (fault == "truncated")
            if (state, role[:1]) in moves:
                new.append((moves[state, role[:1]], (cost + extra, audit + "K", (*kept, f"{role}:{text}"))))
            for name in ("user", "assistant"):
                if (state, name[0]) in moves:
                    new.append((moves[state, name[0]], (cost + extra + 3, audit + "R", (*kept, f"{name}:{text}"))))
        ways = best(new)
    cost, audit, kept = min(way for state, way in inserted(ways).items() if state in (0, 3))
    sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return [faults.count(f) for f in ("blank", "duplicate", "truncated")], cost, audit, sha, kept


def plain(rows):
    out = []
    after = plain_damage(rows)
    for conv in {row[0] for row in rows}:
        mine = [row[1:] for row in after if row[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = [row[0] for row in mine if row[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [row[1][:1] for row in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts, cost, audit, sha, _ = plain_repair([row[1:] for row in mine])
        out.append((conv, gaps, *counts, illegal, cost, audit, sha))
    return sorted(out, key=repr)


def found(df, *args):
    return sorted(map(tuple, repaired_conversations(df, *args).select(*COLUMNS).collect()), key=repr)


def test_tables_accept_the_regular_form():
    grammar = RoleGrammar()
    for size in range(8):
        for roles in map("".join, product("sua", repeat=size)):
            node = 0
            for role in roles:
                node = grammar.step[node].get(role) if node is not None else None
            assert (node in grammar.accepts) == bool(re.fullmatch("(s?(ua)+)?", roles)), roles


def test_refused_grammars():
    with pytest.raises(ValueError, match="more than"):
        RoleGrammar((("C", "uCs"), ("C", "")))
    with pytest.raises(ValueError, match="inserted"):
        RoleGrammar((("C", "u"), ("C", "a")))


def test_plain_search_finds_the_least_of_all_edits():
    """The plain version, which merges by state as well, against every string of edits."""
    rng = random.Random(5)
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "no", "", "Ok!"])) for _ in range(rng.randint(0, 3))]
        counts, cost, audit, _, _ = plain_repair(turns)
        seen, best = set(), None
        faults = []
        for role, text in turns:
            faults.append(1 if not text or (role, text) in seen else 3 * (text[-1] not in ".!"))
            seen.add((role, text))
        options = [[("D", 4, "")] + ([] if f == 1 else [("K", f, r[0]), ("R", 3 + f, "u"), ("R", 3 + f, "a")]) for (r, _), f in zip(turns, faults)]
        inserts = ["", "u", "a", "ua", "au", "uau", "aua"]
        for choice in product(*options):
            for gaps in product(inserts, repeat=len(turns) + 1):
                if sum(map(len, gaps)) * 3 + sum(c[1] for c in choice) > cost:
                    continue
                initials = gaps[0] + "".join(c[2] + g for c, g in zip(choice, gaps[1:]))
                if re.fullmatch("(s?(ua)+)?", initials):
                    name = "I" * len(gaps[0]) + "".join(c[0] + "I" * len(g) for c, g in zip(choice, gaps[1:]))
                    way = 3 * sum(map(len, gaps)) + sum(c[1] for c in choice), name
                    best = min(best, way) if best else way
        assert best == (cost, audit), turns


def test_given_conversations_equal_plain(spark):
    from lettora.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.01"
    table = pq.read_table(f"{folder}/conversations.parquet").to_pydict()
    rows = list(zip(*(table[name] for name in ("conv_id", "turn", "role", "text"))))
    result = LLM_QUERIES["op12_conversation_repair"](spark, folder)
    assert sorted(map(tuple, result.select(*COLUMNS).collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("chunk_rows", [1, 3, 512])
def test_odd_rows(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    roles = ["user", "assistant", "system", "tool", "", None, "User", " ", "über"]
    texts = ["Fine.", "Cut", "", "  ", None, "What?", "\n.\t", "a" * 20_000 + "!", "\x00", "é"]
    rows = []
    for conv in range(30):
        for _ in range(rng.randint(1, 12)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 5, 8]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts[:2] * 3 + texts)))
    rows += [(None, turn, "user", "Hm.") for turn in (None, 1, 1)]
    rows += [(77, 4, "user", "again.")] * 40 + [(77, 5 + i, "assistant", "again.") for i in range(40)]
    rows += [(99, turn, rng.choice(["user", "assistant"]), f"Turn {turn}.") for turn in range(700)]
    wide = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, n int, conv string")
    assert found(wide, RepairSpec(chunk_rows), SkewLimits(7)) == plain(rows)
    assert found(wide.limit(0)) == []


def test_one_conversation_is_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("5L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat(id, '.') as text")
    turns = faulty_turns(damaged(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # there is too little for several tasks
    try:
        pieces = chunks(turns, RepairSpec(100)).select(F.expr("shiftright(chunk, 40)").alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_task = Counter(row.task for row in pieces)
    assert len(per_task) > 4 and max(per_task.values()) * 100 < 20_000 * 0.5


def test_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "Hi."), (1, 2, "assistant", "You?"), (1, 3, "user", "Me.")], "conv_id long, turn long, role string, text string")
    repaired = repair(rows.selectExpr("*", "1L as n"))
    turns = [tuple(r) for r in repaired.turns().orderBy("at").collect()]
    summary = repaired.conversations().first()
    _, cost, audit, _, kept = plain_repair([("assistant", "Hi."), ("assistant", "You?"), ("user", "Me.")])
    assert (summary.cost, summary.audit) == (cost, audit)
    assert tuple(f"{t[2]}:{t[3]}" for t in turns) == kept
