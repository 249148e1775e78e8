"""Conversation repair against every repair of small conversations, and a plain reading of the whole contract."""

import functools
import hashlib
import random
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from clicklens.llm import conversation_repair as C
from clicklens.llm.queries import op13_conversation_repair
from llm_tools import frame

SCHEMA = "conv_id long, turn long, role string, text string"
NEVER = C.INFINITE
sys.setrecursionlimit(20_000)  # the plain search goes down once for each row


def cheapest(kinds, faults):
    """(cost, audit) by trying every edit; three inserts at one place are never needed."""
    @functools.lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(kinds) and state in "-a" else []
        to = "a" if state == "u" else "u"

        def add(letter, cost, rest):
            found.append((cost + rest[0], letter + rest[1]))

        if inserted < 3:
            add("I", 3, best(i, to, inserted + 1))
        if i < len(kinds):
            add("D", 4, best(i + 1, state, 0))
            if faults[i] not in "bd":
                extra = 3 if faults[i] == "t" else 0
                if kinds[i] == to or (kinds[i] == "s" and state == "-"):
                    add("K", extra, best(i + 1, kinds[i], 0))
                add("R", 3 + extra, best(i + 1, to, 0))
        return min(found) if found else (10 ** 9, "")

    return best(0, "-", 0)


def random_rows(rng, n):
    kinds = "".join(rng.choice("suax" if rng.random() < .5 else "ua") for _ in range(n))
    return kinds, "".join(rng.choice("----bdt") for _ in range(n))


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(3)
    for n in range(9):
        for _ in range(60):
            kinds, faults = random_rows(rng, n)
            cost, audit, _ = C.search(kinds, faults, C.START, [0, NEVER, NEVER, 0])
            assert (cost, audit) == cheapest(kinds, faults)


def test_pieces_give_the_repair_of_the_whole():
    rng = random.Random(4)
    for n in range(1, 9):
        for size in (1, 2, 3):
            kinds, faults = random_rows(rng, n)
            pieces = [C.Piece(list(kinds[i:i + size]), list(faults[i:i + size])).repairs(False)
                      for i in range(0, n, size)]
            assert C.joined(pieces) == cheapest(kinds, faults)


@pytest.mark.parametrize("kinds", ["u" * 3000, "s" * 3000, "x" * 3000, "a" * 3000, "ua" * 1500])
def test_long_conversations_take_steps_in_proportion(kinds):
    cost, audit, _ = C.search(kinds, "-" * len(kinds), C.START, [0, NEVER, NEVER, 0])
    assert len(audit) >= len(kinds) and cost <= 4 * len(kinds)


def plain(rows, damage=True):
    """The contract, read row by row: {conv_id: the columns of the query}."""
    def text_of(v):
        return " " if v is None else str(v)

    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        spot = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20 if damage else 19
        role, text = text_of(role), text_of(text)
        if spot == 0:
            continue
        text = "" if spot == 1 else "".join(c for c in text if c not in ".!?") if spot == 2 else text
        own += [(turn, "user" if spot == 4 else role, text)] * (2 if spot == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), ""
        for _, role, text in own:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults += "b" if not shown else "d" if (role, text) in seen else "-" if shown[-1] in ".!?" else "t"
            seen.add((role, text))
        kinds = [r[1][:1] for r in own]
        turns = [r[0] for r in own if r[0] is not None]
        cost, audit = cheapest(kinds, faults)
        state, at, kept = "-", iter(own), []
        for letter in audit:
            if letter == "I":
                state = "a" if state == "u" else "u"
                kept.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, role, text = next(at)
            if letter == "K":
                state = role[0]
                kept.append(f"{role}:{text}")
            elif letter == "R":
                state = "a" if state == "u" else "u"
                kept.append({"u": "user:", "a": "assistant:"}[state] + text)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"),
                     faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])), cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def read(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query_equals_the_plain_reading(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert read(op13_conversation_repair(spark, sf)) == plain(rows)


CASES = [
    (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, 2, "assistant", None), (1, None, None, "Yes."),
    (1, 5, "tool", "Done."), (1, 7, "assistant", "No end"), (None, 1, "user", ""), (None, 3, "assistant", "Ok!"),
    (None, None, "system", "Be kind."), (2, 1, "", "x."), (3, None, "user", " \t\n"), (4, 1, "user", " "),
    (5, 3, "system", "a."), (6, -2, "assistant", "b?"), (6, 9, "user", "b? \r\n"),
]


@pytest.mark.parametrize("size", [1, 2, 1024])
def test_defined_cases(spark, size):
    given = frame(spark, SCHEMA, CASES)
    assert read(C.repair(given, size=size)) == plain(CASES, damage=False)
    assert read(C.repair(C.damaged(given), every=given, size=size)) == plain(CASES)


def test_long_conversation_over_pieces_and_partitions(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
             rng.choice(["Fine.", f"Line {t}.", f"Open {t}", ""])) for t in range(400)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Hi!")]
    assert read(C.repair(frame(spark, SCHEMA, rows).repartition(5), size=16)) == plain(rows, damage=False)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C.")]
    got = C.repaired(frame(spark, SCHEMA, rows)).orderBy("position").collect()
    assert [(r.role, r.text, r.edit) for r in got] == [
        ("user", "A.", "K"), ("assistant", "", "I"), ("user", "B.", "K"), ("assistant", "C.", "K")]


def test_extra_columns_and_empty_table(spark):
    given = frame(spark, SCHEMA, CASES)
    more = given.withColumn("cost", F.lit("x")).withColumn("audit", F.lit(1)).withColumn("conv", F.lit(2)).withColumn(
        "what", F.lit(0))
    assert read(C.repair(more)) == plain(CASES, damage=False)
    assert C.repair(given.where("false")).collect() == []
    assert read(C.repair(given.where("false"), every=given.where("conv_id = 1"))) == {
        1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
