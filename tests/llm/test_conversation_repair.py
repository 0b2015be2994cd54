import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from quillgraph.llm import conversation_repair as cr

from .helpers import rows

DDL = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(turns):
    """Every edit string in order of (cost, labels), by a heap over whole strings; turns: (turn, role, text), nulls as None."""
    turns = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in turns), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
    faults, seen = [], set()
    for _, role, text in turns:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in turns if t is not None]
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    head = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal)
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, initials, out = heapq.heappop(heap)
        if i == len(turns) and GRAMMAR.fullmatch(initials):
            return *head, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(), out
        viable = lambda s: re.fullmatch(r"s?(ua)*u?", s)
        for name in ("user", "assistant"):
            if viable(initials + name[0]):
                heapq.heappush(heap, (cost + 5, audit + "I", i, initials + name[0], (*out, f"{name}:")))
        if i < len(turns):
            _, role, text = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, initials, out))
            if faults[i] not in ("blank", "duplicate"):
                late = 5 * (faults[i] == "truncated")
                if role and viable(initials + role[0]):
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, initials + role[0], (*out, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if viable(initials + name[0]):
                        heapq.heappush(heap, (cost + 1 + late, audit + "R", i + 1, initials + name[0], (*out, f"{name}:{text}")))


def talks(seed, n):
    draw = random.Random(seed)
    out = []
    for conv in range(n):
        for _ in range(draw.randint(0, 8)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "uncle", "", None])
            text = draw.choice(["Yes.", "No!", "Why?", "cut of", "", " \n", None, f"Text {draw.random()}.", "é.\x0b"])
            out.append((conv if conv else None, draw.choice([None, 0, 1, 2, 3, 5, 9]), role, text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_plans_and_turns_agree_with_brute_force(spark, seed):
    data = talks(seed, 60)
    df = spark.createDataFrame(data, DDL).withColumn("conv", F.lit(1)).withColumn("_c", F.lit(2)).repartition(3)
    plans = cr.repair_plans(df, "conv_id", "turn", "role", "text")
    got = {r[0]: tuple(r[1:]) for r in rows(plans)}
    by_conv = {}
    for c, *rest in data:
        by_conv.setdefault(c, []).append(tuple(rest))
    assert got.keys() == by_conv.keys()
    lines = {}
    for r in sorted(cr.repaired_turns(df, plans, "conv_id", "turn", "role", "text").collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, turns in by_conv.items():
        want = brute(turns)
        assert got[c] == want[:-1], turns
        assert tuple(lines.get(c, ())) == want[-1]


def test_insertions_are_made_where_they_are_cheapest(spark):
    df = spark.createDataFrame([(1, i, "assistant", f"{i}.") for i in range(3)], DDL)
    costs = cr.Costs(rerole=9, delete=9, insert=1)
    (plan,) = rows(cr.repair_plans(df, "conv_id", "turn", "role", "text", costs=costs))
    assert plan[6:8] == (3, "IKIKIK")


def test_dropped_rows_name_their_conversation_and_empty_tables_give_none(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.", False), (2, 0, "user", "a.", True), (2, 1, "user", "b.", None)], DDL + ", kept boolean")
    got = {r[0]: r[1:] for r in rows(cr.repair_plans(df, "conv_id", "turn", "role", "text", present=F.col("kept")))}
    assert got == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()), 2: (0, 0, 0, 0, 0, 2, "D", hashlib.sha256().hexdigest())}
    none = df.limit(0)
    assert rows(cr.repair_plans(none, "conv_id", "turn", "role", "text")) == []
    assert rows(cr.repaired_turns(none, cr.repair_plans(none, "conv_id", "turn", "role", "text"), "conv_id", "turn", "role", "text")) == []


def test_long_conversation_with_one_repeated_text_and_a_very_long_one(spark):
    n = 20_000
    df = spark.range(n).selectExpr("7L as conv_id", "id as turn", "'user' as role", "case when id % 2 = 0 then 'Same.' else concat('t', id, '.') end as text")
    df = df.unionByName(spark.createDataFrame([(7, n, "assistant", "long " * 400_000 + ".")], DDL))
    (plan,) = rows(cr.repair_plans(df, "conv_id", "turn", "role", "text"))
    # Half the rows repeat one text and go; the rest alternate: every second one gets the other role.
    assert plan[3] == n // 2 - 1 and plan[6] == 2 * (n // 2 - 1) + n // 4
    assert len(plan[7]) == n + 1 and set(plan[7]) <= set("DKRI")


def test_damage_follows_the_checksum_of_conversation_and_turn(spark):
    import zlib

    data = [(c, t, "assistant", "A. b!") for c in (None, *range(30)) for t in (None, 0, 1)]
    got = {}
    for r in cr.damage(spark.createDataFrame(data, DDL)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.kept))
    for c, t, role, text in data:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        one = ("user" if k == 4 else role, "" if k == 1 else "A b" if k == 2 else text, k != 0)
        assert got[c, t] == [one] * (2 if k == 3 else 1)
