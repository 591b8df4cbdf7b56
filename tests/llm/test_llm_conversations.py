"""Conversation repair against a forward programme over whole prefixes."""

import hashlib
import random
import zlib

import edge
import pytest
from pyspark.sql import functions as F

ROW = "conv_id long, turn long, role string, text string"
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
NAME = {2: "user", 3: "assistant"}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        rest = out.setdefault(conv, [])
        role, text = [" " if x is None else x for x in (role, text)]
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 else text
        rest += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def with_inserts(best):
    out = {}
    for state, (cost, audit, lines) in best.items():
        for _ in range(4):
            if state not in out or (cost, audit) < out[state][:2]:
                out[state] = cost, audit, lines
            state = AFTER[state]
            cost, audit, lines = cost + 3, audit + "I", (*lines, f"{NAME[state]}:")
    return out


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    best, seen, counts, before = {0: (0, "", ())}, set(), [0, 0, 0, 0], None
    for _, role, text in rows:
        solid = text.strip(SPACE)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 4
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        counts[3] += before is not None and before + role[:1] not in ("su", "ua", "au")
        before, new = role[:1], {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            ways = [(state, cost + 4, audit + "D", lines)]
            if fault >= 2:
                more, to = 3 * (fault == 2), AFTER[state]
                ways.append((to, cost + 3 + more, audit + "R", (*lines, f"{NAME[to]}:{text}")))
                if (state, role[:1]) in KEPT:
                    ways.append((KEPT[state, role[:1]], cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for to, *way in ways:
                if to not in new or tuple(way[:2]) < new[to][:2]:
                    new[to] = tuple(way)
        best = new
    ends = with_inserts(best)
    cost, audit, lines = min(ends[s] for s in (0, 3) if s in ends)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def sample(n=400, convs=40, seed=3):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]
    texts = ["Yes.", "No!", "maybe", "", "  ", None, "why? ", "x" * 90 + "a.", "x" * 90 + "b.", "end.\n", "été"]
    rows = [(r.randrange(convs), r.choice([None, *range(9)]), r.choice(roles), r.choice(texts)) for _ in range(n)]
    long = [(1000, i, r.choice(roles[:4]), f"{r.randrange(600)} word{r.choice(['.', ''])}") for i in range(900)]
    same = [(1001, 5, "user", "all the same.")] * 300
    return rows + long + same + [(None, i, "user", "Hi.") for i in range(4)] + [(2000, 17, "user", "gone?")]


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("base,per_task", [(256, 200_000), (3, 40)])
def test_report_is_the_brute_force(spark, base, per_task):
    from daycast.llm.conversations import damage, repair
    rows = sample()
    df = spark.createDataFrame(rows, ROW).repartition(5).withColumns({k: F.lit(1) for k in edge.CLASH if k not in ("text",)})
    after = damaged(rows)
    want = key([(k, *brute(v)) for k, v in after.items()])
    got = repair(damage(df), gone="gone", texts=True, base=base, rows_per_task=per_task)
    assert key([tuple(x) for x in got.where("last").select(COLUMNS).collect()]) == want
    # the parts' rows hash to the digest
    for r in got.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "roles", "texts"))).alias("p"),
                                        F.max("repaired_sha256").alias("h")).collect():
        lines = [f"{a}:{b}" for p in r["p"] for a, b in zip(p["roles"], p["texts"])]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == r["h"]


def test_steps_agree_with_the_matrix():
    from daycast.llm import conversations as C
    r = random.Random(1)
    for _ in range(200):
        codes = bytes(r.randrange(0, 9) for _ in range(r.randrange(0, 30)))
        at = r.randrange(0, len(codes) + 1)
        total, vectors = C._vectors(codes, C.AT_END)
        more, back = C._vectors(codes[at:], C.AT_END)
        m = C._matrix(codes[:at])
        for s in range(4):
            if at:
                assert min(m[4 * s + t] + more + back[0][t] for t in range(4)) == total + vectors[0][s]
    assert len(C._steps) < 20_000


def test_empty_and_lost_conversations(spark):
    from daycast.llm.conversations import repair, repair_report
    df = spark.createDataFrame(sample(5), ROW)
    assert repair_report(df.limit(0)).count() == 0
    lost = [(c, t, "user", "x.") for c in range(5) for t in range(60) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = repair_report(spark.createDataFrame(lost, ROW)).collect()
    assert sorted(x["conv_id"] for x in got) == sorted({c for c, *_ in lost})
    assert {tuple(x)[1:] for x in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    plain = repair(spark.createDataFrame([("a", 1, "assistant", "Hello.")], "conv_id string, turn int, role string, text string"))
    assert [x["audit"] for x in plain.where("last").collect()] == ["IK"]
    assert [r for x in plain.orderBy("part").collect() for r in x["roles"]] == ["user", "assistant"]
