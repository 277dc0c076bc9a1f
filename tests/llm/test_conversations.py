"""Conversation repair against a plain version that tables the cheapest edits forward."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stackyard.llm import conversations as C
from stackyard.llm import queries

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def plain_edits(rows):
    """(cost, audit, repaired rows) by a table of the best (cost, audit) for each
    number of rows read and each sequence state, inserting at most three rows in a gap."""
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    table = {"": (0, "", ())}

    def better(t, q, c):
        if q not in t or c[:2] < t[q][:2]:
            t[q] = c

    def inserts(t):
        for _ in range(3):
            for q, (cost, audit, kept) in list(t.items()):
                r = nxt[q]
                better(t, r, (cost + 3, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[r], ""))))
        return t

    table = inserts(table)
    for role, text, fault in rows:
        new = {}
        for q, (cost, audit, kept) in table.items():
            better(new, q, (cost + 4, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            first = role[:1]
            if first == nxt[q] or first == "s" and q == "":
                better(new, first, (cost + extra, audit + "K", (*kept, (role, text))))
            r = nxt[q]
            better(new, r, (cost + 3 + extra, audit + "R", (*kept, ({"u": "user", "a": "assistant"}[r], text))))
        table = inserts(new)
    return min((table[q] for q in ("", "a") if q in table), key=lambda c: c[:2])


def plain_report(rows, harm=True):
    """rows: (conv_id, turn, role, text) -> what op12 returns, by conversation."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        said = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(said.encode()) % 20 if harm else 9
        role, text = " " if role is None else role, " " if text is None else text
        talks[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        talks[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, judged = set(), []
        for _, role, text in talk:
            body = text.strip(SPACES)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, kept = plain_edits(judged)
        assert PATTERN.match("".join(r[:1] for r, _ in kept))
        turns = [t for t, _, _ in talk if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, _, f in judged]
        initials = [r[:1] for _, r, _ in talk]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha)
    return out


def report(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", range(300))
def test_search_is_cheapest_and_ascii_least(seed):
    rnd = random.Random(seed)
    n = rnd.randint(0, 14) if seed % 10 else rnd.randint(40, 90)
    symbols = bytes(4 * rnd.choice([0, 1, 1, 2, 2, 3]) + rnd.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n))
    names = ["system", "user", "assistant", "tool"]
    rows = [(names[s // 4], "x", ["", "blank", "duplicate", "truncated"][s % 4]) for s in symbols]
    assert C.search(symbols) == plain_edits(rows)[:2]


def test_estimates_are_never_above_the_cost():
    rnd = random.Random(5)
    for _ in range(200):
        symbols = bytes(4 * rnd.randint(0, 3) + rnd.choice([0, 0, 1, 2, 3]) for _ in range(rnd.randint(1, 9)))
        assert C.estimates(symbols)[0][C.START] <= C.search(symbols)[0]


def test_long_conversation_is_searched_in_linear_time():
    rnd = random.Random(1)
    symbols = bytes(4 * rnd.choice([0, 1, 2, 3]) + rnd.choice([0, 0, 1, 2, 3]) for _ in range(20_000))
    cost, audit = C.search(symbols)
    assert sum(c != "I" for c in audit) == 20_000 and cost >= C.estimates(symbols)[0][0]


def test_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert report(queries.op12_conversation_repair(spark, SF)) == plain_report(table)


ODD = ([(1, t, r, x) for t, r, x in ((0, "system", "Be nice."), (1, "user", "Hi."), (2, "assistant", "Yes?"), (2, "assistant", "Yes?"), (9, None, "end."))]
       + [(None, 0, "user", "a."), (None, None, "assistant", None), (2, None, None, None), (2, None, "user", "b."), (2, 5, "", "c!"), (2, 5, "", "c!"),
          (3, 1, "user", " \n\t "), (3, 2, "assistant", "tail 　"), (3, 2, "assistant", "so. \n"), (4, -3, "sys", "x" * 200_000 + "!"), (4, 7, "urgent", "ñ😀.\x0b")]
       + [(5, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(400)] + [(6, 3, "tool", "only.")] * 3)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in ODD], "conv_id long, turn int, role string, text string, audit string, symbol int")


@pytest.mark.parametrize("harm", [True, False])
def test_odd_rows(spark, odd, harm):
    rows = (C.damaged if harm else C.as_rows)(odd)
    assert report(C.repair_report(rows)) == plain_report(ODD, harm)


def test_partitions_do_not_matter(spark, odd):
    want = report(C.repair_report(C.damaged(odd)))
    assert report(C.repair_report(C.damaged(odd.repartition(7, "text")))) == want


def test_repaired_rows_have_the_audit_s_roles(spark, odd):
    rows = C.damaged(odd)
    plans = C.plan_repairs(rows)
    audits = {r["conv_id"]: r["audit"] for r in plans.collect()}
    talks = defaultdict(list)
    for r in sorted(C.repaired_rows(rows, plans).collect(), key=lambda r: r["place"]):
        talks[r["conv_id"]].append(r)
    for conv, audit in audits.items():
        assert "".join(r["edit"] for r in talks[conv]) == audit.replace("D", "")
        assert PATTERN.match("".join(r["role"][:1] for r in talks[conv]))


def test_every_conversation_is_returned_also_without_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn int, role string, text string")
    assert report(C.repair_report(C.damaged(df))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark, odd):
    assert C.repair_report(C.damaged(odd.limit(0))).collect() == []
    assert C.repaired_rows(C.damaged(odd.limit(0)), C.plan_repairs(C.damaged(odd.limit(0)))).where(F.lit(True)).count() == 0
