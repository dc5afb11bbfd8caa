"""Conversation repair against every edit script, in blocks, edge rows."""

import hashlib
import itertools
import random
import zlib

from pyspark.sql import functions as F

from lakeops.llm import conversations
from lakeops.llm.registry import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, g string, pos string, known string"
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
WS = " \t\n\x0b\x0c\r"


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(WS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def script(rows, kinds, edits):
    """(cost, lines) of an edit script, None where it gives no legal conversation."""
    n, lines, cost, left = sum(e != "D" for e in edits), [], 0, iter(zip(rows, kinds))
    if n == 1:                                    # a system turn alone
        return None
    for e in edits:
        (_, role, text), kind = ((None, "", ""), "") if e == "I" else next(left)
        if e == "D":
            cost += 4
            continue
        if kind in ("blank", "duplicate"):
            return None
        cost += {"K": 0, "R": 3, "I": 3}[e] + 3 * (kind == "truncated")
        at = len(lines) - n % 2
        want = "system" if at < 0 else ("user", "assistant")[at % 2]
        if e == "K" and role[:1] != want[0] or e != "K" and at < 0:
            return None
        lines.append(f"{role if e == 'K' else want}:{text}")
    return cost, lines


def brute(rows):
    """What repair() gives for one conversation, by every script with at most two
    insertions at a place (a third is never needed)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    kinds, best = faults(rows), None
    for cuts in itertools.product(range(3), repeat=len(rows) + 1):
        for own in itertools.product("KRD", repeat=len(rows)):
            edits = "".join("I" * c + e for c, e in zip(cuts, own)) + "I" * cuts[-1]
            if (got := script(rows, kinds, edits)) and (best is None or (got[0], edits) < best[:2]):
                best = (got[0], edits, got[1])
    turns = {t for t, *_ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), best[0], best[1],
            hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def random_rows(r, n):
    roles, texts = ["user", "assistant", "system", "tool", "user", "assistant", "", "Uber"], ["a.", "b!", "c", " ", "d?\n", "e"]
    return [(None if r.random() < 0.1 else r.randrange(6), r.choice(roles), r.choice(texts)) for _ in range(n)]


def test_repair_is_the_least_edit_script(spark, monkeypatch):
    r = random.Random(5)
    convs = {i: random_rows(r, r.randrange(0, 6)) for i in range(60)}
    convs[None] = random_rows(r, 4)
    rows = [(c, *x, "a", "b", "c") for c, own in convs.items() for x in own]
    rows += [(c, 9, "user", "gone", "", "", "") for c, own in convs.items() if not own]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {c: brute(own) for c, own in convs.items()}
    present = F.coalesce(F.col("text"), F.lit("")) != "gone"
    for block in (conversations.BLOCK, 2):
        monkeypatch.setattr(conversations, "BLOCK", block)
        monkeypatch.setattr(conversations, "MERGE", 2)
        got = {x["conv_id"]: tuple(x[f] for f in FIGURES) for x in conversations.repair(docs, present).collect()}
        assert got == want


def test_blocks_of_a_long_conversation_give_the_result_of_one(spark, monkeypatch):
    r = random.Random(6)
    rows = [(1, *x, "", "", "") for x in random_rows(r, 150)] + [(2, i, "user" if i % 2 else "system", f"x{i % 7}.", "", "", "")
                                                                for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(conversations.repair(docs).collect())
    monkeypatch.setattr(conversations, "BLOCK", 8)
    monkeypatch.setattr(conversations, "MERGE", 3)
    assert sorted(conversations.repair(docs).collect()) == want


def test_nulls_very_long_texts_and_empty_tables(spark):
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, None, "", "", ""), (1, 1, "user", "x" * 3_000_000 + ".", "", "", ""), (None, None, None, "ok.", "", "", "")]
    got = {x["conv_id"]: x for x in conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["audit"] == "DKI" and got[1]["blank"] == 1 and got[1]["gaps"] == 0 and got[1]["illegal"] == 1
    assert got[1]["cost"] == 7 and got[None]["cost"] == 4 and got[None]["audit"] == "D"
    got = conversations.damage(spark.createDataFrame(rows, SCHEMA)).collect()
    kind = zlib.crc32(b" : ") % 20
    assert [x["text"] for x in got if x["conv_id"] is None] == {1: [""], 2: ["ok"], 3: ["ok."] * 2}.get(kind, ["ok."])


def test_query_on_sf0001(spark):
    from tests.conftest import SF001
    rows = spark.read.parquet(f"{SF001}/conversations.parquet").collect()
    convs = {}
    for r in rows:
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        own = convs.setdefault(r["conv_id"], [])
        text = {1: "", 2: r["text"].translate(str.maketrans("", "", ".!?"))}.get(kind, r["text"])
        own += [(r["turn"], "user" if kind == 4 else r["role"], text)] * {0: 0, 3: 2}.get(kind, 1)
    got = {x["conv_id"]: tuple(x[f] for f in FIGURES) for x in QUERIES["op12_conversation_repair"](spark, SF001).collect()}
    assert set(got) == set(convs)
    for c, own in convs.items():
        if len(own) <= 5:
            assert got[c] == brute(own)
