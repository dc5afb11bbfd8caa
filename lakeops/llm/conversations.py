"""Repair of the structure of conversations by weighted interval parsing.

The roles of a whole conversation read ``(s?(ua)+)?``: an optional system turn, then
user and assistant in turn.  As a grammar in Chomsky normal form this has a
nonterminal [p>q] for each two states of reading (nothing yet, after s, after u,
after a), the rules [p>q] -> [p>r] [r>q], and terminal rules that read one turn at
the price of an edit: Keep (its initial leads from p to q), Rerole to user or
assistant, Delete (p = q).  Inserted turns read no input; their closure (the cheapest
insertions from p to q, however many) is part of every terminal rule.

A cell holds for a span of turns and each [p>q] the least (cost, audit), audit being
the edits' initials.  Cells are combined bottom-up by span length.  The rules are
closed under concatenation, so the two halves of a span give the same least cell as
all its splits: spans of 1, 2, 4, ... turns are enough, n cells in place of n squared.
(Two parses of a span with equal costs are never one a prefix of the other, as the
longer one would have paid for its insertions, so the least part makes the least whole.)

A conversation of up to ``BLOCK`` turns is repaired where it has been gathered.  A
longer one is dealt by place into blocks; the cells of blocks are combined in rounds,
the audit is cut into the blocks' slices, and only the digest, which is serial by
its nature, streams the blocks of a conversation through one task in order.

Cases: a null role or text counts as one space; null turns come first and equal turns
by role, then text; a null conv_id is a conversation of its own; conversations
without turns give zeros and the digest of an empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lakeops.llm._common import map_slices, stored
from lakeops.llm.places import ranked

SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
READ = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}

BLOCK = 256          # turns gathered in one row
MERGE = 64           # cells combined in one row
SLICE = 16           # conversations or blocks that a Python worker unpacks at a time


# ---- grammar and cells

def combined(x: tuple, y: tuple) -> tuple:
    """The cell of a span from those of its two parts: [p>q] -> [p>r] [r>q]."""
    out = []
    for p in STATES:
        for q in STATES:
            out.append(min(((a[0] + b[0], a[1] + b[1]) for r in STATES
                            if (a := x[4 * p + r]) and (b := y[4 * r + q])), default=None))
    return tuple(out)


def closure() -> tuple:
    """The least insertions that lead from p to q."""
    none = tuple((0, "") if p == q else None for p in STATES for q in STATES)
    one = tuple((INSERT, "I") if any(READ.get((p, x)) == q for x in NAMES) else None for p in STATES for q in STATES)
    best = step = none
    for _ in STATES:
        step = combined(step, one)
        best = tuple(min((c for c in pair if c), default=None) for pair in zip(best, step))
    return best


INSERTED = closure()


@lru_cache(maxsize=64)
def turn_cell(code: str) -> tuple:
    """The cell of one turn: insertions, then its edit.  ``code``: its initial (``.``
    for others), in upper case or ``!`` where it is truncated, ``-`` where it must go."""
    rules: dict = {(p, p): [(DELETE, "D")] for p in STATES}
    if code != "-":
        more = TRUNCATED if code in "SUA!" else 0
        for (p, x), q in READ.items():
            if x == code.lower():
                rules.setdefault((p, q), []).append((more, "K"))
            if x in NAMES:
                rules.setdefault((p, q), []).append((REROLE + more, "R"))
    return combined(INSERTED, tuple(min(rules.get((p, q), [None])) for p in STATES for q in STATES))


@lru_cache(maxsize=20_000)
def _pair(left: str, right: str) -> tuple:
    """The cell of a short span: conversations repeat the same few patterns."""
    return combined(parsed(left), parsed(right))


def parsed(codes: str) -> tuple:
    """The cell of the span of turns ``codes``: spans of 1, 2, 4, ... bottom-up."""
    if len(codes) == 1:
        return turn_cell(codes)
    if len(codes) <= 16:
        half = 1 << ((len(codes) - 1).bit_length() - 1)
        return _pair(codes[:half], codes[half:])
    cells = [parsed(codes[i:i + 16]) for i in range(0, len(codes), 16)]
    return merged_cells(cells)


def merged_cells(cells: list[tuple]) -> tuple:
    while len(cells) > 1:
        cells = [combined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def closed(cell: tuple) -> tuple[int, str]:
    """(cost, audit) of a whole conversation: insertions at the end, states that end."""
    cell = combined(cell, INSERTED)
    return min(cell[4 * START + q] for q in ENDS if cell[4 * START + q])


# ---- a block of turns

def summary(turns: list, roles: list[str], texts: list[str], again: list[bool]) -> dict:
    """What a block of consecutive turns adds to its conversation; ``again``: the turn
    repeats an earlier one."""
    codes, count = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text, dup in zip(roles, texts, again):
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if dup else "truncated" if bare[-1] not in ".!?" else None
        if fault:
            count[fault] += 1
        first = role[:1] if role[:1] in ("s", "u", "a") else "."
        codes.append("-" if fault in ("blank", "duplicate") else
                     first if not fault else "!" if first == "." else first.upper())
    known = [t for t in turns if t is not None]
    return {**count, "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:])),
            "first": roles[0][:1], "last": roles[-1][:1], "low": min(known, default=None), "high": max(known, default=None),
            "distinct": len(set(known)), "cell": parsed("".join(codes))}


def merged(parts: list[dict]) -> dict:
    """The summary of consecutive blocks (by turn, so equal turns stand next to each other)."""
    out = dict(parts[0])
    for x in parts[1:]:
        for k in ("blank", "duplicate", "truncated"):
            out[k] += x[k]
        out["illegal"] += x["illegal"] + (out["last"] + x["first"] not in LEGAL)
        out["distinct"] += x["distinct"] - (out["high"] is not None and out["high"] == x["low"])
        out["low"] = x["low"] if out["low"] is None else out["low"]
        out["high"] = out["high"] if x["high"] is None else x["high"]
        out["last"] = x["last"]
    return {**out, "cell": merged_cells([x["cell"] for x in parts])}


def figures(s: dict | None) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit)"""
    if s is None:
        return 0, 0, 0, 0, 0, 0, ""
    cost, audit = closed(tuple(c and tuple(c) for c in s["cell"]))
    gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["distinct"]
    return gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost, audit


def written(roles: list[str], texts: list[str], edits: str, at: int, odd: bool) -> list[str]:
    """``role:text`` of what the edits leave of some turns; ``at``: turns of the repaired
    conversation before them, ``odd``: it has a system turn."""
    out, rows = [], zip(roles, texts)
    for e in edits:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        if e != "K":
            role = NAMES["ua"[(at + len(out) - odd) % 2]]
        out.append(f"{role}:{text}")
    return out


def kept(audit: str) -> int:
    return len(audit) - audit.count("D")


# ---- on Spark

def structs(lists: pa.ListArray) -> list[pa.StructArray]:
    return [lists.values.slice(a, b - a) for a, b in zip(lists.offsets.to_pylist(), lists.offsets.to_pylist()[1:])]


def columns(rows: pa.StructArray, *names: str) -> list[list]:
    return [rows.field(n).to_pylist() for n in names]


FIGURES = [StructField(n, LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    StructField("audit", StringType())]


def short(rows: DataFrame) -> DataFrame:
    """Conversations of up to BLOCK turns, each gathered in one row."""
    turns = rows.groupBy("g").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(
        F.when(F.col("present"), F.struct("known", "turn", "role", "text")))).alias("turns")).drop("g")

    def make():
        def step(batch):
            out = []
            for own in structs(batch.column(1)):
                when, roles, texts = columns(own, "turn", "role", "text")
                seen, again = set(), []
                for x in zip(roles, texts):
                    again.append(x in seen)
                    seen.add(x)
                got = figures(summary(when, roles, texts, again) if roles else None)
                text = "\n".join(written(roles, texts, got[-1], 0, kept(got[-1]) % 2 == 1))
                out.append((*got, hashlib.sha256(text.encode()).hexdigest()))
            return [batch.column(0), *map(list, zip(*out))]
        return step

    return map_slices(turns, make, StructType([turns.schema["conv_id"], *FIGURES, StructField("repaired_sha256", StringType())]),
                      SLICE)


def long(rows: DataFrame) -> DataFrame:
    """Conversations of any length, in blocks of BLOCK turns."""
    rows = stored(rows.filter("present").withColumn("row", F.monotonically_increasing_id())
                  .withColumn("same", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)),
                  "turns")
    placed = stored(ranked(rows, "g", ["known", "turn", "role", "text", "row"], "turns"), "turns-placed")
    first = (placed.groupBy(F.col("g").alias("_g"), F.col("same").alias("_same"))
             .agg(F.min("pos").alias("_first"), F.count("*").alias("_n")).filter("_n > 1"))
    turns = (placed.join(first, (F.col("g") == F.col("_g")) & (F.col("same") == F.col("_same")), "left")
             .groupBy("g", F.floor(F.col("pos") / BLOCK).cast("long").alias("b"))
             .agg(F.first("conv_id").alias("conv_id"), F.first("total").alias("total"), F.sort_array(F.collect_list(
                 F.struct("pos", "turn", "role", "text", F.coalesce(F.col("pos") > F.col("_first"), F.lit(False))
                          .alias("again")))).alias("turns")))

    def summed():
        def step(batch):
            out = []
            for own in structs(batch.column(4)):
                out.append(json.dumps(summary(*columns(own, "turn", "role", "text", "again"))))
            return [*batch.columns, out]
        return step

    blocks = stored(map_slices(turns, summed, StructType([*turns.schema.fields, StructField("part", StringType())]), SLICE),
                    "turns-blocks")

    def joined():
        def step(batch):
            return [batch.column(0), batch.column(1),
                    [json.dumps(merged([json.loads(p) for p in own.field("part").to_pylist()]))
                     for own in structs(batch.column(2))]]
        return step

    parts, most = blocks.select("g", "b", "part"), -(-(blocks.agg(F.max("total")).first()[0] or 1) // BLOCK)
    while most > 1:
        most = -(-most // MERGE)
        up = parts.groupBy("g", F.floor(F.col("b") / MERGE).cast("long").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("b", "part"))).alias("parts"))
        parts = stored(map_slices(up, joined, StructType([StructField("g", StringType()), StructField("b", LongType()),
                                                          StructField("part", StringType())]), 1), "turns-cells")

    def ended():
        def step(batch):
            return [batch.column(0), *map(list, zip(*[figures(json.loads(p)) for p in batch.column(1).to_pylist()]))]
        return step

    whole = stored(map_slices(parts.select("g", "part"), ended, StructType([StructField("g", StringType()), *FIGURES]), 1),
                   "turns-audits")

    def cut():
        def step(batch):
            out = [[], [], [], [], []]
            for g, audit in zip(*[c.to_pylist() for c in batch.columns]):
                odd, at, start, read, end = kept(audit) % 2, 0, 0, 0, len(audit.rstrip("I"))
                for i, e in enumerate(audit):
                    read += e != "I"
                    if e != "I" and (read % BLOCK == 0 or i == end - 1):
                        stop = i + 1 if i < end - 1 else len(audit)
                        for k, v in enumerate((g, (read - 1) // BLOCK, audit[start:stop], at, odd)):
                            out[k].append(v)
                        at, start = at + kept(audit[start:stop]), stop
            return out
        return step

    slices = map_slices(whole.select("g", "audit"), cut, StructType([
        StructField("_g", StringType()), StructField("_b", LongType()), StructField("edits", StringType()),
        StructField("at", LongType()), StructField("odd", IntegerType())]), 1)

    def worded():
        def step(batch):
            texts = []
            for own, edits, at, odd in zip(structs(batch.column(2)), *[batch.column(i).to_pylist() for i in (3, 4, 5)]):
                lines = written(*columns(own, "role", "text"), edits, at, odd == 1)
                texts.append("\n".join(lines) if lines else None)
            return [batch.column(0), batch.column(1), texts]
        return step

    pieces = map_slices(
        blocks.join(slices, (F.col("g") == F.col("_g")) & (F.col("b") == F.col("_b"))).select("g", "b", "turns", "edits", "at", "odd"),
        worded, StructType([StructField("g", StringType()), StructField("b", LongType()), StructField("text", StringType())]), SLICE)

    names, types = ["h", "repaired_sha256"], [pa.string(), pa.string()]

    def hashed(batches):
        """Streams the pieces of each conversation, in order, into its digest."""
        of, state, empty = None, None, True
        for batch in batches:
            done = []
            for g, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if g != of:
                    if state:
                        done.append((of, state.hexdigest()))
                    of, state, empty = g, hashlib.sha256(), True
                if text is not None:
                    state.update((text if empty else "\n" + text).encode())
                    empty = False
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((of, state.hexdigest()), types)], names)

    digests = (pieces.repartition("g").sortWithinPartitions("g", "b").select("g", "text")
               .mapInArrow(hashed, "h string, repaired_sha256 string"))
    ids = blocks.filter("b = 0").select(F.col("g").alias("i"), "conv_id")
    return (whole.join(ids, F.col("g") == F.col("i")).join(digests, F.col("g") == F.col("h"))
            .select("conv_id", *[f.name for f in FIGURES], "repaired_sha256"))


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """One row a conversation of ``turns`` (conv_id, turn, role, text): gaps, blank,
    duplicate, truncated, illegal, cost, audit and repaired_sha256, the digest of its
    repaired ``role:text`` lines.  Rows that are not ``present`` only name their
    conversation."""
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("g"), "conv_id",
        (F.lit(True) if present is None else present).alias("present"), F.col("turn").isNotNull().alias("known"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    many = stored(rows.groupBy("g").agg(F.count_if("present").alias("n")).filter(F.col("n") > BLOCK)
                  .select(F.col("g").alias("_g")), "turns-many")
    few = short(rows.join(many, F.col("g") == F.col("_g"), "left_anti"))
    if not many.limit(1).count():
        return few
    return few.unionByName(long(rows.join(many, F.col("g") == F.col("_g"), "left_semi")))


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults put in by crc32(``conv_id:turn``) modulo 20: 0 drops the
    row (``present`` is false), 1 empties its text, 2 takes its ``.!?`` out, 3 repeats
    it, 4 makes its role user.  Nulls count as one space."""
    at = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                  F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(at), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 0, F.array(F.lit(False))).when(kind == 3, F.array(F.lit(True), F.lit(True)))
                  .otherwise(F.array(F.lit(True)))).alias("present"))
