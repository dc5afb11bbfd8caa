"""Removal of long word sequences that stand in an earlier document.

Each word goes that a window of ``window`` consecutive words covers whose words also
stand, in order, somewhere in a document with a smaller doc_id; windows are judged on
the input.  Words are runs of characters other than ASCII white space.

Shards hold passages that can meet.  Of the word grams in a window the one with the
least hash is its anchor, which depends on the window's words alone, so equal windows
have equal anchors.  A run of consecutive windows with one anchor is a passage (some 70
words).  Anchors of a single document go; equal passages are reduced to the earliest
document that has them, copies in later documents being covered whole; passages of an
anchor that has others too are dealt by anchor into shards.  A shard builds an FM-index
of its passages (``fm_index``), streams them through it by backward search, and reports
the intervals whose matching statistics against earlier documents reach the window.
The intervals go back to the documents by passage.

An anchor of more than ``LIMIT`` different passages (a phrase that very many documents
have, each with words of its own around it) would make its shard too large.  Its
passages are cut into single windows instead, and equal windows meet by their digests:
the same result, in rows that any number of tasks can share.

Cases: a null text has no words; rows with a null doc_id neither remove nor lose
words; rows of one doc_id never remove each other's words and are told apart by their
texts; repeated rows each get the same result; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lakeops.llm._common import map_slices, stored
from lakeops.llm.fm_index import FMIndex

WINDOW = 50
GRAM = 8                       # words of an anchor
RUN = 40                       # windows of a passage at most
LIMIT = 8192                   # passages of an anchor in a shard at most
SHARD_WORDS = 300_000          # words of a shard, on average
SLICE = 256                    # documents that a Python worker unpacks at a time
CHUNK = 1 << 20                # bytes hashed at a time

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPANS = ArrayType(StructType([StructField("from", IntegerType()), StructField("to", IntegerType())]))


def mixed(h: np.ndarray) -> np.ndarray:
    """Numbers whose bits all depend on all bits of ``h``."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Powers:
    """Powers of the base and of its inverse modulo 2 ** 64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = [np.multiply.accumulate(np.concatenate(
                [np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)])) for x in (_BASE, inverse)]
        return self.up, self.down


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, powers: Powers) -> np.ndarray:
    """A hash of each word data[start:stop], some CHUNK bytes at a time."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(int(np.searchsorted(stops, starts[i] + CHUNK)), i + 1)
        at = starts[i]
        part = data[at:stops[j - 1]].astype(np.uint64) + np.uint64(1)
        up, down = powers(len(part) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)], dtype=np.uint64)])
        out[i:j] = (total[stops[i:j] - at] - total[starts[i:j] - at]) * down[starts[i:j] - at]
        i = j
    return mixed(out)


def anchors(words: np.ndarray, window: int) -> np.ndarray:
    """The least hash of the grams of every window of consecutive words."""
    gram = min(GRAM, window)
    g, size = words, 1
    while size < gram:                                  # grams of twice the words, then of the rest
        step = min(size, gram - size)
        g = mixed(g[:-step] * _BASE + g[step:])
        size += step
    least, size, wide = g, 1, window - gram + 1
    while size < wide:
        step = min(size, wide - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return least


def passages(texts: list[bytes], window: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(text, first word, words, anchor, digest in two halves) of the passages of texts
    of words that single spaces part."""
    texts = [(i, t) for i, t in enumerate(texts) if t.count(b" ") >= window - 1]
    if not texts:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    data = np.frombuffer(joined := b"\n".join(t for _, t in texts), np.uint8)
    stops = np.concatenate([np.flatnonzero((data == 32) | (data == 10)), [len(data)]])
    starts = np.concatenate([[0], stops[:-1] + 1])
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for _, t in texts]))    # word after each text's last
    least = anchors(word_hashes(data, starts, stops, powers), window)
    of = np.searchsorted(ends, np.arange(len(least)), side="right")
    inside = np.arange(len(least)) + window <= ends[of]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (of[1:] != of[:-1])])
    run = np.flatnonzero(new)
    new |= (np.arange(len(least)) - run[np.cumsum(new) - 1]) % RUN == 0
    first = np.flatnonzero(new)
    first = first[inside[first]]
    n = np.add.reduceat(inside, np.flatnonzero(new), dtype=np.int64)
    n = n[n > 0] + window - 1
    view, a, b = memoryview(joined), starts[first], stops[first + n - 1]
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[i:j]) for i, j in zip(a.tolist(), b.tolist())]),
                            ">i8").reshape(-1, 2)
    begin = np.concatenate([[0], ends[:-1]])
    return (np.array([i for i, _ in texts])[of[first]], first - begin[of[first]], n, least[first].view(np.int64),
            digests[:, 0], digests[:, 1])


def spaced(text: str | None) -> bytes:
    """The words of a text, parted by single spaces."""
    return b" ".join(text.encode().split()) if text else b""


def found_passages(docs: DataFrame, window: int) -> DataFrame:
    """(d, th, s, n, a, p, q): the passages of every document, p and q their digest."""
    schema = StructType([StructField("d", LongType()), StructField("th", LongType()), StructField("s", IntegerType()),
                         StructField("n", IntegerType())] + [StructField(c, LongType()) for c in "apq"])

    def make():
        powers = Powers()

        def step(batch):
            of, s, n, a, p, q = passages([spaced(t) for t in batch.column(2).to_pylist()], window, powers)
            of = pa.array(of, pa.int64())
            return [batch.column(0).take(of), batch.column(1).take(of),
                    *[pa.array(x.astype(t)) for x, t in ((s, "i4"), (n, "i4"), (a, "i8"), (p, "i8"), (q, "i8"))]]
        return step

    return map_slices(docs, make, schema, SLICE)


def cut_out(docs: DataFrame, wanted: DataFrame, window: int, singly: bool) -> DataFrame:
    """The words of the wanted passages (d, th, s, n, a, p, q), each from its document:
    (a, p, q, d, text), or for every single window of them (p, q, d, at, w, x), w and x
    its digest."""
    own = wanted.groupBy(F.col("d").alias("_d"), F.col("th").alias("_th")).agg(
        F.collect_list(F.struct("s", "n", "a", "p", "q")).alias("own"))
    rows = docs.join(own, (F.col("d") == F.col("_d")) & (F.col("th") == F.col("_th"))).select("d", "text", "own")
    names = ("p", "q", "d", "at", "w", "x") if singly else ("a", "p", "q", "d", "text")
    schema = StructType([StructField(c, IntegerType() if c == "at" else StringType() if c == "text" else LongType())
                         for c in names])

    def make():
        def step(batch):
            out: list[list] = [[] for _ in names]
            for d, text, own in zip(*[c.to_pylist() for c in batch.columns]):
                words = text.encode().split()
                for x in own:
                    part = words[x["s"]:x["s"] + x["n"]]
                    found = [(x["p"], x["q"], d, i, *np.frombuffer(xxhash.xxh3_128_digest(b" ".join(part[i:i + window])),
                                                                  ">i8").tolist()) for i in range(len(part) - window + 1)
                             ] if singly else [(x["a"], x["p"], x["q"], d, b" ".join(part).decode())]
                    for row in found:
                        for k, v in enumerate(row):
                            out[k].append(v)
            return out
        return step

    return map_slices(rows, make, schema, SLICE)


def shard_repeats(table: pa.Table, window: int) -> pa.Table:
    """(p, q, spans) of the passages (p, q, d, text) of a shard that have words in
    earlier documents of it."""
    lists = pc.split_pattern(table["text"].combine_chunks(), " ")
    words = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False) + 1
    found = FMIndex(words, np.diff(lists.offsets.to_numpy()).astype(np.int64), table["d"].to_numpy(), window).repeats()
    hit = pa.array([i for i, spans in enumerate(found) if spans], pa.int64())
    return pa.table([table["p"].take(hit), table["q"].take(hit), pa.array(
        [[{"from": a, "to": b} for a, b in found[i]] for i in hit.to_pylist()], pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))],
        ["p", "q", "spans"])


def removed_spans(docs: DataFrame, window: int) -> DataFrame:
    """(d, th, spans): the intervals of words to remove, for each document that has any;
    ``docs`` has d, th and text."""
    every = stored(found_passages(docs.filter(F.col("d").isNotNull() & F.col("text").isNotNull()), window), "passages")
    met = (every.groupBy(F.col("a").alias("_a")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
           .filter("lo < hi").select("_a"))
    shared = stored(every.join(met, F.col("a") == F.col("_a"), "left_semi"), "passages-shared")
    first = stored(shared.groupBy("a", "p", "q").agg(F.min(F.struct("d", "th", "s", "n")).alias("x"))
                   .select("a", "p", "q", "x.*"), "passages-first")
    sizes = stored(first.groupBy(F.col("a").alias("_a")).agg(F.count("*").alias("m")).filter("m > 1"), "passages-anchors")
    others = first.join(sizes, F.col("a") == F.col("_a"))

    fitting = others.filter(F.col("m") <= LIMIT)
    total = fitting.agg(F.sum("n")).first()[0] or 0
    few = cut_out(docs, fitting, window, singly=False)
    shards = F.pmod(F.xxhash64("a"), F.lit(max(1, -(-total // SHARD_WORDS))))
    spans = (few.groupBy(shards.alias("shard")).applyInArrow(
        lambda t: shard_repeats(t, window), StructType([StructField("p", LongType()), StructField("q", LongType()),
                                                        StructField("spans", _SPANS)])))
    many = others.filter(F.col("m") > LIMIT)
    if many.limit(1).count():
        windows = stored(cut_out(docs, many, window, singly=True), "passages-windows")
        early = windows.groupBy("w", "x").agg(F.min("d").alias("low"), F.max("d").alias("high")).filter("low < high")
        spans = spans.unionByName(
            windows.join(early, ["w", "x"]).filter("low < d").groupBy("p", "q").agg(F.collect_list(F.struct(
                F.col("at").alias("from"), (F.col("at") + window).alias("to"))).cast(_SPANS).alias("spans")))

    known = first.select("p", "q", F.col("d").alias("low")).join(stored(spans, "passages-spans"), ["p", "q"], "left")
    whole = F.array(F.struct(F.lit(0).alias("from"), F.col("n").alias("to"))).cast(_SPANS)
    return (shared.join(known, ["p", "q"])
            .select("d", "th", "s", F.when(F.col("d") > F.col("low"), whole).otherwise(F.col("spans")).alias("spans"))
            .filter(F.col("spans").isNotNull())
            .select("d", "th", "s", F.explode("spans").alias("x"))
            .groupBy("d", "th").agg(F.collect_set(F.struct((F.col("s") + F.col("x.from")).alias("from"),
                                                           (F.col("s") + F.col("x.to")).alias("to"))).alias("spans")))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, removed (intervals of words, from
    0, that do not touch) and text, the words that stay, parted by single spaces."""
    keyed = docs.select("doc_id", F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("th"), "text")
    gone = stored(removed_spans(keyed.drop("doc_id"), window), "passages-removed").select(
        F.col("d").alias("_d"), F.col("th").alias("_th"), "spans")
    rows = (keyed.join(gone, (F.col("d") == F.col("_d")) & (F.col("th") == F.col("_th")), "left")
            .select("doc_id", "text", "spans"))
    schema = StructType([docs.schema["doc_id"], StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("removed", _SPANS), StructField("text", StringType())])

    def make():
        def step(batch):
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words, joined = (text or "").encode().split(), []
                total = len(words)
                for x in sorted(spans or [], key=lambda x: x["from"]):
                    if joined and x["from"] <= joined[-1]["to"]:
                        joined[-1]["to"] = max(joined[-1]["to"], x["to"])
                    else:
                        joined.append(dict(x))
                for x in reversed(joined):
                    del words[x["from"]:x["to"]]
                for k, v in enumerate((total, total - len(words), joined, b" ".join(words).decode())):
                    out[k].append(v)
            return [batch.column(0), *out]
        return step

    return map_slices(rows, make, schema, SLICE)
