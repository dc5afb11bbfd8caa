"""FM-index and substring removal against brute force."""

import random

import numpy as np
import pytest

from lakeops.llm import substring_dedup
from lakeops.llm.fm_index import FMIndex, Wavelet

SCHEMA = "doc_id long, text string, d string, th string, spans string"


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    for top, n in ((1, 1), (3, 64), (9, 200), (300, 1000)):
        seq = r.integers(0, top + 1, n)
        pos, sym = r.integers(0, n + 1, 500), r.integers(0, top + 1, 500)
        assert Wavelet(seq, top).rank(sym, pos).tolist() == [int((seq[:p] == s).sum()) for p, s in zip(pos, sym)]


@pytest.mark.parametrize("seed", range(8))
def test_matching_statistics_against_earlier_documents(seed):
    r = random.Random(seed)
    depth = r.choice([3, 5, 12])
    base = [r.randrange(1, 4) for _ in range(60)]
    own = []
    for _ in range(r.randrange(1, 14)):
        at = r.randrange(50)
        own.append([x if r.random() > 0.1 else r.randrange(1, 6) for x in base[at:at + r.randrange(1, 40)]])
    docs = [r.randrange(6) for _ in own]
    index = FMIndex(np.array([w for p in own for w in p]), np.array([len(p) for p in own]), np.array(docs), depth)
    got, at = index.matches(), 0
    for p, d in zip(own, docs):
        for i in range(len(p)):
            want = max((n for n in range(min(depth, len(p) - i) + 1)
                        if n == 0 or any(e < d and any(o[j:j + n] == p[i:i + n] for j in range(len(o) - n + 1))
                                         for o, e in zip(own, docs))), default=0)
            assert got[at + i] == want
        at += len(p) + 1
    spans = index.repeats()
    for p, s, first in zip(own, spans, index.ends - index.lengths):
        full = {i + k for i in range(len(p)) if got[first + i] >= depth for k in range(depth)}
        assert {k for a, b in s for k in range(a, b)} == full


def brute(rows, window):
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    low = {}
    for d, w in docs:
        for i in range(len(w) - window + 1 if d is not None else 0):
            k = tuple(w[i:i + window])
            low[k] = min(low.get(k, d), d)
    out = []
    for d, w in docs:
        gone = {i + j for i in range(len(w) - window + 1 if d is not None else 0) if low[tuple(w[i:i + window])] < d
                for j in range(window)}
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    base = [[f"w{r.randrange(400)}é" for _ in range(r.randrange(10, 300))] for _ in range(6)]
    common = [f"c{i}" for i in range(70)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(r.randrange(1, 4)):
            b = r.choice(base)
            a = r.randrange(len(b))
            words += [x if r.random() > 0.01 else f"n{r.randrange(999)}" for x in b[a:a + r.randrange(200)]]
        if i % 3 == 0:
            words[5:5] = common
        rows.append((r.choice([i, i, i, 7, None]), r.choice([" ", "\n", " \t "]).join(words)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "aa " * 500), (104, "aa " * 300 + "b " + "aa " * 60), rows[0], rows[0],
             (105, " ".join(common[:50])), (106, " ".join(common[:49])), (5000, " ".join(" ".join(b) for b in base) + " x\x85y")]
    return rows


@pytest.mark.parametrize("seed,window,limit,shard", [(1, 50, 8192, 300_000), (2, 50, 3, 500), (3, 12, 6, 2000), (4, 5, 8192, 500)])
def test_removed_words_are_those_of_brute_force(spark, monkeypatch, seed, window, limit, shard):
    monkeypatch.setattr(substring_dedup, "LIMIT", limit)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    monkeypatch.setattr(substring_dedup, "CHUNK", 300)
    rows = corpus(seed)
    got = substring_dedup.remove_repeats(spark.createDataFrame([(*x, "a", "b", "c") for x in rows], SCHEMA), window).collect()
    assert sorted([(x["doc_id"], x["n_words"], x["n_removed"], x["text"]) for x in got], key=str) == brute(rows, window)
    for x in got:
        assert sum(s["to"] - s["from"] for s in x["removed"]) == x["n_removed"]
        assert all(a["to"] < b["from"] for a, b in zip(x["removed"], x["removed"][1:]))


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
