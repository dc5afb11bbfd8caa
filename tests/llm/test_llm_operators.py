"""The training-data operators on Spark: brute force, edge rows, the pipeline."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import (html_extract, license_scan, line_dedup, mixing, near_dedup, packing, quality_classifier,
                         quality_rules, token_output, topk)
from lakeops.llm.registry import SEQ_LEN, TOKENIZER
from tests.conftest import SF001

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string"


def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeats, extra columns."""
    long = " ".join(f"w{i % 5000}" for i in range(40_000))
    rows = [(1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"),
            (2, "one two three four five six", "en", "a"), (3, None, None, None), (4, "", "en", None),
            (None, "one two three four five six", None, "b"), (5, long, "de", "a"), (6, "\n\n \t", "en", "b"),
            (7, "one two three four five seven\nsolo", "en", "b")]
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y") for r in rows], DOCS)


def sets(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_every_operator_takes_odd_and_empty_tables(spark):
    docs, labels = odd_docs(spark), spark.createDataFrame([(2, 1, 0), (7, 0, 0), (None, 1, 0), (3, None, 0)],
                                                          "doc_id long, quality int, toxic int")
    for d, n in ((docs, 9), (docs.limit(0), 0)):
        model = quality_classifier.train(d, labels)
        for got in (quality_rules.quality_rules(d), license_scan.license_scan(d), near_dedup.near_duplicates(d),
                    quality_classifier.classify(d, model), line_dedup.line_dedup(d)):
            assert got.count() == n
        assert line_dedup.dedup_lines(d).columns == d.columns == near_dedup.drop_near_duplicates(d).columns
        assert quality_classifier.keep_good(d, model).columns == d.columns == mixing.mix(d).columns
        assert packing.pack(d, TOKENIZER, 64).select("doc_id").distinct().count() == (8 if n else 0)
        assert bool(token_output.packed_matrices(d, TOKENIZER, 64).count()) == bool(n)
        assert mixing.mix(d).count() >= 0
    pages = spark.createDataFrame([(1, None, None, 2), (None, "u", "<p>x</p>", 3)],
                                  "page_id long, url string, html string, n_chars long")
    assert [r["text"] for r in html_extract.extract(pages).orderBy("page_id").collect()] == ["x", ""]


def test_edge_values(spark):
    docs = odd_docs(spark)
    near = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert near[1] == (1, True) and near[2] == (1, False) and near[None] == (None, True) == near[3]
    lines = {(r["doc_id"], r["text"]): r["n_removed"] for r in line_dedup.line_dedup(docs).collect()}
    assert lines[(3, None)] == 0 and lines[(2, "")] == 1 and lines[(7, "one two three four five seven\nsolo")] == 0


def test_near_duplicates_are_the_components_of_brute_force_links(spark):
    r = random.Random(8)
    texts = []
    for _ in range(25):
        base = [f"{r.randrange(10 ** 6)}" for _ in range(r.randrange(30, 150))]
        for k in range(r.randrange(1, 6)):
            texts.append(" ".join(x if r.random() > 0.012 * k else f"n{r.randrange(10 ** 6)}" for x in base))
    r.shuffle(texts)
    rows = list(enumerate(texts))
    parent = list(range(len(rows)))
    s = [sets(t) for t in texts]

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(s[i] & s[j]) / len(s[i] | s[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == {i: root(i) for i in range(len(rows))}


def test_near_duplicates_split_crowded_buckets(spark, monkeypatch):
    """With tiny limits every bucket is split, and nothing is lost."""
    r = random.Random(3)
    base = [f"{i}" for i in range(60)]
    rows = [(i, " ".join(x if r.random() > 0.004 else f"n{r.randrange(10 ** 6)}" for x in base)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs).collect()}
    monkeypatch.setattr(near_dedup, "CROWD", 2)
    assert {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs).collect()} == want


def test_near_duplicates_in_a_crowd_share_one_bucket(spark, monkeypatch):
    """Pairs of 0.8 or little more whose only shared bucket is a crowded one."""
    base = [f"{i}" for i in range(96)]
    rows = [(i, " ".join(base + [f"t{i // 2} {i // 2}"] + [f"o{i}x{k}" for k in range(10)])) for i in range(40)]
    rows += [(100 + i, " ".join([f"q{i}x{k}" for k in range(60)])) for i in range(40)]
    marks = near_dedup.bands

    def one_bucket(sig):
        own = marks(sig)
        own[:, 0] = 7
        own[:, 1:] = own[:, 1:] ^ sig[:, :1].view(np.int64) ^ np.array([zlib.crc32(x.tobytes()) for x in sig])[:, None]
        return own

    monkeypatch.setattr(near_dedup, "bands", one_bucket)
    monkeypatch.setattr(near_dedup, "CROWD", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", 16, raising=False)
    s = {i: sets(t) for i, t in rows}
    want = {i: i for i, _ in rows}
    for i in sorted(want):
        for j in sorted(want):
            if j < i and len(s[i] & s[j]) / len(s[i] | s[j]) >= 0.8:
                low, high = sorted((want[i], want[j]))
                want = {k: low if v == high else v for k, v in want.items()}
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == want


def test_line_dedup_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", 2)
    monkeypatch.setattr(line_dedup, "LOOK_AT", 1)
    r = random.Random(6)
    base = [[f"{r.choice('abcdefgh')}{r.randrange(40)}" for _ in range(r.randrange(3, 25))] for _ in range(30)]
    rows = []
    for d in range(40):
        lines = [" ".join(w if r.random() > 0.08 else f"z{r.randrange(99)}" for w in r.choice(base))
                 for _ in range(r.randrange(1, 5))]
        rows.append((d, "\n".join(lines)))
    flat = [((d, i), set(x.split())) for d, t in rows for i, x in enumerate(t.split("\n"))]
    gone = {p for n, (p, s) in enumerate(flat) if len(s) >= 5 and any(
        len(t) >= 5 and len(s & t) * 5 >= len(s | t) * 4 for _, t in flat[:n])}
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x["doc_id"], i) for x in got for i in x["removed"]} == gone
    for x in got:
        assert x["text"] == "\n".join(t for i, t in enumerate(rows[x["doc_id"]][1].split("\n"))
                                      if (x["doc_id"], i) not in gone)


def test_line_dedup_verifies_near_lines_only(spark, monkeypatch):
    # lines of a group share 4 rare words, first in the order, and no others
    rows = [(g * 6 + i, " ".join([f"rare{g}x{j}" for j in range(4)] + [f"w{(g * 6 + i) * 8 + j}" for j in range(8)] * 2))
            for g in range(20) for i in range(6)]
    rows += [(1000 + d, " ".join(f"w{(7 * d + j) % 960}" for j in range(50))) for d in range(200)]
    rows += [(2000, rows[0][1] + " more"), (2001, None)]
    stored = {}
    monkeypatch.setattr(line_dedup, "step", lambda df, name, *used, real=line_dedup.step: stored.setdefault(
        name, df.cache()) if name == "line-pairs" else real(df, name, *used))
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = [(d, set(t.split())) for d, t in rows if t]
    want = {d for n, (d, s) in enumerate(sets) if any(len(s & t) * 5 >= len(s | t) * 4 for _, t in sets[:n])}
    assert {x["doc_id"] for x in got if x["n_removed"]} == want and 2000 in want
    met = {(x["ad"], x["bd"]) for x in stored["line-pairs"].collect()}
    assert (0, 2000) in met and not any(b < 1000 for _, b in met)


def test_line_dedup_ships_few_word_sets(spark, monkeypatch):
    # a crowded word in unrelated lines, long unrelated lines on one rare word, a group of near copies
    rows = [(i, " ".join(["crowd"] + [f"c{i}x{j}" for j in range(9)])) for i in range(20)]
    rows += [(100 + i, " ".join(["rare"] + [f"l{i}x{j}" for j in range(149)])) for i in range(2)]
    rows += [(200 + i, " ".join([f"g{j}" for j in range(18)] + [f"own{i}"])) for i in range(8)]
    # rows of one doc_id: only one of them has an earlier near line
    rows += [(200, "a b c d e f"), (200, " ".join(f"g{j}" for j in range(20)))]
    monkeypatch.setattr(line_dedup, "LOOK_AT", 1)
    stored = {}

    def keep(df, name, *used, real=line_dedup.step):
        out = real(df, name, *used)
        if name in ("line-star", "line-pairs", "line-best"):
            stored[name] = [(r["ad"], r["bd"]) for r in out.collect()]
        return out

    monkeypatch.setattr(line_dedup, "step", keep)
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not any(b < 200 for name in stored for _, b in stored[name])
    assert len(set(stored["line-best"])) == len(stored["line-best"])
    assert {r["doc_id"] for r in got if r["n_removed"]} == {201 + i for i in range(7)}


def test_top_k_with_ties_bad_vectors_and_huge_values(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=4).tolist()) for i in range(60)] + [(i, [0.5, 0.25, 0.0, 1.0]) for i in range(60, 90)]
    rows += [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [float("nan")] * 4), (93, [float("inf")] * 4), (94, []),
             (95, [1.0, 2.0]), (None, [1.0] * 4), (96, [3e12] * 4), (97, [-3e12] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and i not in (90, 91, 92, 93)}
    want = set()
    for q in (i for i in good if i % 20 == 0 or i == 96):
        def score(c):
            return max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(a * b for a, b in zip(good[q], good[c]))))

        best = sorted((-score(c), c) for c in good if c != q)[:10]
        want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(best)}
    got = topk.top_k(df, df.filter("vec_id % 20 = 0 or vec_id = 96"), k=10).collect()
    assert {tuple(x) for x in got} == want
    assert topk.top_k(df.limit(0), df, k=3).count() == 0 == topk.top_k(df, df.limit(0), k=3).count()


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    ids = {r["doc_id"]: t.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    rows = packing.pack(docs, TOKENIZER, SEQ_LEN).collect()
    seen, bins = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == r["piece"] * SEQ_LEN and zlib.crc32(np.array(part, "<u4")) == r["ids_crc32"]
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen == {k: len(v) for k, v in ids.items()}
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == np.cumsum([0] + [n for _, n in sorted(b)])[:-1].tolist()
        assert sum(n for _, n in b) <= SEQ_LEN
    assert len(bins) <= -(-sum(map(len, ids.values())) // SEQ_LEN) * 1.02 + 1

    out = {}
    for r in token_output.packed_matrices(docs, TOKENIZER, SEQ_LEN, buffer_tokens=50_000).collect():
        row, pos, cu = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2"), r["cu_seqlens"]
        assert len(row) == SEQ_LEN == len(pos) and cu[-1] == r["n_tokens"]
        for d, k, s, a, b in zip(r["doc_ids"], r["pieces"], r["starts"], cu, cu[1:]):
            assert pos[a:b].tolist() == list(range(b - a)) and s == k * SEQ_LEN
            out.setdefault(d, {})[k] = row[a:b].tolist()
    assert {d: sum((p[k] for k in sorted(p)), []) for d, p in out.items()} == ids


def test_classifier_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.classify(docs, quality_classifier.train(docs, labels)).filter("held_out")
    right = got.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95


def test_mixing_meets_entropy_repeats_and_budget(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "big" if i % 10 else f"s{i % 3}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words = {i: 1 + i % 7 for i, *_ in rows}
    for entropy, repeat in ((0.9, 99.0), (1.0, 2.0)):
        got = mixing.mix(docs, target_entropy=entropy, max_repeat=repeat, digest=True).collect()
        weight = {r["source"]: r["weight"] for r in got}
        h = -sum(w * math.log(w) for w in weight.values()) / math.log(len(weight))
        total = sum(words.values())
        own = {s: sum(words[i] for i, _, x in rows if x == s) for s in weight}
        most = max(weight[s] * total / own[s] for s in own)
        assert h >= entropy - 1e-6 and most <= repeat + 1e-6 or most == pytest.approx(repeat, abs=1e-6)
        for s in weight:
            taken = sum(words[r["doc_id"]] for r in got if r["source"] == s)
            assert 0 <= round(weight[s] * total) - taken < 8
        per = {}
        for r in got:
            per.setdefault((r["source"], r["epoch"]), []).append(r["doc_id"])
        assert all(len(x) == len(set(x)) for x in per.values())


def test_mixing_acts_on_the_given_tables(spark):
    """By default the weights lie half way to equal ones in entropy: some source repeats,
    some loses documents, and the exponent is the one that gives this entropy."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words, own = {}, {}
    for r in docs.select("doc_id", "source", "text").collect():
        words[r["doc_id"]] = max(len((r["text"] or "").split()), 1)
        own[r["source"]] = own.get(r["source"], 0) + words[r["doc_id"]]
    got = mixing.mix(docs, digest=True).collect()
    weight, total = {r["source"]: r["weight"] for r in got}, sum(own.values())

    def entropy(alpha):
        w = [(x / total) ** alpha for x in own.values()]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) / math.log(len(w))

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) >= (entropy(1.0) + 1) / 2 else (low, mid)
    z = sum((x / total) ** low for x in own.values())
    assert low < 0.99 and set(weight) == set(own)
    for s, x in own.items():
        assert weight[s] == pytest.approx((x / total) ** low / z, rel=1e-5)
        taken = sum(words[r["doc_id"]] for r in got if r["source"] == s)
        assert 0 <= round(weight[s] * total) - taken <= max(words.values())
    assert max(r["epoch"] for r in got) >= 1 and len({r["doc_id"] for r in got}) < len(words)


def test_stages_take_columns_named_like_their_own(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", "a", 1, 2, 3, 4), (2, "one two three four five six", "a", 1, 2, 3, 4)],
                                 "doc_id long, text string, source string, _gone int, _line_d int, __line_gone int, _mix_times int")
    assert line_dedup.dedup_lines(docs).columns == near_dedup.drop_near_duplicates(docs).columns == docs.columns
    assert near_dedup.drop_near_duplicates(docs).count() == 1
    assert sorted(r["text"] for r in line_dedup.dedup_lines(docs).collect()) == ["", "one two three four five six"]
    assert line_dedup.line_dedup(docs).count() == 2 and mixing.mix(docs).columns == docs.columns


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF001)
        assert kept.columns == docs.columns, name
    assert corpus_pipeline.ORACLE_SQL is None
    packed = corpus_pipeline.run(spark, SF001)
    assert packed.count() > 0 and "sequence_id" in packed.columns


def test_fences_of_every_group_lean_on_its_own_sketch(spark):
    """Groups of 3 and of 300 documents; each fence between its own and that of its parents."""
    rows = [("en", "small", "mean_word", 100, 3), ("en", "big", "mean_word", 200, 300), ("de", "big", "mean_word", 160, 50)]
    sketch = spark.createDataFrame(rows, "lang string, source string, metric string, bucket int, n long")
    got = {(r["lang"], r["source"]): r["long_words"] for r in quality_rules.fences(sketch, 200).collect()}
    alone = {(r["lang"], r["source"]): r["long_words"] for r in quality_rules.fences(sketch, 0).collect()}
    assert len(set(alone.values())) == 3
    value = {b: int(spark.range(1).select(quality_rules.bucket_value(F.lit(b))).first()[0]) for b in (100, 160, 200)}
    assert alone == {(lang, src): value[b] + 6 * 500 for lang, src, _, b, _ in rows}
    own, top = {k: v for k, v in alone.items()}, value[200] + 6 * max(value[200] - value[200], 500)
    en = (303 * (value[200] + 3000) + 200 * top) // 503
    de = (50 * own["de", "big"] + 200 * top) // 250
    assert got == {("en", "small"): (3 * own["en", "small"] + 200 * en) // 203,
                   ("en", "big"): (300 * own["en", "big"] + 200 * en) // 500,
                   ("de", "big"): (50 * own["de", "big"] + 200 * de) // 250}
