"""Merkle manifest against a brute-force tree, edge rows, other arities."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeops.llm import merkle
from lakeops.llm.registry import QUERIES
from tests.conftest import SF001

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, pos string, node string"


def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute(rows, changed, arity=2):
    """doc_id -> (leaf, subroot, root, siblings, folded root)"""
    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
        return levels

    def path(levels, i):
        for n in levels[:-1]:
            j = i // arity * arity
            yield n[j:i], n[i + 1:j + arity]
            i //= arity

    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: up([leaf(r) for r in rows if r[2] == g]) for g in langs}
    top = up([trees[g][-1][0] for g in langs])
    out = {}
    for k, g in enumerate(langs):
        for i, r in enumerate([r for r in rows if r[2] == g]):
            steps = [*path(trees[g], i), *path(top, k)]
            f = leaf(changed(r))
            for a, b in steps:
                f = h(*a, f, *b)
            out[r[0]] = (leaf(r), trees[g][-1][0], top[-1][0], "".join(x for a, b in steps for x in a + b), f)
    return out


def more(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
    return (*r[:3], r[3] + 1, r[4]) if hit else r


@pytest.mark.parametrize("arity,block,n", [(2, 4, 77), (3, 9, 40), (2, 1024, 5)])
def test_manifest_is_the_brute_force_tree(spark, monkeypatch, arity, block, n):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = [(i * 3, None if i % 5 == 0 else f"s{i % 4}", [None, "en", "é", "zh"][min(i % 9, 3)], None if i % 6 == 0 else i,
             [None, "", "ü" * i, "x" * 70_000][i % 4]) for i in range(n)] + [(None, None, "en", 7, "no id")]
    docs = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    got = merkle.manifest(docs, {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, arity=arity)
    want = brute(rows, more, arity)
    got = got.collect()
    assert len(got) == len(rows) and any(not r["verified"] for r in got if n > 9) == (n > 9)
    for r in got:
        assert (r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) == want[r["doc_id"]]
        assert r["verified"] == (r["folded_root"] == r["root"])


def test_repeated_rows_empty_table_and_no_change(spark):
    rows = [(1, "s", "en", 3, "abc", "", "", "")] * 5 + [(1, "s", "en", 4, "abcd", "", "", "")]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and all(r["verified"] for r in got) and len({r["leaf"] for r in got}) == 2
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    want = brute(rows, more)
    for r in QUERIES["op11_merkle_manifest"](spark, SF001).collect():
        a, b, c, d, e = want[r["doc_id"]]
        assert tuple(r) == (r["doc_id"], a, b, c, h(d), e, e == c)
