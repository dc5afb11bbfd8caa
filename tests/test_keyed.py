"""Keyed tables: touched files only, the change feed, views over it, against plain dicts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lakeops.plans import keyed
from lakeops.plans.keyed import ChangeFedView, KeyedTable
from lakeops.session import work_dir

SCHEMA = "k long, g string, n long, x double"
AGGS = {"total": ("sum", "n"), "rows": ("count", "k"), "some": ("count", "x"), "mean": ("avg", "n"), "sx": ("sum", "x"),
        "lo": ("min", "x"), "hi": ("max", "n")}


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)


def aggregated(rows):
    out = {}
    for g in {v[0] for v in rows.values()}:
        own = [v for v in rows.values() if v[0] == g]
        ns, xs = [v[1] for v in own if v[1] is not None], [v[2] for v in own if v[2] is not None]
        numbers = [x for x in xs if not math.isnan(x)]
        out[g] = (sum(ns) if ns else None, len(own), len(xs), sum(ns) / len(ns) if ns else None,
                  sum(xs) if xs else None, min(numbers) if numbers else xs[0] if xs else None, max(ns) if ns else None)
    return out


def same(a, b):
    return all(x == y or x is not None and y is not None and (math.isnan(x) and math.isnan(y) or abs(x - y) < 1e-6 * max(1, abs(y)))
               for x, y in zip(a, b))


def test_versions_feed_and_view_follow_random_changes(spark):
    r = random.Random(4)
    value = lambda: (r.choice(["a", "b", "c", None]), r.choice([None, 1, 5, 10 ** 12]),
                     r.choice([None, 1.5, -2.0, 1e27, float("inf"), float("nan")]))
    rows = {k: value() for k in range(60)}
    t = KeyedTable(spark, work_dir(spark, "keyed-test"), ["k"], 7).create(frame(spark, rows))
    view = ChangeFedView(t, ["g"], AGGS, work_dir(spark, "keyed-test-view")).create()
    states = [dict(rows)]
    for step in range(4):
        if step == 1:
            doomed = r.sample(sorted(rows), 9)
            t.delete(spark.createDataFrame([(k,) for k in doomed], "k long"))
            rows = {k: v for k, v in rows.items() if k not in doomed}
        else:
            low = r.randrange(50)
            new = {k: value() for k in range(low, low + 12)}
            t.merge(frame(spark, new))
            rows = {**rows, **new}
        states.append(dict(rows))
        if step % 2:
            view.refresh(max_files_per_trigger=1 if step == 1 else None)
            got = {x[0]: tuple(x)[1:] for x in view.read().collect()}
            want = aggregated(rows)
            assert set(got) == set(want) and all(same(got[g], want[g]) for g in want)
    as_text = lambda own: sorted(repr((k, *v)) for k, v in own.items())
    for v, own in enumerate(states):
        assert sorted(repr(tuple(x)) for x in t.read(v).collect()) == as_text(own)
    for v in range(1, 5):
        got = {}
        for x in t.changes(v - 1, v).collect():
            got.setdefault(x["_change_type"], {})[x["k"]] = (x["g"], x["n"], x["x"])
        old, new = states[v - 1], states[v]
        moved = {k for k in old if k in new and repr(old[k]) != repr(new[k])}
        assert as_text(got.get("insert", {})) == as_text({k: new[k] for k in new if k not in old})
        assert as_text(got.get("delete", {})) == as_text({k: old[k] for k in old if k not in new})
        assert as_text(got.get("update_preimage", {})) == as_text({k: old[k] for k in moved})
        assert as_text(got.get("update_postimage", {})) == as_text({k: new[k] for k in moved})


def test_only_touched_files_are_rewritten(spark):
    t = KeyedTable(spark, work_dir(spark, "keyed-files"), ["k"], 10).create(frame(spark, {k: ("a", k, 1.0) for k in range(200)}))
    before = {x.file for x in t.manifest().collect()}
    t.merge(frame(spark, {k: ("b", 0, 0.0) for k in (57, 58, 500)}))
    after = {x.file: x.added for x in t.manifest().collect()}
    assert len(before - set(after)) <= 2 and all(after[f] == 0 for f in before & set(after))
    assert len(before) >= 20 and t.read().count() == 201 and t.read(0).count() == 200
    gone = t.delete(spark.createDataFrame([(-5,), (1000,)], "k long"))          # nothing touched
    assert {x.file for x in t.manifest(gone).collect()} == set(after)


def test_files_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(keyed, "FILES", 8)
    t = KeyedTable(spark, work_dir(spark, "keyed-grown"), ["k"], 10).create(frame(spark, {k: ("a", k, 1.0) for k in range(2000)}))
    assert t.file_rows(40) == 10 and t.file_rows(2000) == 250 and t.file_rows(10 ** 12) == keyed.ROWS_PER_FILE
    files = t.manifest().collect()
    assert len(files) <= 8 + 4 and max(f.rows for f in files) <= 250 and sum(f.rows for f in files) == 2000
    t.merge(frame(spark, {k: ("b", 0, 0.0) for k in (57, 58, 3000)}))
    after = t.manifest().collect()
    assert len({f.file for f in files} - {f.file for f in after}) == 1 and sum(f.rows for f in after) == 2001
    got = {x["k"]: x["g"] for x in t.read().collect()}
    assert len(got) == 2001 and {k for k, g in got.items() if g == "b"} == {57, 58, 3000}


def test_feed_appears_after_a_writer_died_before_the_rename(spark, monkeypatch):
    t = KeyedTable(spark, work_dir(spark, "keyed-died"), ["k"]).create(frame(spark, {1: ("a", 1, 1.0)}))
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_settle", lambda self: None)
        t.merge(frame(spark, {2: ("a", 2, 2.0)}))
    again = KeyedTable(spark, t.root, ["k"])
    assert again.versions() == [0, 1]
    assert [(x["k"], x["_change_type"]) for x in again.changes().collect()] == [(2, "insert")]


def test_refused_changes_and_empty_tables(spark):
    empty = KeyedTable(spark, work_dir(spark, "keyed-empty"), ["k"]).create(spark.createDataFrame([], SCHEMA))
    assert empty.read().count() == 0 and empty.changes().count() == 0
    view = ChangeFedView(empty, ["g"], AGGS, work_dir(spark, "keyed-empty-view")).create()
    view.refresh()
    assert view.read().count() == 0
    empty.merge(frame(spark, {1: ("a", 1, 1.0)}))
    view.refresh()
    assert view.read().select("g", "total", "lo").collect() == [("a", 1, 1.0)]
    with pytest.raises(Exception, match="null key"):
        empty.merge(spark.createDataFrame([(None, "a", 1, 1.0)], SCHEMA))
    twice = spark.createDataFrame([(1, "a", 1, 1.0), (1, "b", 2, 2.0)], SCHEMA)
    with pytest.raises(Exception, match="several updates for one key"):
        empty.merge(twice)
    assert empty.versions() == [0, 1] and empty.read().count() == 1
    deleted = empty.merge(frame(spark, {1: ("x", 0, 0.0), 3: ("y", 0, 0.0)}), delete_condition="u.g = 'x'")
    assert [x.k for x in empty.read(deleted).collect()] == [3]
    assert empty.read().filter(F.col("k") == 3).count() == 1
