"""Cleaning rules (golden rows, never-raise property), expectations, checks."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.functions import clean
from lakeops.operators import players as P
from lakeops.operators import quality
from lakeops.operators.ranking import best_trial, top_k_with_others
from lakeops.operators.security import hash_mask, secure_view


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text,want", [("€110.5M", 110500000.0), ("€565K", 565000.0), ("€0", None),
                                       ("€2k", 2000.0), (None, None), ("€abcM", None), ("", None)])
def test_parse_money(spark, text, want):
    assert _one(spark, clean.parse_money, text) == want


@pytest.mark.parametrize("text,want", [("170cm", 170 * 0.393701), ("5'7", 67.0), ("6'", None),
                                       ("tall", None), (None, None), ("x'y", None)])
def test_parse_height(spark, text, want):
    got = _one(spark, clean.parse_height, text)
    assert (got is None and want is None) or abs(got - want) < 1e-5


@pytest.mark.parametrize("text,want", [("72kg", 72 * 2.20462), ("159lbs", 159.0), ("72", None),
                                       ("", None)])
def test_parse_weight(spark, text, want):
    got = _one(spark, clean.parse_weight, text)
    assert (got is None and want is None) or abs(got - want) < 1e-5


@pytest.mark.parametrize("text,want", [("Jul 1, 2004", dt.date(2004, 7, 1)), ("July 1 2004", None),
                                       ("", None)])
def test_parse_joined(spark, text, want):
    assert _one(spark, clean.parse_month_day_year, text) == want


@pytest.mark.parametrize("text,want", [("2021", dt.date(2021, 5, 31)), ("2023-06-30", dt.date(2023, 6, 30)),
                                       ("Jun 30, 2023", None), ("abcd", None), (None, None)])
def test_parse_contract(spark, text, want):
    assert _one(spark, clean.parse_contract_end, text) == want


def test_strip_html(spark):
    assert _one(spark, clean.strip_html, '<span class="pos">ST</span>') == "ST"
    assert _one(spark, clean.strip_html, "a<b>b</b>c<i>") == "abc"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_cleaning_never_raises(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    out = df.select(clean.parse_money("x"), clean.parse_height("x"), clean.parse_weight("x"),
                    clean.parse_month_day_year("x"), clean.parse_contract_end("x"),
                    clean.strip_html("x"))
    assert out.count() == len(texts)


def test_nan_to_null_and_names(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, "a")], "`Some Value` double, b double, c string")
    out = clean.normalize_column_names(clean.nan_to_null(df))
    assert out.columns == ["some_value", "b", "c"]
    assert tuple(out.first()) == (None, 1.0, "a")


def test_expectations_keep_drop_fail(spark):
    df = spark.createDataFrame([(1, 10.0), (None, 5.0), (2, -1.0), (3, None)], "user_id int, price double")
    exps = [quality.Expectation("valid_user", "user_id IS NOT NULL"),
            quality.Expectation("valid_price", "price > 0", "drop")]
    out, obs = quality.apply_expectations(df, exps)
    kept = sorted(r.user_id or 0 for r in out.collect())
    assert kept == [0, 1]                                  # NULL price is a violation
    assert obs.get == {"total_rows": 4, "valid_user_violations": 1, "valid_price_violations": 2}
    bad, _ = quality.apply_expectations(df, [quality.Expectation("p", "price > 0", "fail")])
    with pytest.raises(Exception):
        bad.collect()


def test_pk_and_ranges(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    got = sorted((r.a, r.b, r.n_rows) for r in quality.primary_key_violations(df, ["a", "b"]).collect()
                 if r.a is not None) + \
        [(r.a, r.b, r.n_rows) for r in quality.primary_key_violations(df, ["a", "b"]).collect() if r.a is None]
    assert got == [(1, 1, 2), (None, 3, 1)]
    rng = quality.verify_ranges(df, {"a": (0, 1), "b": (0, 2)}).first()
    assert rng.a_in_range is True and rng.b_in_range is False


def test_classify_and_profile(spark):
    df = spark.createDataFrame([("mail me at a.b@example.com", "x"), ("call +1 555 123 4567", None),
                                ("see https://example.org/x", "x")], "t string, u string")
    cls = {(r.column_name, r.tag): r.n_match for r in quality.classify_columns(df).collect()}
    assert cls[("t", "email")] == 1 and cls[("t", "phone")] == 1 and cls[("t", "url")] == 1
    prof = {r.column_name: r for r in quality.column_profile(df, exact=True).collect()}
    approx = {r.column_name: r for r in quality.column_profile(df).collect()}
    assert approx["u"].n_distinct == 1 and approx["t"].n_distinct == 3
    assert prof["u"].n_nulls == 1 and prof["u"].n_distinct == 1 and prof["u"].top_value == "x"
    assert prof["u"].top_count == 2


def test_top_values_are_exact_at_any_cardinality(spark):
    """Heavy, flat, tied, unique, empty columns; few counters, so that some columns are not settled."""
    n = 4000
    df = spark.range(n).selectExpr(
        "if(id % 8 = 0, 'often', concat('v', id)) AS heavy", "concat('u', id) AS single",
        "concat('t', id % 2000) AS tied", "concat('f', id % 3) AS few", "CAST(NULL AS STRING) AS none",
        "if(id % 3 = 0, NULL, concat('n', id % 500)) AS gaps", "id AS number")
    want = {r.column_name: (r.top_value, r.top_count, r.n_nulls) for r in quality.column_profile(df, exact=True).collect()}
    assert want["heavy"][:2] == ("often", 500) and want["single"][:2] == ("u0", 1) and want["none"] == (None, None, n)
    for tracked, candidates in ((10_000, 32), (64, 2), (16, 4)):
        got = quality.column_profile(df, tracked=tracked, candidates=candidates).collect()
        assert {r.column_name: (r.top_value, r.top_count, r.n_nulls) for r in got} == want, tracked
    empty = quality.column_profile(df.limit(0)).collect()
    assert len(empty) == 7 and {r.top_value for r in empty} == {None}


def test_player_groups(spark):
    df = spark.createDataFrame(
        [(1, 2020, 24, 4.0, "High/High", "Left")], "id long, year long, age long, "
        "international_reputation double, work_rate string, preferred_foot string")
    for c in P.DEMOGRAPHIC:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    r = P.demographic_features(df).first()
    assert (r.Age_Group, r.High_Reputation, r.Work_Rate_Score) == ("Young", 1, 5)
    sk = spark.createDataFrame([(1, 2020)], "id long, year long")
    for i, c in enumerate(P.OFFENSIVE + P.DEFENSIVE + P.GOALKEEPER):
        sk = sk.withColumn(c, F.lit(None if i == 0 else 90.0).cast("double"))
    s = P.skill_features(sk).first()
    assert s.Offensive_Score == pytest.approx(90 * 7 / 8)   # NULL filled with 0
    assert s.Special_Skill == 1


def test_top_k_with_others_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0), ("d", 1.0), ("a", 1.0)],
                               "k string, v double")
    got = {r.k: r.v for r in top_k_with_others(df, "k", "v", k=2).collect()}
    assert got == {"a": 6.0, "b": 5.0, "others": 2.0}


def test_best_trial(spark):
    t = spark.createDataFrame([("r1", "FINISHED", 0.5), ("r2", "FAILED", 0.9), ("r3", "FINISHED", 0.5)],
                              "run_id string, status string, metric double")
    assert best_trial(t, "metric").first().run_id == "r1"
    assert best_trial(t, "metric", higher_is_better=False).first().run_id == "r1"


def test_secure_view(spark):
    df = spark.createDataFrame([(1, "ann", "a"), (2, "bob", "b"), (3, None, None)],
                               "id int, name string, grp string")
    out = secure_view(df, "grp = 'a'", {"name": hash_mask("name")}).collect()
    assert len(out) == 1 and out[0].name != "ann" and len(out[0].name) == 64
