"""Player tables: cleaning rules, silver layer, feature groups, simple SQL ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import clean
from lakeops.operators import players as P
from lakeops.registry._base import query, round_floats
from lakeops.sources.testdata import player_bronze, player_bronze_cte, table


def _money(c: str) -> str:
    body = f"TRY_CAST(substring({c}, 2, length({c}) - 2) AS FLOAT)"
    return (f"CAST(CASE WHEN {c} ILIKE '%k%' THEN {body} * 1000 "
            f"WHEN {c} ILIKE '%m%' THEN {body} * 1000000 ELSE NULL END AS FLOAT)")


_HEIGHT = ("CASE WHEN height ILIKE '%cm' THEN CAST(TRY_CAST(substring(height, 1, length(height) - 2) "
           "AS FLOAT) AS DOUBLE) * 0.393701 "
           "WHEN height LIKE '%''%' THEN CAST(TRY_CAST(str_split(height, '''')[1] AS FLOAT) AS DOUBLE) * 12 "
           "+ CAST(TRY_CAST(str_split(height, '''')[2] AS FLOAT) AS DOUBLE) END")
_WEIGHT = ("CASE WHEN weight ILIKE '%kg' THEN CAST(TRY_CAST(substring(weight, 1, length(weight) - 2) "
           "AS FLOAT) AS DOUBLE) * 2.20462 "
           "WHEN weight ILIKE '%lbs' THEN CAST(TRY_CAST(substring(weight, 1, length(weight) - 3) "
           "AS FLOAT) AS DOUBLE) END")
_JOINED = "CAST(try_strptime(joined, '%b %-d, %Y') AS DATE)"
_CONTRACT = ("CASE WHEN length(contract_valid_until) = 4 THEN TRY_CAST(contract_valid_until || '-05-31' AS DATE) "
             "ELSE CAST(TRY_CAST(contract_valid_until AS TIMESTAMP) AS DATE) END")


def _silver_cte() -> str:
    sel = [
        "TRY_CAST(id AS BIGINT) AS id", "name", "TRY_CAST(age AS BIGINT) AS age", "nationality",
        "club", f"{_money('value')} AS value", f"{_money('wage')} AS wage", "preferred_foot",
        "TRY_CAST(international_reputation AS DOUBLE) AS international_reputation", "work_rate",
        "regexp_replace(position, '<.*?>', '', 'g') AS position", "best_position",
        "regexp_replace(loaned_from, '<.*?>', '', 'g') AS loaned_from",
        f"{_JOINED} AS joined", f"{_CONTRACT} AS contract_valid_until",
        f"{_HEIGHT} AS height", f"{_WEIGHT} AS weight",
        f"{_money('release_clause')} AS release_clause", "TRY_CAST(year AS BIGINT) AS year",
    ] + [f"TRY_CAST({s} AS DOUBLE) AS {s}" for s in P.SKILL_COLUMNS + ["defensiveawareness"]]
    return f"{player_bronze_cte()}, silver AS (SELECT {', '.join(sel)} FROM bronze)"


SILVER = _silver_cte()


def _silver(spark, sf_dir):
    return P.clean_players(player_bronze(spark, sf_dir))


@query("parse_money", f"""
WITH {player_bronze_cte()}
SELECT TRY_CAST(id AS BIGINT) AS id, {_money('value')} AS value, {_money('wage')} AS wage,
  {_money('release_clause')} AS release_clause FROM bronze
""")
def parse_money_q(spark, sf_dir):
    b = player_bronze(spark, sf_dir)
    return b.select(F.col("id").try_cast("bigint").alias("id"),
                    *[clean.parse_money(c).alias(c) for c in ("value", "wage", "release_clause")])


@query("parse_height", f"""
WITH {player_bronze_cte()}
SELECT TRY_CAST(id AS BIGINT) AS id, height AS height_text, round({_HEIGHT}, 6) AS height FROM bronze
""")
def parse_height_q(spark, sf_dir):
    b = player_bronze(spark, sf_dir)
    return round_floats(b.select(F.col("id").try_cast("bigint").alias("id"),
                                 F.col("height").alias("height_text"),
                                 clean.parse_height("height").alias("height")))


@query("parse_weight", f"""
WITH {player_bronze_cte()}
SELECT TRY_CAST(id AS BIGINT) AS id, weight AS weight_text, round({_WEIGHT}, 6) AS weight FROM bronze
""")
def parse_weight_q(spark, sf_dir):
    b = player_bronze(spark, sf_dir)
    return round_floats(b.select(F.col("id").try_cast("bigint").alias("id"),
                                 F.col("weight").alias("weight_text"),
                                 clean.parse_weight("weight").alias("weight")))


@query("parse_dates", f"""
WITH {player_bronze_cte()}
SELECT TRY_CAST(id AS BIGINT) AS id, {_JOINED} AS joined, {_CONTRACT} AS contract_valid_until FROM bronze
""")
def parse_dates_q(spark, sf_dir):
    b = player_bronze(spark, sf_dir)
    return b.select(F.col("id").try_cast("bigint").alias("id"),
                    clean.parse_month_day_year("joined").alias("joined"),
                    clean.parse_contract_end("contract_valid_until").alias("contract_valid_until"))


@query("strip_html", f"""
WITH {player_bronze_cte()}
SELECT TRY_CAST(id AS BIGINT) AS id, regexp_replace(position, '<.*?>', '', 'g') AS position,
  regexp_replace(loaned_from, '<.*?>', '', 'g') AS loaned_from FROM bronze
""")
def strip_html_q(spark, sf_dir):
    b = player_bronze(spark, sf_dir)
    return b.select(F.col("id").try_cast("bigint").alias("id"),
                    clean.strip_html("position").alias("position"),
                    clean.strip_html("loaned_from").alias("loaned_from"))


@query("player_clean", f"""
WITH {SILVER}
SELECT * REPLACE (round(height, 6) AS height, round(weight, 6) AS weight) FROM silver
""")
def player_clean(spark, sf_dir):
    return round_floats(_silver(spark, sf_dir))


_GROUP_SQL = {
    "demographic_features": f"""
WITH {SILVER}
SELECT id,
  CASE WHEN age <= 25 THEN 'Young' WHEN age > 25 AND age <= 30 THEN 'Mid' ELSE 'Old' END AS Age_Group,
  CAST(international_reputation > 3 AS INTEGER) AS High_Reputation,
  CASE work_rate WHEN 'High/High' THEN 5 WHEN 'Medium/Medium' THEN 3 WHEN 'Low/Low' THEN 1 ELSE 0 END
    AS Work_Rate_Score,
  {', '.join(P.DEMOGRAPHIC)}
FROM silver""",
    "skill_features": f"""
WITH {SILVER}, filled AS (SELECT id, year, {', '.join(f'COALESCE({c}, 0.0) AS {c}' for c in
                                                       P.OFFENSIVE + P.DEFENSIVE + P.GOALKEEPER)} FROM silver),
m AS (SELECT *, ({' + '.join(P.OFFENSIVE + P.DEFENSIVE)}) / 14 AS mu FROM filled)
SELECT id,
  round(({' + '.join(P.OFFENSIVE)}) / 8, 6) AS Offensive_Score,
  round(({' + '.join(P.DEFENSIVE)}) / 6, 6) AS Defensive_Score,
  CAST(greatest({', '.join(P.OFFENSIVE + P.DEFENSIVE)}) > 85 AS INTEGER) AS Special_Skill,
  round(({' + '.join(P.GOALKEEPER)}) / 5, 6) AS Goalkeeper_Skill_Score,
  round(({' + '.join(f'pow({c} - mu, 2)' for c in P.OFFENSIVE + P.DEFENSIVE)}) / 14, 6) AS Skill_Variance,
  year, {', '.join(P.OFFENSIVE + P.DEFENSIVE)}
FROM m""",
    "physical_features": f"""
WITH {SILVER}, m AS (SELECT *, ({' + '.join(P.PHYSICAL)}) / 8 AS mu FROM silver)
SELECT id,
  round(weight / pow(height / 100, 2), 6) AS BMI,
  round((acceleration + sprintspeed) / 2, 6) AS Speed_Score,
  round((acceleration + sprintspeed + agility) / 3, 6) AS Mobility_Score,
  round((stamina + strength + jumping) / 3, 6) AS Endurance_Score,
  round(({' + '.join(f'pow({c} - mu, 2)' for c in P.PHYSICAL)}) / 8, 6) AS Physical_Variance,
  year, round(height, 6) AS height, round(weight, 6) AS weight,
  {', '.join(P.PHYSICAL[2:])}
FROM m""",
    "contract_features": f"""
WITH {SILVER}
SELECT id, year(contract_valid_until) - year(joined) AS Contract_Duration, year,
  {', '.join(P.CONTRACT)}
FROM silver""",
}

for _name, _fn in [("demographic_features", P.demographic_features),
                   ("skill_features", P.skill_features),
                   ("physical_features", P.physical_features),
                   ("contract_features", P.contract_features)]:
    def _make(fn):
        def run(spark, sf_dir):
            return round_floats(fn(_silver(spark, sf_dir)))
        return run
    query(_name, _GROUP_SQL[_name])(_make(_fn))


@query("multi_count_distinct", f"""
WITH {SILVER}
SELECT year,
  count(DISTINCT (id, name)) FILTER (WHERE id IS NOT NULL AND name IS NOT NULL) AS n_id_name,
  count(1) AS n_rows, count(DISTINCT id) AS n_ids
FROM silver GROUP BY ALL
""")
def multi_count_distinct(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.groupBy("year").agg(F.count_distinct("id", "name").alias("n_id_name"),
                                 F.count(F.lit(1)).alias("n_rows"),
                                 F.count_distinct("id").alias("n_ids"))


@query("ilike_filter", f"""
WITH {SILVER}
SELECT id, name, value, position FROM silver WHERE name ILIKE '%RING%' OR position ILIKE 'g%'
""")
def ilike_filter(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.filter(F.col("name").ilike("%RING%") | F.col("position").ilike("g%")) \
        .select("id", "name", "value", "position")


@query("fill_zero", f"""
WITH {SILVER}
SELECT COALESCE(id, 0) AS id, name, COALESCE(age, 0) AS age, COALESCE(value, 0) AS value,
  COALESCE(crossing, 0) AS crossing, COALESCE(marking, 0) AS marking FROM silver
""")
def fill_zero(spark, sf_dir):
    s = _silver(spark, sf_dir).select("id", "name", "age", "value", "crossing", "marking")
    return s.fillna(0)


@query("nan_to_null", """
SELECT p_partkey, CASE WHEN isnan(price) THEN NULL ELSE price END AS price, p_size
FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 11 = 0 THEN CAST('NaN' AS DOUBLE)
      ELSE p_retailprice END AS price FROM part)
""")
def nan_to_null_q(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
        .alias("price"), "p_size")
    return clean.nan_to_null(p)


@query("distinct_values", f"""
WITH {SILVER} SELECT DISTINCT work_rate FROM silver
""")
def distinct_values(spark, sf_dir):
    return _silver(spark, sf_dir).select("work_rate").distinct()


@query("union_by_name", f"""
WITH {SILVER}
SELECT id, name, value, year FROM silver WHERE year % 2 = 0
UNION ALL BY NAME
SELECT id, name, wage, club, year FROM silver WHERE year % 2 = 1
""")
def union_by_name(spark, sf_dir):
    s = _silver(spark, sf_dir)
    a = s.filter(F.col("year") % 2 == 0).select("id", "name", "value", "year")
    b = s.filter(F.col("year") % 2 == 1).select("id", "name", "wage", "club", "year")
    return a.unionByName(b, allowMissingColumns=True)
