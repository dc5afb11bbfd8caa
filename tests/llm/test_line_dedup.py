"""Steps of the line join that its speed rests on."""

from pyspark.sql import functions as F

from lakeops.llm import line_dedup


def postings(spark, *lines):
    """Of word numbers per line, rare to common; every word posted."""
    rows = [(w, d, 0, len(words), i) for d, words in enumerate(lines) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "w long, d long, l int, n int, i int")
    sets = spark.createDataFrame([(d, list(words)) for d, words in enumerate(lines)], "d long, k array<long>")
    bits = sets.select("d", line_dedup.parities(F.col("k")).alias("p"), F.lit(0).cast("long").alias("q"))
    return df.join(bits, "d")


def test_a_pair_meets_only_on_words_that_can_be_its_first(spark):
    """Of 20 words the threshold of 80 asks for 18 in common: a pair's first common word
    has 18 of either line from there on, so a later place is no meeting."""
    one, two = list(range(100, 120)), [*range(100, 119), 200]
    posts = postings(spark, one, two)
    met = line_dedup.meetings(posts, posts, 80).collect()
    assert [(r.ad, r.bd) for r in met] == [(0, 1)] * 3


def test_pairs_whose_first_words_differ_still_meet(spark):
    one, two = [1, 2, *range(100, 118)], [3, 4, *range(100, 118)]      # 18 of 22 in common
    posts = postings(spark, one, two)
    assert {(r.ad, r.bd) for r in line_dedup.meetings(posts, posts, 80).collect()} == {(0, 1)}


def test_keys_hold_no_nulls(spark):
    """Else sorting them takes the slow way, over objects."""
    docs = spark.createDataFrame([(1, "a b a\tc")], "doc_id long, text string")
    keys = docs.select(line_dedup.keys(F.col("text"), line_dedup.rarity(docs)).alias("k"))
    assert not keys.schema["k"].dataType.containsNull
    assert len(keys.first().k) == 3


def test_words_are_made_distinct_outside_lambda_functions(spark):
    """As the argument of one they are interpreted over objects."""
    lines = spark.createDataFrame([(1, 2, 3, "a b a  c"), (1, 2, 4, "")], "d long, th long, l int, line string")
    docs = lines.select(F.col("line").alias("text"))
    rows = line_dedup.keyed(lines, line_dedup.rarity(docs))
    want = lines.select("l", line_dedup.keys(F.col("line"), line_dedup.rarity(docs)).alias("k")).collect()
    assert {(r.l, r.n, tuple(r.k)) for r in rows.collect()} == {(r.l, len(r.k), tuple(r.k)) for r in want}
    nodes = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("array_distinct" in node and "sort_array" in node for node in nodes)
    assert any("array_distinct" in node for node in nodes)


def test_any_white_space_parts_words(spark):
    spaces = [" ", "\t", "\x0b", "\x0c", "\r", " \t ", "\r\x0b"]
    words = "one two three four five six"
    docs = spark.createDataFrame([(0, words), (-1, None), (-2, "")] + [
        (i + 1, f"x\n{words.replace(' ', space)}{space}\ny") for i, space in enumerate(spaces)], "doc_id long, text string")
    rows = {r.doc_id: (r.n_lines, r.removed, r.text) for r in line_dedup.line_dedup(docs).collect()}
    assert rows == {0: (1, [], words), -1: (0, [], None), -2: (1, [], "")} | {i + 1: (3, [1], "x\ny") for i in range(len(spaces))}
