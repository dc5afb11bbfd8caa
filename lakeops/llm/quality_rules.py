"""Quality rules with thresholds learned per language and source.

A few counts are taken from every whole text.  Four ratios of them go into
mergeable quantile sketches (log-linear histograms: counts per bucket, exact
to one part in 32, merged by adding counts), one for each (language, source).
A document is rejected where a ratio lies outside the fence
``quantile + factor * max(interquartile range, slack)`` of its group.  Every group
has a fence from its own sketch, drawn towards that of the merged sketch of its
language, and that one towards the sketch of all documents: the parent's fence
weighs as much as ``prior_docs`` documents, the own fence as much as the group has.

Cases: a null text has no words (base_failed); null languages and sources are
groups of their own; repeated rows are judged each; with no document past the
base rules there are no fences and nothing more is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from lakeops.llm._common import map_batches, stored

SYMBOLS = "#*$%&|<>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Rule:
    """Fence on one ratio: ``side`` 1 rejects above, -1 below."""
    name: str
    metric: str
    side: int
    factor: int
    slack: int


#: ratios in millionths, mean word length in thousandths of a character
METRICS = {
    "symbol_ratio": "n_symbols * 1000000 div greatest(word_chars, 1)",
    "dup_line_ratio": "n_dup_lines * 1000000 div greatest(n_lines, 1)",
    "repeat_ratio": "n_repeat_words * 1000000 div greatest(n_words, 1)",
    "mean_word": "word_chars * 1000 div greatest(n_words, 1)",
}
RULES = (
    Rule("symbols", "symbol_ratio", 1, 3, 10_000),
    Rule("dup_lines", "dup_line_ratio", 1, 4, 75_000),
    Rule("repeats", "repeat_ratio", 1, 4, 75_000),
    Rule("long_words", "mean_word", 1, 6, 500),
    Rule("short_words", "mean_word", -1, 6, 300),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        end = 0                                   # words before it are counted
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated)


def counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    schema = StructType([docs.schema[c] for c in keep] + [StructField(c, LongType()) for c in COUNTS])

    def make():
        def step(batch):
            rows = list(zip(*map(text_counts, batch.column(len(keep)).to_pylist()))) or [()] * len(COUNTS)
            return [batch.column(i) for i in range(len(keep))] + [list(x) for x in rows]
        return step

    return map_batches(docs.select(*keep, text), make, schema)


def bucket(v: Column) -> Column:
    """Bucket of a count >= 0: itself below 64, then 32 to each power of two."""
    bits = F.length(F.bin(v))
    shift = F.greatest(bits - 6, F.lit(0))
    return (shift * 32 + F.call_function("shiftright", v, shift)).cast("int")


def bucket_value(b: Column) -> Column:
    """Smallest value of a bucket."""
    shift = F.greatest(F.floor(b / 32).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", (b - shift * 32).cast("long"), shift)


def sketches(features: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): the sketch of each group."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.expr(e).cast("long")).alias("bucket"))
                      for m, e in METRICS.items()])
    return (features.select("lang", "source", F.explode(pairs).alias("p"))
            .groupBy("lang", "source", "p.metric", "p.bucket").agg(F.count("*").alias("n")))


def fences(sketch: DataFrame, prior_docs: int) -> DataFrame:
    """(lang, source, one column for each rule) from the sketches."""
    levels = (sketch.select(F.lit(2).alias("lev"), "lang", "source", "metric", "bucket", "n")
              .unionByName(sketch.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n"))
                           .select(F.lit(1).alias("lev"), "lang", F.lit(None).cast(StringType()).alias("source"),
                                   "metric", "bucket", "n"))
              .unionByName(sketch.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
                           .select(F.lit(0).alias("lev"), F.lit(None).cast(StringType()).alias("lang"),
                                   F.lit(None).cast(StringType()).alias("source"), "metric", "bucket", "n")))
    group = Window.partitionBy("lev", "lang", "source", "metric")
    ranked = (levels.withColumn("below", F.sum("n").over(group.orderBy("bucket")))
              .withColumn("total", F.sum("n").over(group)))

    def at(pct: int) -> Column:
        return F.min(F.when(F.col("below") * 100 >= F.col("total") * pct, bucket_value(F.col("bucket"))))

    quartiles = (ranked.groupBy("lev", "lang", "source", "metric")
                 .agg(F.max("total").alias("total"), at(25).alias("q1"), at(75).alias("q3")))
    wide = quartiles.groupBy("lev", "lang", "source").agg(
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("metric") == r.metric,
                       F.when(F.lit(r.side == 1), F.col("q3")).otherwise(F.col("q1"))
                       + r.side * r.factor * F.greatest(F.col("q3") - F.col("q1"), F.lit(r.slack))))
          .alias(r.name) for r in RULES])
    names = [r.name for r in RULES]
    own = wide.filter("lev = 2")
    lang = wide.filter("lev = 1").select(F.col("lang").alias("lang1"), F.col("total").alias("total1"),
                                         *[F.col(n).alias(f"{n}1") for n in names])
    top = wide.filter("lev = 0").select(F.lit(0).alias("k"), *[F.col(n).alias(f"{n}0") for n in names])
    def drawn(name: str) -> Column:
        parent = f"(total1 * {name}1 + {prior_docs} * {name}0) div (total1 + {prior_docs})"
        return F.expr(f"(total * {name} + {prior_docs} * ({parent})) div (total + {prior_docs})").alias(name)

    return (own.join(lang, F.col("lang").eqNullSafe(F.col("lang1"))).withColumn("k", F.lit(0)).join(top, "k")
            .select("lang", "source", *[drawn(n) for n in names]))


def quality_rules(docs: DataFrame, prior_docs: int = 200, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """One row a document: its counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    f = counts(docs).withColumn(
        "base_failed", (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))
    f = stored(f, "quality-counts")
    limits = stored(fences(sketches(f.filter(~F.col("base_failed"))), prior_docs), "quality-fences")
    g = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"),
                      *[F.col(r.name).alias(f"_{r.name}") for r in RULES])
    joined = f.join(g, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")

    def broken(r: Rule) -> Column:
        v = F.expr(METRICS[r.metric])
        return F.when(v > F.col(f"_{r.name}") if r.side == 1 else v < F.col(f"_{r.name}"), F.lit(r.name))

    failed = F.when(F.col("base_failed"), F.lit("")).otherwise(F.concat_ws(",", *[broken(r) for r in RULES]))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (failed == "")).alias("kept"), failed.alias("failed_rules"))
