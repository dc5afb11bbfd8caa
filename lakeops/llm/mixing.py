"""Mixing sources to target weights by temperature.

A source with share p of all tokens gets weight p ** alpha, normalised.  The
exponent is the largest flattening (least alpha in [0, 1]) that the limits
allow, found by repeated bisection: the entropy of the weights must reach
``target_entropy`` of its maximum (the largest such alpha is taken; by default half
way from the entropy of the natural shares to the maximum, a target that no corpus of
unequal sources has already met), and no
source may be repeated more than ``max_repeat`` times within the budget (alpha
is raised until that holds; the repetition limit goes first).

The weights are realised as budgeted block permutations: documents of a source
are dealt into blocks by hash; whole epochs take every block, and the last
epoch takes blocks in a hashed order until the budget is reached, the block on
the border by documents in hashed order.  What a document gets depends only on
its id and one small row of its source, so documents meet a table of sources
and no window ever runs over a source.

Cases: a null source is a source; null and empty texts hold no tokens: they
count as one token, so that no source weighs nothing; repeated rows share
their hash and go together; an empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm._common import side, stored

BLOCK_DOCS = 512
STEPS = 16                     # points of one round of the bisection
ROUNDS = 9                     # 17 ** 9 > 1e11: alpha to eleven digits


def n_tokens(text: Column) -> Column:
    """Words between white space, at least 1."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")), F.lit(1)).cast("long")


def exponent(sources: DataFrame, total: int, budget: int, target_entropy: float | None, max_repeat: float) -> float:
    """alpha for the table (source, tokens)."""
    def measure(alphas: list[float]) -> list[tuple[float, float]]:
        """(entropy / maximum, most repeats) at each alpha, in one small job."""
        p = F.col("tokens") / F.lit(float(total))
        pw = F.pow(p, F.col("alpha"))
        rows = {r["k"]: r for r in sources
                .select("tokens", F.posexplode(F.array(*[F.lit(float(a)) for a in alphas])).alias("k", "alpha"))
                .groupBy("k").agg(F.count("*").alias("n"), F.sum(pw).alias("z"), F.sum(pw * F.log(pw)).alias("s"),
                                  F.max(pw / F.col("tokens")).alias("m")).collect()}     # a row for each alpha
        out = []
        for k in range(len(alphas)):
            r = rows[k]
            entropy = math.log(r["z"]) - r["s"] / r["z"]
            out.append((entropy / math.log(r["n"]) if r["n"] > 1 else 1.0, r["m"] / r["z"] * budget))
        return out

    def largest(holds, low: float = 0.0, high: float = 1.0) -> tuple[float, float]:
        """(last alpha that holds, first that does not) if it holds below a border."""
        for _ in range(ROUNDS):
            grid = [low + (high - low) * (i + 1) / (STEPS + 1) for i in range(STEPS)]
            ok = [holds(*x) for x in measure(grid)]
            n = ok.index(False) if False in ok else len(ok)
            low, high = ([low] + grid)[n], (grid + [high])[n]
        return low, high

    (flat_h, flat_r), (full_h, full_r) = measure([0.0, 1.0])
    if target_entropy is None:
        target_entropy = (full_h + 1) / 2
    if full_h >= target_entropy:
        alpha = 1.0
    else:
        alpha = largest(lambda h, r: h >= target_entropy)[0]
    if measure([alpha])[0][1] > max_repeat:
        alpha = 1.0 if full_r > max_repeat else largest(lambda h, r: r > max_repeat)[1]
    return alpha


def hashed(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def block_of(doc: Column, n_blocks: Column, seed: int) -> Column:
    return F.pmod(hashed(doc, F.lit(seed)), n_blocks)


def plan(docs: DataFrame, budget_tokens: int | None, target_entropy: float | None, max_repeat: float,
         seed: int) -> DataFrame | None:
    """One row a source: weight, whole epochs, and the cut of the last epoch:
    blocks of order below ``cut_block``, and of the block at it the documents
    of order below ``cut_doc``.  None for an empty table."""
    sizes = stored(docs.select("source", "doc_id", n_tokens(F.col("text")).alias("tokens")), "mix-sizes")
    sources = stored(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")),
                     "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return None
    budget = budget_tokens or total
    alpha = exponent(sources, total, budget, target_entropy, max_repeat)
    z = sources.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(alpha)))).first()[0]
    goal = stored(
        sources.withColumn("weight", F.pow(F.col("tokens") / F.lit(float(total)), F.lit(alpha)) / F.lit(z))
        .withColumn("goal", F.floor(F.col("weight") * budget + F.lit(0.5)))
        .select("source", "weight", "tokens", F.floor(F.col("goal") / F.col("tokens")).cast("int").alias("epochs"),
                (F.col("goal") % F.col("tokens")).alias("rest"),
                F.ceil(F.col("docs") / BLOCK_DOCS).cast("long").alias("n_blocks")), "mix-goals")

    own = [F.col(c).alias(f"_{c}") for c in ("source", "epochs", "rest", "n_blocks")]
    same = F.col("source").eqNullSafe(F.col("_source"))
    dealt = (sizes.join(side(goal.select(*own)), same)
             .withColumn("block", block_of(F.col("doc_id"), F.col("_n_blocks"), seed)))
    order = hashed(F.col("block"), F.col("_epochs"), F.lit(seed + 1))
    blocks = (dealt.groupBy("source", "block", "_rest", "_epochs").agg(F.sum("tokens").alias("tokens"))
              .withColumn("order", order)
              .withColumn("upto", F.sum("tokens").over(Window.partitionBy("source").orderBy("order", "block"))))
    # the block on the border: the first that does not fit whole
    border = (blocks.filter(F.col("upto") > F.col("_rest"))
              .groupBy("source").agg(F.min(F.struct("order", "block", "upto", "tokens", "_rest")).alias("x"))
              .select(F.col("source").alias("_source"), F.col("x.order").alias("cut_block"),
                      F.col("x.block").alias("_block"),
                      (F.col("x._rest") - F.col("x.upto") + F.col("x.tokens")).alias("_room")))
    border = stored(border, "mix-border")
    inside = (dealt.drop("_source").join(side(border), same & (F.col("block") == F.col("_block")))
              .withColumn("doc_order", hashed(F.col("doc_id"), F.col("_epochs"), F.lit(seed + 2)))
              .groupBy("source", "doc_order", "_room").agg(F.sum("tokens").alias("tokens"))
              .withColumn("upto", F.sum("tokens").over(Window.partitionBy("source").orderBy("doc_order")))
              .filter(F.col("upto") > F.col("_room"))
              .groupBy(F.col("source").alias("_source")).agg(F.min("doc_order").alias("cut_doc")))
    cut = border.select(F.col("_source").alias("_s1"), "cut_block").join(
        inside.select(F.col("_source").alias("_s2"), "cut_doc"), F.col("_s1").eqNullSafe(F.col("_s2")), "left")
    return stored(goal.join(cut, F.col("source").eqNullSafe(F.col("_s1")), "left")
                  .select("source", "weight", "epochs", "n_blocks", "cut_block", "cut_doc"), "mix-plan")


def mix(docs: DataFrame, budget_tokens: int | None = None, target_entropy: float | None = None, max_repeat: float = 4.0,
        seed: int = 11, digest: bool = False) -> DataFrame:
    """The documents of the mix, a document once for each time it is taken.
    With ``digest``: doc_id, source, weight, epoch, block, block_order (its
    place in the epoch's permutation is by this number), doc_order."""
    p = plan(docs, budget_tokens, target_entropy, max_repeat, seed)
    names = ["source", "weight", "epochs", "n_blocks", "cut_block", "cut_doc"]
    if p is None:
        p = docs.sparkSession.createDataFrame([], "source string, weight double, epochs int, n_blocks bigint, "
                                                  "cut_block bigint, cut_doc bigint")
    mark = "_mix_"
    p = p.select(*[F.col(c).alias(mark + c) for c in names])
    col = {c: F.col(mark + c) for c in names}
    block = block_of(F.col("doc_id"), col["n_blocks"], seed)
    order = hashed(block, col["epochs"], F.lit(seed + 1))
    doc_order = hashed(F.col("doc_id"), col["epochs"], F.lit(seed + 2))
    partial = (F.coalesce(order < col["cut_block"], F.lit(False))
               | F.coalesce((order == col["cut_block"]) & (doc_order < col["cut_doc"]), F.lit(False)))
    times = col["epochs"] + partial.cast("int")
    taken = (docs.join(side(p, 100_000), F.col("source").eqNullSafe(col["source"]))
             .withColumn(mark + "times", times).filter(F.col(mark + "times") > 0)
             .withColumn(mark + "epoch", F.explode(F.sequence(F.lit(0), F.col(mark + "times") - 1))))
    if not digest:
        return taken.select(*[F.col(c) for c in docs.columns])
    epoch = F.col(mark + "epoch")
    return taken.select("doc_id", "source", col["weight"].alias("weight"), epoch.alias("epoch"),
                        block.alias("block"), hashed(block, epoch, F.lit(seed + 1)).alias("block_order"),
                        hashed(F.col("doc_id"), epoch, F.lit(seed + 2)).alias("doc_order"))
