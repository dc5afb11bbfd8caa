"""Near-duplicate lines by an exact set-similarity join, DataFrame code only.

A line is the set of its words.  A line goes if an earlier line, by (doc_id,
line number), anywhere in the corpus has a Jaccard similarity of at least
``percent`` / 100 with it, whether or not that line goes itself.

Words are hashed and ordered from rare to common.  Any fixed order gives the
exact result, so frequencies are kept in a table of ``BUCKETS`` hashed counts,
whose size does not grow with the vocabulary.  Equal sets are first reduced to
the earliest line.  Two sets at the threshold share a word among the first
n - ceil(t n) + 1 of each (prefix filter).  The join on those words also asks
for sizes within the threshold (length filter), enough words before and after
the shared one (positional filter) and few different bits: a line carries the
parities of its words' numbers over 64 bits (128, if it has ``LONG`` words), and
every bit in which two lines differ stands for a word that only one of them has
(bitmap filter).  So few pairs leave the join that aren't near; those that do are
verified by the sizes of their intersections, a line's likeliest pair first: the
others only if that one isn't near.

Words that very many lines have in their prefix (found on a hashed share of the
lines; a miss costs time, never a result) come from large groups of near
copies.  There each line first meets the earliest line only, by the same length
and bitmap filters; the lines that this removes need no further partner, so only the rest meet the whole group.

Cases: a null text stays null; lines of fewer than ``min_words`` distinct words
stay; repeated rows stand at one place, so neither removes the other; rows of
one doc_id with different texts are told apart by their texts; null doc_ids
come first; an empty table gives no rows.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm._common import discard, side, stored

PERCENT = 80
MIN_WORDS = 5
BUCKETS = 1 << 18
CLASS_BITS = 9                 # classes of rarity: 8 to each doubling of the count
HASH_BITS = 63 - CLASS_BITS
LONG = 80                      # lines of so many words have 128 bits, others 64
LOOK_AT, CROWD = 8, 32         # crowded: in the prefix of CROWD lines of one in LOOK_AT


def step(df: DataFrame, name: str, *used: DataFrame) -> DataFrame:
    """A stored table.  What made it is no longer needed: the stored tables ``used`` are
    deleted, and the shuffle files of finished jobs go as soon as the driver's JVM
    notices that nothing refers to them, which a collection makes it do now."""
    out = stored(df, name)
    for table in used:
        discard(table)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def pieces(line: Column) -> Column:
    """Of a text without line feeds: runs of characters other than ASCII white space,
    and empty strings.  Most lines have spaces only, which a few scans tell."""
    spaces, other = line, F.lit(False)
    for c in "\t\x0b\x0c\r":
        spaces, other = F.replace(spaces, F.lit(c), F.lit(" ")), other | line.contains(c)
    return F.when(other, F.split(spaces, " ")).otherwise(F.split(line, " "))


def hashes(line: Column) -> Column:
    """The line's distinct words as 64-bit hashes, without that of the empty string."""
    return F.array_remove(F.array_distinct(F.transform(pieces(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def need(n: Column, percent: int) -> Column:
    """ceil(percent * n / 100)"""
    return F.floor((n * percent + 99) / 100).cast("int")


def bucket(word: Column) -> Column:
    """Of a word's hash."""
    return word.bitwiseAND(F.lit(BUCKETS - 1))


def rarity(docs: DataFrame) -> Column:
    """The class of rarity of every bucket of words: an array constant of
    BUCKETS small numbers, whatever the corpus."""
    n = (docs.select(F.explode(F.split("text", "\n")).alias("line"))
         .select(F.explode(pieces(F.col("line"))).alias("w")).filter("w <> ''")
         .groupBy(bucket(F.xxhash64("w")).alias("b")).agg(F.count("*").alias("n")))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").alias("b"), F.lit(0).cast("long").alias("n"))
    level = F.least(F.floor(F.log2(F.col("n") + 1) * 8), F.lit((1 << CLASS_BITS) - 1)).cast("int")
    row = (n.unionByName(every).groupBy("b").agg(F.sum("n").alias("n")).select("b", level.cast("string").alias("c"))
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "c"))), lambda x: x["c"]), ",")))
    return F.split(F.lit(row.first()[0]), ",").cast("array<long>")


def ordered(words: Column, classes: Column) -> Column:
    """Distinct hashes as sorted numbers: class of rarity, then hash.
    (Arrays without nulls are sorted much faster.)"""
    level = lambda h: F.coalesce(F.get(classes, bucket(h).cast("int")), F.lit(0).cast("long"))
    return F.sort_array(F.transform(words, lambda h: F.shiftleft(level(h), HASH_BITS)
                                    .bitwiseOR(h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))))


def keys(line: Column, classes: Column) -> Column:
    """The line's distinct words, ``ordered``."""
    return ordered(hashes(line), classes)


def keyed(lines: DataFrame, classes: Column) -> DataFrame:
    """(d, th, l, n, k): the number and the keys of each line's words.  The hashes are a
    column of their own, used twice, so that Spark makes them distinct in compiled code;
    as the argument of a lambda function they would be interpreted over objects."""
    return (lines.select("d", "th", "l", hashes(F.col("line")).alias("s"))
            .select("d", "th", "l", F.size("s").alias("n"), ordered(F.col("s"), classes).alias("k")))


def numbered(docs: DataFrame) -> DataFrame:
    """(d, th, l, line): every line of every text; d and th tell the document."""
    return (docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("th"), "text")
            .select("d", "th", F.posexplode(F.split("text", "\n")).alias("l", "line")))


def parities(words: Column) -> Column:
    """For each of 64 bits, whether an odd number of the words falls on it."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseXOR(bit(w)))


def upper(words: Column) -> Column:
    """The words on the upper 64 of 128 bits."""
    return F.filter(words, lambda w: w.bitwiseAND(F.lit(64)) != 0)


def place(*names: str) -> Column:
    return F.struct(*names)


def before(d: Column, l: Column, d2: Column, l2: Column) -> Column:  # noqa: E741
    """place(d, l) < place(d2, l2), without making structs: a join asks it very often."""
    return (d < d2) | (d.eqNullSafe(d2) & (l < l2)) | (d.isNull() & d2.isNotNull())


def word_sets(docs: DataFrame, pairs: DataFrame, min_words: int) -> DataFrame:
    """(d, th, l, s): the words of all lines of those pairs (ad, al), (bd, bl)."""
    wanted = step(pairs.select(F.col("ad").alias("_d"), F.col("al").alias("_l"))
                  .unionByName(pairs.select(F.col("bd").alias("_d"), F.col("bl").alias("_l")))
                  .groupBy("_d").agg(F.collect_set("_l").alias("_ls")), "line-wanted")
    lines = (docs.join(side(wanted), F.col("doc_id").eqNullSafe(F.col("_d")))
             .select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("th"), F.split("text", "\n").alias("lines"), "_ls")
             .select("d", "th", "lines", F.explode("_ls").alias("l")).filter(F.col("l") < F.size("lines")))
    return step(lines.select("d", "th", "l", F.explode(F.array(hashes(F.get("lines", "l")))).alias("s"))
                .filter(F.size("s") >= min_words), "line-words", wanted)


def similar(sets: DataFrame, pairs: DataFrame, percent: int, name: str) -> DataFrame:
    """(d, th, l, near): the later lines of those pairs, and whether any of their
    pairs reaches the threshold."""
    x = sets.select(F.col("d").alias("xd"), F.col("l").alias("xl"), F.col("s").alias("xs"))
    y = sets.select(F.col("d").alias("yd"), F.col("l").alias("yl"), F.col("th").alias("yt"), F.col("s").alias("ys"))
    # a column of its own: as the argument of a lambda function it would be interpreted
    both = (pairs.join(x, F.col("ad").eqNullSafe(F.col("xd")) & (F.col("al") == F.col("xl")))
            .join(y, F.col("bd").eqNullSafe(F.col("yd")) & (F.col("bl") == F.col("yl")))
            .select(F.col("bd").alias("d"), F.col("yt").alias("th"), F.col("bl").alias("l"),
                    (F.size("xs") + F.size("ys")).alias("sizes"), F.size(F.array_intersect("xs", "ys")).alias("both")))
    near = F.col("both") * 100 >= (F.col("sizes") - F.col("both")) * percent
    return step(both.groupBy("d", "th", "l").agg(F.max(near).alias("near")), name)


def settled(checked: DataFrame) -> DataFrame:
    """(_d, _l): the places all of whose lines (rows may share a doc_id) have an earlier near line."""
    return (checked.groupBy(F.col("d").alias("_d"), F.col("l").alias("_l")).agg(F.min("near").alias("near"))
            .filter("near").select("_d", "_l"))


def differing(n: Column, p: Column, q: Column, n2: Column, p2: Column, q2: Column) -> Column:
    """The words that only one of two lines has, by their parities: at least so many."""
    long = (n >= LONG) & (n2 >= LONG)
    x, y = p.bitwiseXOR(p2), q.bitwiseXOR(q2)
    return F.when(long, F.bit_count(x.bitwiseXOR(y)) + F.bit_count(y)).otherwise(F.bit_count(x))


def alike(differ: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sizes ``n`` and ``m`` and at least ``differ`` different words allow the threshold."""
    return ((n * 100 >= m * percent) & (m * 100 >= n * percent)
            & (differ * (100 + percent) <= (n + m) * (100 - percent)))


def meetings(earlier: DataFrame, later: DataFrame, percent: int) -> DataFrame:
    """(ad, al, bd, bl, differ) for each word that the prefixes of two lines share,
    if their sizes, the word's positions and the parities allow the threshold."""
    a = earlier.select(F.col("w").alias("aw"), F.col("d").alias("ad"), F.col("l").alias("al"), F.col("n").alias("an"),
                       F.col("i").alias("ai"), F.col("p").alias("ap"), F.col("q").alias("aq"))
    b = later.select(F.col("w").alias("bw"), F.col("d").alias("bd"), F.col("l").alias("bl"), F.col("n").alias("bn"),
                     F.col("i").alias("bi"), F.col("p").alias("bp"), F.col("q").alias("bq"))
    # at most so many words are common, if this is the first one; others of the pair need not pass
    common = F.least(F.col("an") - F.col("ai"), F.col("bn") - F.col("bi"))
    differ = differing(*map(F.col, ("an", "ap", "aq", "bn", "bp", "bq")))
    return a.join(b, (F.col("aw") == F.col("bw")) & (common * (100 + percent) >= (F.col("an") + F.col("bn")) * percent)
                  & before(*map(F.col, ("ad", "al", "bd", "bl"))) & alike(differ, F.col("an"), F.col("bn"), percent)).select("ad", "al", "bd", "bl", differ.alias("differ"))


def removed_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, th, gone): the numbers of the lines to remove, for each document that has any."""
    docs = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    # so many words take so many characters; the filter on n comes after the step, as it would
    # be pushed below and compute the keys twice
    lines = (keyed(numbered(docs).filter(F.length("line") >= 2 * min_words - 1), rarity(docs))
             .select("d", "th", "l", "n", F.xxhash64("k").alias("h"), F.hash("k").alias("h2"),
                     parities(F.col("k")).alias("p"),
                     F.when(F.col("n") >= LONG, parities(upper(F.col("k")))).otherwise(F.lit(0).cast("long")).alias("q"),
                     F.slice("k", F.lit(1), F.col("n") - need(F.col("n"), percent) + 1).alias("prefix")))
    stored_lines = step(lines, "line-sets")
    lines = stored_lines.filter(F.col("n") >= min_words)

    # equal sets: the earliest stands for them
    many = step(lines.groupBy("h", "h2", "n").agg(F.count("*").alias("c")).filter("c > 1").select("h", "h2", "n"), "line-many")
    same = step(lines.select("h", "h2", "n", "d", "l").join(side(many), ["h", "h2", "n"], "left_semi")
                .groupBy(F.col("h").alias("_h"), F.col("h2").alias("_h2"), F.col("n").alias("_n"))
                .agg(F.min(place("d", "l")).alias("first")), "line-same", many)
    marked = lines.join(side(same), (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2"))
                        & (F.col("n") == F.col("_n")), "left")
    equal = marked.filter(place("d", "l") > F.col("first")).select("d", "th", "l")
    first = marked.filter(F.col("first").isNull() | (place("d", "l") == F.col("first")))
    posts = first.select("d", "l", "n", "p", "q", F.posexplode("prefix").alias("i", "w"))

    # crowded words: against the earliest line first
    crowded = step(posts.filter(F.pmod(F.xxhash64("d", "l"), F.lit(LOOK_AT)) == 0).groupBy(F.col("w").alias("_w"))
                     .agg(F.count("*").alias("c")).filter(F.col("c") >= CROWD).select("_w"), "line-crowded")
    dense = step(posts.join(side(crowded), F.col("w") == F.col("_w"), "left_semi"), "line-dense")
    lead = step(dense.groupBy(F.col("w").alias("_w")).agg(F.min(F.struct("d", "l", "n", "p", "q")).alias("a")), "line-lead")
    star = (dense.join(side(lead), F.col("w") == F.col("_w"))
            .filter(alike(differing(*map(F.col, ("a.n", "a.p", "a.q", "n", "p", "q"))), F.col("a.n"), F.col("n"), percent)
                    & (F.struct("a.d", "a.l") < F.struct("d", "l")))
            .groupBy("d", "l").agg(F.min("a").alias("a"))
            .select(F.col("a.d").alias("ad"), F.col("a.l").alias("al"), F.col("d").alias("bd"), F.col("l").alias("bl")))
    star = step(star, "line-star")
    sets = word_sets(docs, star, min_words)
    quick = similar(sets, star, percent, "line-quick")
    rest = dense.join(settled(quick), F.col("d").eqNullSafe(F.col("_d")) & (F.col("l") == F.col("_l")), "left_anti")

    sparse = posts.join(side(crowded), F.col("w") == F.col("_w"), "left_anti")
    pairs = step(meetings(sparse, sparse, percent).unionByName(meetings(dense, rest, percent)).distinct(), "line-pairs")
    # each line against its likeliest partner first, then what is left
    best = step(pairs.groupBy("bd", "bl").agg(F.min(F.struct("differ", "ad", "al")).alias("a"))
                .select("a.ad", "a.al", "bd", "bl"), "line-best", dense, lead, sets, star)
    sets = word_sets(docs, pairs, min_words)
    near = similar(sets, best, percent, "line-near")
    left = step(pairs.join(settled(near), F.col("bd").eqNullSafe(F.col("_d")) & (F.col("bl") == F.col("_l")), "left_anti")
                .select("ad", "al", "bd", "bl"), "line-left")
    late = similar(sets, left, percent, "line-late")
    found = quick.unionByName(near).unionByName(late).filter("near").select("d", "th", "l")
    # lines equal to one that goes are later than it, and go as equal lines
    return step(equal.unionByName(found).groupBy("d", "th").agg(F.sort_array(F.collect_set("l")).alias("gone")), "line-gone",
                stored_lines, same, crowded, quick, sets, pairs, best, near, left, late)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def without(text: Column, gone: Column) -> Column:
    """The text without the lines whose sorted numbers are in ``gone``."""
    def rest(lines: Column, ends: Column) -> Column:
        return F.array_join(F.flatten(F.transform(
            F.sequence(F.lit(0), F.size(ends) - 2),
            lambda j: F.slice(lines, F.get(ends, j) + 2, F.get(ends, j + 1) - F.get(ends, j) - 1))), "\n")

    return once(F.split(text, "\n"), lambda lines: once(
        F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines))), lambda ends: rest(lines, ends)))


def joined(docs: DataFrame, percent: int, min_words: int) -> tuple[DataFrame, str]:
    """``docs`` with the numbers of the lines to remove, in a column whose name is the
    second value (a name that ``docs`` has not)."""
    mark = "_line"
    while any(c.startswith(mark) for c in docs.columns):
        mark = "_" + mark
    gone = removed_lines(docs, percent, min_words).select(
        F.col("d").alias(f"{mark}_d"), F.col("th").alias(f"{mark}_th"), F.col("gone").alias(f"{mark}_gone"))
    return docs.join(side(gone), F.col("doc_id").eqNullSafe(F.col(f"{mark}_d"))
                     & (F.xxhash64("text") == F.col(f"{mark}_th")), "left"), f"{mark}_gone"


def line_dedup(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row a document: doc_id, n_lines, n_removed, removed (line numbers
    from 0), text."""
    rows, mark = joined(docs.select("doc_id", "text"), percent, min_words)
    gone = F.coalesce(mark, F.array().cast("array<int>"))
    return rows.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"), gone.alias("removed"),
        F.when(F.col(mark).isNull(), F.col("text")).otherwise(without(F.col("text"), gone)).alias("text"))


def dedup_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs``, all columns, with the removed lines taken out of ``text`` and
    ``n_chars``, where there is one, brought up to date."""
    rows, mark = joined(docs, percent, min_words)
    text = F.when(F.col(mark).isNull(), F.col("text")).otherwise(without(F.col("text"), F.col(mark)))
    new = rows.withColumn(f"{mark}_text", text)
    size = F.when(F.col(mark).isNull(), F.col("n_chars")).otherwise(F.length(f"{mark}_text"))
    return new.select(*[
        F.col(f"{mark}_text").alias(c) if c == "text" else
        size.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
