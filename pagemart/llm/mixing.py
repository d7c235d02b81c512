"""Mixing sources to target weights with weighted sampling without replacement (Efraimidis-Spirakis).

Every document gets an exponential key, -ln(u) / w: u from a hash of its id, w its quality weight. In
key order a source's documents form a weighted random permutation, and a prefix sum of their sizes against the
source's budget selects them. A budget beyond the source's size first takes complete epochs of it; the
rest is a fractional epoch. DataFrame expressions only.

The prefix sum is not one window per source: sizes are summed per slice of the key range first, so only the
slice in which the budget ends is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, settle

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# a slice of the key range holds at most about 0.37 / SLICES of a source, whatever the weights are
SLICES = 512
# fixed value: the characters counted against a text's quality
NOISE = "#*$%&|<>!"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: str) -> Column:
    """1 for a text without noise characters, falling to 0.1 where one in ten is noise."""
    n = F.char_length(F.coalesce(F.col(text), F.lit("")))
    noise = n - F.char_length(F.translate(F.coalesce(F.col(text), F.lit("")), NOISE, ""))
    return F.greatest(F.lit(0.1), 1 - 9.0 * noise / F.greatest(n, F.lit(1)))


def uniform(doc_id: str) -> Column:
    """A number in (0, 1) from the id: 52 bits of its MD5."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source (source, source_size, n): target words. Weights 5, 2, 1 repeat over the sources in code
    point order, null last; they share all words. A target stops at ``MAX_EPOCHS`` times its
    source's size; what is over goes to the others by weight until none is above: target = min(cap, level * weight), where the
    level is read off the sources in order of cap / weight. One row per source goes through this."""
    rank = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(rank) - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("cap", MAX_EPOCHS * F.col("source_size"))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    before = lambda c: F.coalesce(F.sum(c).over(filled), F.lit(0))
    level = (F.sum("source_size").over(whole) - before("cap")) / (F.sum("weight").over(whole) - before("weight"))
    levels = ranked.withColumn("level", level)
    # taking out a source below the level raises the level, taking out one above lowers it: the highest counts
    target = F.least(F.col("cap").cast("double"), F.max("level").over(whole) * F.col("weight"))
    return levels.withColumn("target", target).drop("weight", "cap", "level")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weight: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, k_text (hash of the text), size, source_size, target, copies and taken.

    ``copies`` is how often the mix holds the document (complete epochs, plus one if the fractional
    epoch takes it), ``taken`` = copies * size. The fractional epoch takes documents in key order while
    that brings the source's words nearer to its target. ``weight`` (above 0) defaults to ``quality_weight``.

    A null text has size 0; a null source is a source of its own. Ties in the key go by id, then
    text; repeated rows are separate documents. An empty table gives no rows."""
    w = quality_weight(text) if weight is None else weight
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k_text"),
                       word_count(text).alias("size"), (-F.log(uniform(doc_id)) / w).alias("key"))
    rows = rows.withColumn("slice", F.floor(F.log("key") * SLICES).cast("int")) \
        .withColumn("src", F.coalesce("source", F.lit(""))).withColumn("no_src", F.col("source").isNull())
    rows = settle(rows, "mix-rows")
    keys = ["src", "no_src"]

    slices = settle(rows.groupBy("source", *keys, "slice").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")),
                    "mix-slices")
    sizes = slices.groupBy("source", *keys).agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    targets = source_targets(sizes)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs) \
        .withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    # the slice in which the budget ends, and the words of the slices before it
    upto = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = (slices.withColumn("upto", F.sum("words").over(upto)).join(targets.select(*keys, "budget"), keys)
            .where("upto > budget").groupBy(*keys)
            .agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("before"))).alias("e")))
    targets = (targets.join(ends, keys, "left")
               .select(*keys, "n", "source_size", "target", "epochs", "budget", F.col("e.slice").alias("end_slice"), "e.before"))
    targets = settle(targets, "mix-targets")

    placed = lookup(rows, targets, keys, "n", rows.count())
    at_end = F.coalesce(F.col("slice") == F.col("end_slice"), F.lit(False))
    clear = placed.where(~at_end).withColumn(
        "picked", ((F.col("budget") > 0) & F.coalesce(F.col("slice") < F.col("end_slice"), F.lit(True))).cast("long"))
    order = Window.partitionBy(*keys).orderBy("key", "doc_id", "k_text").rowsBetween(Window.unboundedPreceding, 0)
    upto_doc = F.col("before") + F.sum("size").over(order)
    ended = placed.where(at_end).withColumn("picked", ((F.col("budget") > 0) & (upto_doc - F.col("size") / 2 <= F.col("budget"))).cast("long"))
    copies = (F.col("epochs") + F.col("picked")).alias("copies")
    return (clear.unionByName(ended).select("doc_id", "k_text", "size", "source_size", "target", copies)
            .withColumn("taken", F.col("copies") * F.col("size")))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
q AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         greatest(0.1, 1 - 9.0::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>!', ''))) / greatest(length(t), 1)) AS w,
         (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
           / 4503599627370496.0::DOUBLE AS u,
         t FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS weight
  FROM q GROUP BY source),
c AS (
  SELECT *, 3 * source_size AS cap,
         ((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER f, 0))::DOUBLE
           / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER f, 0))::DOUBLE AS lvl
  FROM s WINDOW f AS (ORDER BY (3 * source_size)::DOUBLE / weight, source IS NULL, encode(source)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, (SELECT max(lvl) FROM c) * weight) AS target
  FROM c),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT q.doc_id, q.size, e.source_size, e.target, e.epochs, target - epochs * e.source_size AS budget,
         sum(q.size) OVER (PARTITION BY q.source ORDER BY -ln(u) / w, q.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM q JOIN e ON q.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST((epochs + CASE WHEN budget > 0 AND upto - size / 2.0::DOUBLE <= budget THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM p
"""
