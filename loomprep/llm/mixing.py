"""Mixing sources to target weights with hash-threshold histograms.

A source's target is its share of all words by weight, at most ``repeats``
times its own size, the excess reshared by weight among the others.  A source
takes every document ``base = floor(target / size)`` times, and once more the
documents whose hash lies below the source's threshold.  Thresholds are found
without sorting documents: words are summed by source and hash bucket, the
bucket in which the running sum passes the budget is the boundary, and only
its documents are summed again by the next bits of the hash, until each
boundary holds one hash.  The boundary hash is taken if that comes nearer to
the budget.  Thresholds are nested: a larger budget only adds documents.

The histograms hold at most ``2**BITS`` rows for each source and are summed on
the map side first; a hot source costs no more rows than any other.  The table
of thresholds has a row for each source; Spark's own size check decides
whether it is broadcast.

Defined cases: a null text has size 0; sources are ordered by code point, a
null source is last and a source of its own; a source without words has target
0 and takes nothing; rows equal in doc_id and text share a hash, so they are
taken or left together; a null doc_id hashes as the word null; an empty table
gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
BITS = 15
LEVELS = 4                       # 60 bits of hash
WORD = r"[^\x20\x09-\x0D]+"


def hash_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """60 bits of an md5 over doc_id and text, as a long."""
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"),
                            F.md5(F.coalesce(F.col(text), F.lit("")))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, source_size -> target added; one row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    capped = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size").cast("double") * repeats).withColumn(
        "level", F.col("cap") / F.col("weight"))
    # the water level if exactly the sources before this one stop at their caps
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / open_weight
    found = capped.withColumn("water", F.when(level <= F.col("level"), level))
    water = F.min_by("water", F.when(F.col("water").isNotNull(), F.col("level"))).over(everything)
    return found.withColumn("target", F.least("cap", water * F.col("weight"))).select(
        "source", "source_size", "target")


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """source, source_size, target, base, threshold: documents with a key below
    the threshold are taken once more.  ``sized``: source, size, key."""
    spark = sized.sparkSession
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                  ).otherwise(F.lit(0)).cast("long")
    state = goals.withColumn("base", base).withColumn(
        "budget", F.col("target") - F.col("base") * F.col("source_size")).select(
        "*", F.lit(0).cast("long").alias("passed"), F.lit(0).cast("long").alias("prefix"),
        F.lit(None).cast("long").alias("threshold"))
    state = materialize(state, "mix-goals")
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        bucket = F.shiftright("key", shift)
        open_ = state.where(F.col("threshold").isNull()).select(
            F.col("source").alias("s"), "prefix", "budget", "passed")
        hist = sized.join(open_, F.col("source").eqNullSafe(F.col("s"))
                          & (F.shiftright("key", shift + BITS) == F.col("prefix"))
                          ).groupBy("s", "budget", "passed", bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high"))
        run = Window.partitionBy("s").orderBy("bucket")
        edge = hist.withColumn("upto", F.col("passed") + F.sum("size").over(run)).where(
            F.col("upto") > F.col("budget")).groupBy("s").agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("passed"),
                           "size", "low", "high")).alias("edge"))
        one = F.col("edge.low") == F.col("edge.high")
        nearer = (F.col("edge.passed") + F.col("edge.size") - F.col("budget")
                  < F.col("budget") - F.col("edge.passed"))
        after = state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
        full = F.lit(1 << (BITS * LEVELS)).cast("long")
        state = materialize(after.select(
            "source", "source_size", "target", "base", "budget",
            F.coalesce("edge.passed", "passed").alias("passed"),
            F.coalesce("edge.bucket", "prefix").alias("prefix"),
            F.when(F.col("threshold").isNotNull(), F.col("threshold"))
            .when(F.col("edge").isNull(), full)               # all of it fits
            .when(one, F.col("edge.low") + F.when(nearer, 1).otherwise(0))
            .alias("threshold")), "mix-edges")
        if state.where(F.col("threshold").isNull()).isEmpty():
            break
    return state.select("source", "source_size", "target", "base", "threshold")


def plan_mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> tuple:
    """(sized rows: doc_id, source, size, key; thresholds) of the mix."""
    sized = materialize(docs.select("doc_id", "source", n_words().alias("size"),
                                    hash_key().alias("key")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sized, thresholds(sized, targets(sizes, weights, repeats))


def _copies() -> Column:
    return (F.col("base") + F.when(F.col("key") < F.col("threshold"), 1).otherwise(0)).cast("long")


def mix_sizes(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken."""
    sized, plan = plan_mix(docs, weights, repeats)
    out = sized.join(plan.withColumnRenamed("source", "s"),
                     F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      _copies().alias("copies"), (F.col("size") * _copies()).alias("taken"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    _, plan = plan_mix(docs, weights, repeats)
    plan = plan.select(F.struct("*").alias("mix_plan"))
    keyed = docs.select(F.struct("*").alias("doc"))
    copies = (F.col("mix_plan.base") + F.when(
        hash_key("doc.doc_id", "doc.text") < F.col("mix_plan.threshold"), 1).otherwise(0))
    return keyed.join(plan, F.col("doc.source").eqNullSafe(F.col("mix_plan.source"))).select(
        "doc", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("copy")).select("doc.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':'
                             || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size::DOUBLE * 3 AS cap
  FROM sources),
levels AS (
  SELECT *, cap / weight AS level,
         (sum(source_size) OVER ()::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER ()
            - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS water
  FROM weighted),
goals AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT arg_min(water, level) FROM levels WHERE water <= level)) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base
  FROM goals),
keys AS (
  SELECT source, key, sum(size)::BIGINT AS size FROM sized GROUP BY source, key),
running AS (
  SELECT k.source, key, k.size, base, target - base * source_size AS budget,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY key)::BIGINT AS upto
  FROM keys k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source),
edges AS (
  SELECT source, min(key) AS key,
         arg_min(upto - budget < budget - (upto - size), key) AS nearer
  FROM running WHERE upto > budget GROUP BY source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * (b.base + CASE WHEN e.key IS NULL OR d.key < e.key + nearer::INT
                                THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
"""
