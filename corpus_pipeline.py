"""A training-data pipeline over ``documents``: the stages are applied in
order, each written as Parquet and read again as the next one's input.  All but
the last return the columns of the documents they got."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomprep.llm import jaccard_join, mixing, packing, secret_scan, toxicity
from loomprep.session import materialize
from loomprep.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go; the model is learned
    from the labels of the documents given."""
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, weights, "toxicity_score")
    return scored.where(F.col("toxicity_score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id stays.
    Repeated rows of it stay once; documents without words or doc_id all stay."""
    joined = jaccard_join.jaccard_join(docs)
    gone = joined.where(F.col("class_id") != F.col("doc_id")).select(
        F.col("doc_id").alias("gone_id")).distinct()
    # the copies grow with the corpus: a shuffled join at every size
    rest = docs.join(gone.hint("merge"), F.col("doc_id") == F.col("gone_id"), "left_anti")
    # rows that repeat a kept document: few, so their texts are not looked at again
    again = materialize(joined.where((F.col("class_id") == F.col("doc_id")) & (F.col("n_links") > 0)
                                     ).groupBy(F.col("doc_id").alias("again_id")).agg(
        F.count("*").alias("n")).where("n > 1").select("again_id"), "repeated-rows")
    if again.isEmpty():
        return rest
    same = F.col("doc_id") == F.col("again_id")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    once = rest.join(again, same, "left_semi").withColumn(
        "row_of_document", F.row_number().over(first)).where("row_of_document = 1")
    return rest.join(again, same, "left_anti").unionByName(once.drop("row_of_document"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; no document goes."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences (see ``packing.pack``)."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The toxicity model and the tokenizer have no SQL form; tests/llm/test_pipeline.py
# compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
