"""Corpus pipeline: toxic documents out, one document of each near-duplicate group, benchmark passages
out, sources mixed to target weights, token ids written and read back.

Every stage takes (spark, docs, sf_dir) and works on all of ``docs``; all but the last return the
columns of documents.  :func:`run` writes each stage's result as Parquet under the shared checkpoint
folder and rereads it for the next, so a stage restarts from whole files after a lost executor.

Null and empty texts pass the first three stages (they are not toxic, link with nothing and hold no
passage); the mix takes no words from them, so they end there.  Rows with a null doc_id are documents of
their own.  An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import op01_ngram_join, op05_token_ids, op06_toxicity, op09_mix, op10_decontaminate
from tillwise.llm.common import broadcast_if_small, materialize, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the lexicon learned from the labelled training rows."""
    model = op06_toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return op06_toxicity.score(docs, model).where("score < 0.5").select("row.*")


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the smallest doc_id (nulls last; of several
    texts under it, the one with the smallest hash); of rows equal in doc_id and text, the smallest by
    the other columns.

    Rows are told apart by a hash of doc_id and text, so different texts under one id, and rows without
    an id, are documents of their own: they go only if a near duplicate stays."""
    key = F.xxhash64("doc_id", "text")
    found = materialize(op01_ngram_join.jaccard_components(docs.select(key.alias("doc_id"), "text"))
                        .where("n_shingles > 0").select(F.col("doc_id").alias("_key"), "component_id"), "pipeline-groups")
    shared = (found.groupBy(F.col("component_id").alias("_of")).agg(F.min("_key").alias("a"), F.max("_key").alias("b"))
              .where("a <> b").select("_of"))
    members = materialize(found.join(shared, found.component_id == shared["_of"]).select("_key", "component_id").distinct(),
                          "pipeline-members")
    ids = docs.select(key.alias("_k"), "doc_id").join(broadcast_if_small(members), F.col("_k") == F.col("_key"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    stays = ids.groupBy(F.col("component_id").alias("_of")).agg(F.min_by("_key", place).alias("_stays"))
    gone = materialize(members.join(stays, members.component_id == stays["_of"]).where("_key <> _stays").select("_key"),
                       "pipeline-gone")
    kept = docs.withColumn("_key", key).join(broadcast_if_small(gone), "_key", "left_anti")
    again = materialize(found.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key")
                        .join(gone, "_key", "left_anti"), "pipeline-again")
    if again.limit(1).count() == 0:
        return kept.select(docs.columns)
    again = broadcast_if_small(again)
    single = kept.join(again, "_key", "left_anti").select(docs.columns)
    repeated = (kept.join(again, "_key", "left_semi").groupBy("_key", "doc_id", "text")
                .agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*"))
    return single.union(repeated.select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows."""
    bench = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = op10_decontaminate.find_contamination(docs, bench)
    return found.where(~op10_decontaminate.contaminated(F.col("n_hit"), F.col("n_words"))).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for every pass of the mix over a document, with the words it takes."""
    return op09_mix.mixed_documents(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ascending doc_id order, written to files and read back."""
    return op05_token_ids.encode_and_read(docs, op05_token_ids.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_per_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_ids),
]

# The lexicon is learned and the mix is drawn; SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
