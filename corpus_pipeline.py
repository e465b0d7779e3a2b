"""The corpus pipeline: five stages, each over all documents that the stage before has kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result as Parquet into the
shared folder and rereads it. All stages but the last return the columns of documents:

- quality: drops documents that the co-trained classifier rejects;
- near_duplicates: keeps the smallest doc_id of each component of near duplicates;
- decontaminate: drops documents that hold a benchmark item;
- secrets: replaces secrets by a mark, and n_chars by the new length where a text has changed;
- mix: gives each document its number of copies; documents that the mix leaves out have 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate as leaks
from millrace.llm import minhash, mixing
from millrace.llm import quality as classifier
from millrace.llm import secrets as scanner
from millrace.llm.common import table
from millrace.operators import staging


# Defined results of every stage: an empty table gives an empty one; repeated rows are decided alike; null or empty texts and columns of other
# names pass by the rules below; the order of rows says nothing.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject. Null and empty texts have a score like any other; without labels of
    both kinds all documents stay."""
    feats = classifier.features(docs, table(spark, sf_dir, "labels"))
    return classifier.keep(docs, classifier.train(feats))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component. Rows that repeat the kept doc_id are copies, too; one of them stays. Documents without words
    have no copies and stay. Rows with a null doc_id can't be named by a decision: of those with one text, one stays."""
    found = minhash.near_components(docs)
    # Only what is dropped is joined with the texts, by id; the ids are narrow.
    dropped = found.where("NOT kept AND component_id IS NOT NULL AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    times = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again, nameless = times.where("doc_id IS NOT NULL").select("doc_id"), not times.where("doc_id IS NULL").isEmpty()
    if nameless:
        kept = kept.where("doc_id IS NOT NULL").unionByName(kept.where("doc_id IS NULL").dropDuplicates(["text"]))
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; an empty benchmark leaves all."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret; a null text stays null, a text without secrets stays as it is."""
    old = "__millrace_old"
    marked = scanner.redact(docs.withColumn(old, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(old))
    if "n_chars" in docs.columns:
        marked = marked.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return marked.drop(old)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document with its copies. Documents of size 0 (null or empty texts) take no words; a null source is the last one."""
    m = mixing.mix(docs)
    return m.select("doc_id", F.col("src").alias("source"), "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("mix", mix)]

#: SQL expresses neither the classifier nor the joins; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's intermediate tables go when its result is written, and that goes when the next one is."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        mark, path = staging.mark(), staging.new_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        staging.release(spark, mark, keep=(path,))
        if last:
            staging.delete(spark, last)
        last = path
    return docs
