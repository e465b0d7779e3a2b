"""Shared helpers: tables, written intermediate tables, and native token expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.staging import few_files, new_path, settle, shared_dir, spread, staged  # noqa: F401

#: A word: a run of anything but space and the five ASCII white-space controls.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one's rows are dealt to all cores, a large one is scanned as it lies."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def cut(df: DataFrame) -> DataFrame:
    """staged(), for small tables in loops. A reread file has its real size; a checkpointed join keeps the product of its
    inputs' sizes as its estimate, and in a loop those estimates grow until planning does nothing else."""
    return staged(df, "loop")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(c: Column) -> Column:
    """Number of words; null counts as 0."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")


def bucket_of(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(c.cast("string").cast("binary")) % n
