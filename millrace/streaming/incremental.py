"""Incremental runs over a stream of document files: each micro-batch is deduplicated against index tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.filtering import DUPLICATE_NEAR, LOW_QUALITY
from millrace.operators.staging import delete, exists
from millrace.plans.config import RunConfig
from millrace.plans.pipeline import ledger
from millrace.plans.state import checkpoint_due, merge_counts
from millrace.sources.sinks import save_json


def _index(spark: SparkSession, folder: str, column: str, number: int) -> DataFrame | None:
    """The keys of all batches before ``number``: a table partitioned by batch, so one scan with a partition filter."""
    if not exists(spark, folder):
        return None
    return spark.read.schema(f"{column} {'string' if column == 'canonical_hash' else 'long'}, batch long").parquet(folder).where(F.col("batch") < number).select(column)


def _put(df: DataFrame, folder: str, number: int, files: int) -> None:
    df.coalesce(files).write.mode("overwrite").parquet(f"{folder}/batch={number}")


def _compact(spark: SparkSession, folder: str, number: int, every: int, schema: str) -> None:
    """Before each ``every``-th batch, the ``every`` batches before it become one, which the stream has committed all.

    Keys matter as a set only: the first of these batches takes the others' keys, and then the others go, so a reader sees every
    key once or twice. A retry finds what is left and does the same.
    """
    if number == 0 or number % every:
        return
    first = number - every
    parts = [k for k in range(first + 1, number) if exists(spark, f"{folder}/batch={k}")]
    if parts:
        spark.read.schema(schema).parquet(*[f"{folder}/batch={k}" for k in parts]).distinct().write.mode("append").parquet(f"{folder}/batch={first}")
    for k in parts:
        delete(spark, f"{folder}/batch={k}")


def start(rows: DataFrame, out: str, checkpoint: str, config: RunConfig = RunConfig(), compact: int = 32, files: int = 8, every_rows: int = 50_000, every_seconds: float = 30, **trigger) -> StreamingQuery:
    """Writes a ledger part for every micro-batch under ``out/parts``; rows: a stream with _ord.

    The hashes and fingerprints that later batches must know go to narrow index tables beside it, partitioned by batch and
    compacted as batches come. A batch that is run again after a failure overwrites its own parts and sees the
    same earlier ones, so results don't depend on retries. ``out/progress.json`` holds rows and reasons since the start, written anew
    whenever ``every_rows`` rows or ``every_seconds`` have passed.
    """
    spark = rows.sparkSession
    seen = {"rows": 0, "reasons": {}, "saved": 0, "at": time.time()}
    hashes, prints = f"{out}/exact_index", f"{out}/near_index"

    def one(batch: DataFrame, number: int) -> None:
        _compact(spark, hashes, number, compact, "canonical_hash string")
        _compact(spark, prints, number, compact, "fp long")
        earlier = _index(spark, hashes, "canonical_hash", number), _index(spark, prints, "fp", number)
        part = f"{out}/parts/batch={number}"
        # The ledger reads the batch once, for a table of its own.
        ledger(batch, config, None, *earlier).write.mode("overwrite").parquet(part)
        done = spark.read.parquet(part)
        counts = {str(r.drop_reason): r["count"] for r in done.groupBy("drop_reason").count().collect()}
        seen["rows"] += sum(counts.values())
        seen["reasons"] = merge_counts(seen["reasons"], counts)
        if checkpoint_due(seen["rows"], seen["saved"], time.time(), seen["at"], every_rows, every_seconds):
            save_json(spark, {"batch": number, "rows": seen["rows"], "reasons": seen["reasons"]}, f"{out}/progress.json")
            seen.update(saved=seen["rows"], at=time.time())
        if config.exact:
            _put(done.where(F.col("drop_reason").isNull() | F.col("drop_reason").isin(LOW_QUALITY, DUPLICATE_NEAR)).select("canonical_hash").distinct(), hashes, number, files)
        if config.near.enabled:
            _put(done.where(F.col("drop_reason").isNull() | (F.col("drop_reason") == LOW_QUALITY)).select("fp").distinct(), prints, number, files)

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def results(spark: SparkSession, out: str) -> DataFrame:
    """The ledger of all batches so far."""
    return spark.read.parquet(f"{out}/parts").drop("batch")
