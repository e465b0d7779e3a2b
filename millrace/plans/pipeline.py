"""The corpus plan: clean rows in, a ledger out that says of every row whether it is kept or why it is dropped.

All stages are decided on narrow columns (_ord, hash, fingerprint); texts are joined back once, where they are kept.
"""

from __future__ import annotations

import time
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import dedup, quality, staging
from millrace.operators.filtering import DUPLICATE_EXACT, DUPLICATE_NEAR, LOW_QUALITY, MALFORMED, filter_rows
from millrace.operators.staging import staged
from millrace.plans import state as run_state
from millrace.plans.config import RunConfig, malformed_policy
from millrace.sources import sinks

STAGES = ("deterministic_filter", "exact_dedup", "near_dedup", "quality_scoring")


class Clock:
    """Wall seconds of the stages that are materialised; lazy plans run cleaning and filter as one."""

    def __init__(self):
        self.seconds, self.last = dict.fromkeys(STAGES, 0.0), time.perf_counter()

    def lap(self, stage: str) -> None:
        now = time.perf_counter()
        self.seconds[stage] += now - self.last
        self.last = now


def ledger(rows: DataFrame, config: RunConfig = RunConfig(), model: quality.QualityModel | None = None, exact_index: DataFrame | None = None, near_index: DataFrame | None = None, clock: Clock | None = None) -> DataFrame:
    """rows with normalised fields, canonical_text, canonical_hash, fp, quality_score and drop_reason.

    Order of decisions: filter, exact duplicates, near duplicates, quality. Documents enter the dedup stages before
    their quality is known, so a poor first copy still shadows later ones.
    """
    filtered = filter_rows(rows, config.filtering)
    # Fingerprints are taken in the scan, of rows that passed the filter: taking them after exact dedup would shuffle every text once more.
    base = staged(dedup.fingerprints(filtered, config.near) if config.near.enabled else filtered.withColumn("fp", F.lit(None).cast("long")), "filtered")
    clock = clock or Clock()
    clock.lap("deterministic_filter")
    alive = base.where("drop_reason IS NULL")
    decided = None
    if config.exact:
        gone = staged(dedup.exact_duplicates(alive, exact_index), "exact")
        decided = gone.withColumn("__why", F.lit(DUPLICATE_EXACT))
        alive = alive.join(gone, "_ord", "left_anti")
    clock.lap("exact_dedup")
    if config.near.enabled:
        gone = dedup.near_duplicates(alive.select("_ord", "fp"), config.near, near_index).withColumn("__why", F.lit(DUPLICATE_NEAR))
        decided = gone if decided is None else decided.unionByName(gone)
    out = base if decided is None else base.join(staged(decided, "decided"), "_ord", "left").withColumn("drop_reason", F.coalesce("drop_reason", "__why")).drop("__why")
    clock.lap("near_dedup")
    if quality.model_for(config.quality, model) is None:
        score = F.when(F.col("drop_reason").isNull(), F.lit(1.0))
        out = out.withColumn("quality_score", score)
    else:
        unscored = out.where("drop_reason IS NOT NULL").withColumn("quality_score", F.lit(None).cast("double"))
        out = quality.scored(out.where("drop_reason IS NULL"), config.quality, model).withColumn("quality_score", F.col("quality_score").cast("double")).unionByName(unscored)
    low = F.col("quality_score") < config.quality.min_score
    return out.withColumn("drop_reason", F.when(F.col("drop_reason").isNull() & low, LOW_QUALITY).otherwise(F.col("drop_reason")))


def _index(spark: SparkSession, folder: str, name: str, schema: str, runs: list[str]) -> DataFrame | None:
    paths = [p for r in runs if staging.exists(spark, p := f"{run_state.index_path(folder, name)}/{r}")]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def reset(spark: SparkSession, folder: str | Path) -> None:
    """Removes what earlier runs have left in an output folder: shards, index tables, manifest, summary, card and state."""
    for name in ("data", "exact_index", "near_index", "manifest.json", "summary.json", "README.md", "state.json"):
        staging.delete(spark, f"{str(folder).rstrip('/')}/{name}")


def run(rows: DataFrame, folder: str | Path, config: RunConfig = RunConfig(), columns: list[str] | None = None, model: quality.QualityModel | None = None, title: str = "corpus", source: str = "") -> dict[str, Any]:
    """One run over rows with a dense _ord from 0: goes on after committed input rows, commits shards, index tables, manifest, summary, card and state.

    Rows may come with a drop_reason of the source (malformed, cleaner_dropped), which is counted. The state names the runs whose index tables
    count, and is replaced last. What a run that failed has left is in tables and staging folders that no state names. Without
    ``resume`` the folder is reset first.
    """
    spark, folder, began, mark = rows.sparkSession, str(folder).rstrip("/"), time.time(), staging.mark()
    state_path, clock = f"{folder}/state.json", Clock()
    if malformed_policy(config.malformed_row_policy) == "raise" and "drop_reason" in rows.columns:
        failed = F.raise_error(F.concat(F.lit("malformed row at "), F.col("_ord").cast("string")))
        rows = rows.where(F.when(F.col("drop_reason").eqNullSafe(MALFORMED), failed.cast("boolean")).otherwise(F.lit(True)))
    if not config.resume:
        reset(spark, folder)
    old = run_state.load_state(spark, state_path)
    run_state.check_resume(spark, old, config, folder)
    old = run_state.filled(old)
    skip, runs = old["processed_input_rows"], list(old["runs"])
    name = f"run-{len(runs):05d}-{int(began)}"
    part = rows.where(F.col("_ord") >= skip)
    if config.max_rows is not None:
        part = part.where(F.col("_ord") < skip + config.max_rows)
    exact_index = _index(spark, folder, "exact", "canonical_hash string", runs)
    near_index = _index(spark, folder, "near", "fp long", runs)
    book = staged(ledger(part, config, model, exact_index, near_index, clock), "ledger")
    clock.lap("quality_scoring")
    reasons = {r.drop_reason: r.n for r in book.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept, new = reasons.pop(None, 0), sum(reasons.values())
    malformed = reasons.pop(MALFORMED, 0)
    stats = quality.ScoreStats.from_state(old["quality"]).merged(quality.ScoreStats.of(book))
    keep = columns or [c for c in rows.columns if c not in ("_ord", "drop_reason")]
    shards = sinks.write_shards(book.where("drop_reason IS NULL"), f"{folder}/data", config.output, old["next_shard_index"], keep)
    inserted = {k: v.get("inserted_total", 0) for k, v in old["dedup"].items()}
    # Every hash that passed the filter is known from now on, those of near duplicates too.
    tables = {"exact": (config.exact, "canonical_hash", [LOW_QUALITY, DUPLICATE_NEAR]), "near": (config.near.enabled, "fp", [LOW_QUALITY])}
    for index, (on, column, also) in tables.items():
        if on:
            path = f"{run_state.index_path(folder, index)}/{name}"
            book.where(F.col("drop_reason").isNull() | F.col("drop_reason").isin(also)).select(column).distinct().write.parquet(path)
            inserted[index] = inserted.get(index, 0) + spark.read.schema(f"{column} {'string' if index == 'exact' else 'long'}").parquet(path).count()
    total, seconds = run_state.merge_counts(old["drop_reasons"], reasons), run_state.merge_counts(old["stage_seconds"], clock.seconds)
    whole = sinks.merged_manifest(sinks.load_json(spark, f"{folder}/manifest.json"), shards)
    done = {
        "processed_input_rows": skip + kept + new, "kept_rows": old["kept_rows"] + kept, "dropped_rows": sum(total.values()), "malformed_rows": old["malformed_rows"] + malformed,
        "next_shard_index": old["next_shard_index"] + shards["num_shards"], "drop_reasons": total, "dedup": run_state.dedup_state(config, folder, inserted), "quality": stats.state(),
        "stage_seconds": seconds, "indexes": run_state.index_settings(config), "runs": [*runs, name], "done": True, "source": source,
    }
    summary = {
        "source_file": source, "run": name, "processed_rows_new": kept + new, "processed_rows_total": done["processed_input_rows"], "written_rows_new": shards["total_rows"], "written_rows_total": whole["total_rows"],
        "dropped_rows": done["dropped_rows"], "malformed_rows": done["malformed_rows"], "drop_reasons": total,
        "dedup": {k: v | {"dropped": total.get(f"{k}_duplicate", 0)} for k, v in done["dedup"].items()}, "quality": stats.summary(), "stage_seconds": seconds,
        "rows_per_second": run_state.rows_per_second(kept + new, began), "elapsed_seconds": time.time() - began,
        "num_shards_new": shards["num_shards"], "num_shards_total": whole["num_shards"], "total_output_bytes": sinks.total_bytes(whole["shards"]),
    }
    sinks.save_json(spark, whole, f"{folder}/manifest.json")
    sinks.save_json(spark, summary, f"{folder}/summary.json")
    staging.write_text(spark, f"{folder}/README.md", sinks.dataset_card(title, source, keep, summary))
    run_state.save_state(spark, done, state_path)
    staging.release(spark, mark)
    return summary
