"""Run state: counters and committed index tables of earlier runs, checked before a run goes on."""

from __future__ import annotations

import time
from dataclasses import asdict
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from millrace.operators.staging import exists
from millrace.plans.config import RunConfig
from millrace.sources.sinks import load_json, save_json

DEFAULTS: dict[str, Any] = {
    "processed_input_rows": 0, "kept_rows": 0, "dropped_rows": 0, "malformed_rows": 0, "next_shard_index": 0, "drop_reasons": {}, "dedup": {}, "quality": {}, "stage_seconds": {}, "indexes": {}, "runs": [], "done": False, "source": "",
}


def filled(state: dict[str, Any]) -> dict[str, Any]:
    """state with what is missing or null set to its default."""
    return DEFAULTS | {k: v for k, v in state.items() if v is not None}


def load_state(spark: SparkSession, path: str | Path) -> dict[str, Any]:
    found = load_json(spark, path)
    return filled(found) if found else {}


def save_state(spark: SparkSession, state: dict[str, Any], path: str | Path) -> None:
    save_json(spark, filled(state), path)


def index_path(folder: str | Path, name: str) -> str:
    return f"{str(folder).rstrip('/')}/{name}_index"


def index_settings(config: RunConfig) -> dict[str, Any]:
    """What a committed index was built with; another setting makes its entries meaningless."""
    near = asdict(config.near)
    return {"exact": {"enabled": config.exact}, "near": {k: near[k] for k in ("enabled", "simhash_bits", "band_bits", "hamming_threshold", "simhash")}, "canonical_fields": list(config.filtering.canonical_fields)}


def dedup_state(config: RunConfig, folder: str | Path, inserted: dict[str, int]) -> dict[str, Any]:
    on = {"exact": config.exact, "near": config.near.enabled}
    return {name: {"enabled": on[name], "path": index_path(folder, name), "inserted_total": inserted.get(name, 0)} for name in on}


def check_resume(spark: SparkSession, state: dict[str, Any], config: RunConfig, folder: str | Path) -> None:
    """RuntimeError where a run can't go on from the state: other settings, another place of an index, or one that is gone."""
    if not config.resume or not state:
        return
    old, now = state.get("indexes", {}), index_settings(config)
    for name, on in (("exact", config.exact), ("near", config.near.enabled)):
        if not on or not old:
            continue
        if old.get(name) != now[name] or old.get("canonical_fields") != now["canonical_fields"]:
            raise RuntimeError(f"{name} dedup was configured otherwise in the run to resume")
        path, saved = index_path(folder, name), state.get("dedup", {}).get(name, {}).get("path")
        if saved and saved != path:
            raise RuntimeError(f"the {name} index of the run to resume is at {saved}, not {path}")
        if state.get("kept_rows") and not exists(spark, path):
            raise RuntimeError(f"the {name} index of the run to resume is missing")


def merge_counts(a: dict[str, Any], b: dict[str, Any]) -> dict[str, Any]:
    return {k: a.get(k, 0) + b.get(k, 0) for k in {**a, **b}}


def checkpoint_due(rows: int, last_rows: int, at: float, last_at: float, every_rows: int = 50_000, every_seconds: float = 30) -> bool:
    """True once rows have advanced and either interval has passed."""
    return rows > last_rows and (rows - last_rows >= every_rows or at - last_at >= every_seconds)


def chunk_size(rows: int, workers: int, divisor: int = 4, least: int = 64) -> int:
    """Rows of a work unit: a share of each worker's part, not below least nor above all rows."""
    if rows <= 0:
        return 1
    return max(1, min(rows, max(least, rows // max(1, workers * divisor))))


def rows_per_second(rows: int, started: float, now: float | None = None) -> float:
    return rows / max(1e-9, (now if now is not None else time.time()) - started)
