"""Parquet shards of exact size, their manifest, run summary, dataset card and an upload adapter."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from pathlib import Path
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import staging as files
from millrace.operators.staging import staged
from millrace.plans.config import OutputConfig

#: Rows of one range of input order, for the two-step dense numbering.
RANGE = 1 << 16


def numbered(df: DataFrame, order: str = "_ord") -> DataFrame:
    """rn = 1, 2, ... in input order, without one task that sees all rows: rows are ranked inside ranges of the order, after sums of the ranges before."""
    block = F.floor(F.col(order) / RANGE)
    sizes = staged(df.groupBy(block.alias("__block")).agg(F.count(F.lit(1)).alias("__n")), "ranges")
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    rank = F.row_number().over(Window.partitionBy("__block").orderBy(order))
    return df.withColumn("__block", block).withColumn("rn", rank).join(before, "__block").withColumn("rn", F.col("rn") + F.col("__before")).drop("__block", "__before")


def shard_ids(df: DataFrame, shard_rows: int, start: int = 0, order: str = "_ord") -> DataFrame:
    if shard_rows <= 0:
        raise ValueError("shard_rows must be positive")
    return numbered(df, order).withColumn("shard_id", (F.floor((F.col("rn") - 1) / shard_rows) + start).cast("int"))


def shard_manifest(df: DataFrame, config: OutputConfig = OutputConfig(), start: int = 0, order: str = "_ord") -> DataFrame:
    """shard_id, name, num_rows of the shards that df fills."""
    counts = shard_ids(df.select(order), config.shard_rows, start, order).groupBy("shard_id").agg(F.count(F.lit(1)).alias("num_rows"))
    return counts.select("shard_id", F.concat(F.lit(f"{config.prefix}-"), F.lpad(F.col("shard_id").cast("string"), 5, "0"), F.lit(".parquet")).alias("name"), "num_rows")


def write_shards(df: DataFrame, folder: str | Path, config: OutputConfig = OutputConfig(), start: int = 0, columns: list[str] | None = None, order: str = "_ord") -> dict[str, Any]:
    """Writes full shards in input order into a folder of any file system that the engine knows, and returns their manifest.

    Shards are written side by side in a staging folder and renamed when all are complete, so a failed run
    leaves nothing behind that a later one meets. FileExistsError where a shard is there already, unless overwrite is set.
    """
    spark, folder = df.sparkSession, str(folder).rstrip("/")
    keep = columns or [c for c in df.columns if c != order]
    rows = shard_ids(df.select(order, *[c for c in keep if c != order]), config.shard_rows, start, order)
    stage = f"{folder}/.staging-{uuid.uuid4().hex}"
    try:
        (rows.repartition("shard_id").sortWithinPartitions("shard_id", "rn").select("shard_id", *keep)
         .write.option("compression", config.compression).partitionBy("shard_id").parquet(stage))
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select("shard_id", *keep).schema)
        counts = {r.shard_id: r.n for r in spark.read.schema(shape).parquet(stage).groupBy("shard_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        names = {i: f"{config.prefix}-{i:05d}.parquet" for i in sorted(counts)}
        there = files.sizes(spark, folder)
        if not config.overwrite and (met := [n for n in names.values() if n in there]):
            raise FileExistsError(f"{folder}/{met[0]} exists")
        shards = []
        for i, name in names.items():
            parts = files.sizes(spark, f"{stage}/shard_id={i}", ".parquet")
            if len(parts) != 1:
                raise RuntimeError(f"shard {i} came in {len(parts)} files")
            part, size = next(iter(parts.items()))
            files.move(spark, f"{stage}/shard_id={i}/{part}", f"{folder}/{name}", config.overwrite)
            shards.append({"name": name, "path": f"{folder}/{name}", "num_rows": counts[i], "size_bytes": size})
    finally:
        files.delete(spark, stage)
    return manifest(config.prefix, shards)


def manifest(prefix: str, shards: list[dict[str, Any]]) -> dict[str, Any]:
    return {"prefix": prefix, "num_shards": len(shards), "total_rows": sum(s["num_rows"] for s in shards), "shards": shards}


def merged_manifest(old: dict[str, Any] | None, new: dict[str, Any]) -> dict[str, Any]:
    return manifest(new["prefix"], [*(old or {}).get("shards", []), *new["shards"]])


def total_bytes(shards: list[dict[str, Any]]) -> int:
    """Bytes of the shards of a manifest; those without a size count as 0."""
    return sum(int(s.get("size_bytes") or 0) for s in shards)


def save_json(spark: SparkSession, value: dict[str, Any], path: str | Path) -> None:
    """Atomic: readers see the old file or the new one."""
    files.write_text(spark, str(path), json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True))


def load_json(spark: SparkSession, path: str | Path) -> dict[str, Any]:
    """{} where there is no file; broken JSON raises."""
    text = files.read_text(spark, str(path))
    return {} if text is None else json.loads(text)


def _flat(value: dict[str, Any], prefix: str = "") -> list[tuple[str, Any]]:
    out = []
    for k in sorted(value):
        v = value[k]
        out += _flat(v, f"{prefix}{k}.") if isinstance(v, dict) else [(f"{prefix}{k}", v)]
    return out


def dataset_card(title: str, source: str, schema: list[str], summary: dict[str, Any]) -> str:
    show = lambda v: ", ".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    lines = [f"# {title}", "", f"Source: {source}", "", "## Schema", "", *[f"- `{c}`" for c in schema], "", "## Run summary", ""]
    return "\n".join([*lines, *[f"- `{k}`: {show(v)}" for k, v in _flat(summary)], ""])


class HubClient(Protocol):
    def create_repo(self, repo_id: str, *, private: bool) -> Any: ...

    def upload_folder(self, repo_id: str, folder: str, path_in_repo: str) -> Any: ...


def upload(client: HubClient, repo_id: str | None, folder: str, path_in_repo: str = "data", private: bool = True, retries: int = 3, backoff: float = 5, sleep: Callable[[float], None] = time.sleep) -> None:
    """Creates the repository and uploads the folder, with a delay that grows by ``backoff`` at each retry."""
    if not repo_id or repo_id.strip().lower() == "none":
        raise ValueError("a repository id is needed for an upload")
    for attempt in range(1, retries + 1):
        try:
            client.create_repo(repo_id, private=private)
            client.upload_folder(repo_id, folder, path_in_repo)
            return
        except OSError:
            if attempt == retries:
                raise
            sleep(backoff * attempt)


class FolderClient:
    """HubClient over the public huggingface_hub library; ImportError where that isn't installed."""

    def __init__(self, token: str, revision: str = "main", message: str = "Upload dataset"):
        from huggingface_hub import HfApi

        self.api, self.revision, self.message = HfApi(token=token), revision, message

    def create_repo(self, repo_id: str, *, private: bool) -> Any:
        return self.api.create_repo(repo_id=repo_id, repo_type="dataset", private=private, exist_ok=True)

    def upload_folder(self, repo_id: str, folder: str, path_in_repo: str) -> Any:
        return self.api.upload_folder(repo_id=repo_id, repo_type="dataset", folder_path=folder, path_in_repo=path_in_repo, revision=self.revision, commit_message=self.message)


def publish(folder: str, repo_id: str | None, token_variable: str = "HF_TOKEN", dry_run: bool = False, client: HubClient | None = None, **options: Any) -> bool:
    """Uploads a finished run's folder. The token is asked for in a dry run, too, which does all but the upload; True if it was made."""
    token = (os.environ.get(token_variable) or "").strip()
    if not token:
        raise ValueError(f"the environment variable {token_variable} holds no token")
    if dry_run:
        return False
    upload(client or FolderClient(token), repo_id, folder, **options)
    return True
