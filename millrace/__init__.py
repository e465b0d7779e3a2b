"""A PySpark engine that prepares text corpora for language-model training."""

from __future__ import annotations

import importlib
from typing import Any

#: Public names and the modules that hold them; a module is imported when one of its names is first used.
_PLACES = {
    "millrace.session": ("build_session",),
    "millrace.runtime": ("configure_environment", "set_seed", "tagged_folder"),
    "millrace.plans.config": ("FilterConfig", "NearConfig", "OutputConfig", "QualityConfig", "RunConfig", "from_json", "merged"),
    "millrace.plans.pipeline": ("ledger", "reset", "run"),
    "millrace.plans.state": ("check_resume", "checkpoint_due", "chunk_size", "load_state", "merge_counts", "save_state"),
    "millrace.functions.canonical": ("canonical_hash", "canonical_text"),
    "millrace.functions.simhash": ("bands", "hamming", "simhash"),
    "millrace.functions.text": ("normalize_text", "wiki_url", "wikitext_to_text"),
    "millrace.operators.dedup": ("exact_duplicates", "exact_kept", "fingerprints", "near_duplicates", "near_pairs"),
    "millrace.operators.filtering": (
        "CLEANER_DROPPED", "DUPLICATE_EXACT", "DUPLICATE_NEAR", "EMPTY_BODY", "EMPTY_TITLE", "LOW_QUALITY", "MALFORMED", "PII_BLOCKED", "TOO_LONG", "TOO_SHORT", "filter_rows", "reason_counts",
    ),
    "millrace.operators.quality": ("HeuristicModel", "LinearModel", "ScoreStats", "calibrate", "score_stats", "scored"),
    "millrace.sources.download": ("download", "file_sha256", "verify"),
    "millrace.sources.readers": ("clean_tsv", "clean_wiki", "read_labelled", "read_pages", "read_tsv", "scan_pages", "skip_and_limit"),
    "millrace.sources.sinks": ("dataset_card", "manifest", "merged_manifest", "publish", "upload", "write_shards"),
    "millrace.streaming.incremental": ("results", "start"),
}
_OF = {name: module for module, names in _PLACES.items() for name in names}
__all__ = sorted(_OF)


def __getattr__(name: str) -> Any:
    if name not in _OF:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(importlib.import_module(_OF[name]), name)
