"""Run configuration as frozen dataclasses, from nested dictionaries or JSON files."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class FilterConfig:
    enabled: bool = True
    body_field: str = "body"
    title_field: str = "title"
    url_field: str = "url"
    canonical_fields: tuple[str, ...] = ("body",)
    require_non_empty_title: bool = False
    min_body_chars: int = 20
    max_body_chars: int | None = None
    enable_pii_redaction: bool = False
    pii_block_on_match: bool = False
    boilerplate_patterns: tuple[str, ...] = ()
    normalize_whitespace: bool = True


@dataclass(frozen=True)
class NearConfig:
    """simhash: "blake2b" or "md5". bucket_cap: None compares whole buckets; a number keeps each bucket's first members only and may lose pairs.
    many: above so many fingerprints longer keys than bands find the same pairs."""

    enabled: bool = True
    simhash_bits: int = 64
    band_bits: int = 16
    hamming_threshold: int = 3
    simhash: str = "blake2b"
    bucket_cap: int | None = None
    many: int = 1 << 20

    def __post_init__(self):
        if self.simhash_bits != 64:
            raise ValueError("simhash_bits must be 64")
        if self.band_bits <= 0 or 64 % self.band_bits:
            raise ValueError("band_bits must be positive and divide 64")
        if self.simhash not in ("blake2b", "md5"):
            raise ValueError("simhash must be blake2b or md5")

    @property
    def lossless(self) -> bool:
        """Every pair within the threshold shares a band."""
        return self.hamming_threshold < 64 // self.band_bits


@dataclass(frozen=True)
class QualityConfig:
    enabled: bool = False
    min_score: float = 0.5
    model_path: str | None = None
    positive_label: str = "__label__high_quality"


@dataclass(frozen=True)
class OutputConfig:
    shard_rows: int = 200_000
    compression: str = "zstd"
    prefix: str = "part"
    overwrite: bool = False


@dataclass(frozen=True)
class RunConfig:
    filtering: FilterConfig = field(default_factory=FilterConfig)
    exact: bool = True
    near: NearConfig = field(default_factory=NearConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    output: OutputConfig = field(default_factory=OutputConfig)
    resume: bool = True
    max_rows: int | None = None
    malformed_row_policy: str = "skip"


#: Presets of the two corpora.
WIKI = RunConfig(filtering=FilterConfig(canonical_fields=("title", "body"), require_non_empty_title=True, min_body_chars=100, enable_pii_redaction=True, boilerplate_patterns=(r"\[\s*edit\s*\]",)), output=OutputConfig(prefix="wikipedia-en"))
TSV = RunConfig(filtering=FilterConfig(canonical_fields=("body",), min_body_chars=20, enable_pii_redaction=True), output=OutputConfig(prefix="msmarco-docs"))


def merged(config: Any, changes: dict[str, Any]) -> Any:
    """config with nested changes; unknown names raise ValueError."""
    known = {f.name: f for f in dataclasses.fields(config)}
    if unknown := set(changes) - set(known):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    put = {}
    for name, value in changes.items():
        old = getattr(config, name)
        put[name] = merged(old, value) if dataclasses.is_dataclass(old) and isinstance(value, dict) else tuple(value) if isinstance(value, list) else value
    return dataclasses.replace(config, **put)


def from_json(path: str, base: RunConfig | None = None) -> RunConfig:
    with open(path, encoding="utf-8") as f:
        return merged(base or RunConfig(), json.load(f))


def malformed_policy(value: str) -> str:
    policy = value.strip().lower()
    if policy not in ("skip", "raise"):
        raise ValueError(f"malformed_row_policy must be skip or raise, not {value!r}")
    return policy
