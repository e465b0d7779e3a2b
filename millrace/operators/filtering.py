"""The deterministic filter: normalisation, boilerplate, personal data and length checks, with one reason for each dropped row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import pii
from millrace.functions.canonical import canonical_hash, canonical_text
from millrace.functions.text import normalize_text
from millrace.plans.config import FilterConfig

# The names of the reasons.
EMPTY_TITLE, EMPTY_BODY, PII_BLOCKED, TOO_SHORT, TOO_LONG = "empty_title", "empty_body", "pii_blocked", "too_short", "too_long"
CLEANER_DROPPED, DUPLICATE_EXACT, DUPLICATE_NEAR, LOW_QUALITY, MALFORMED = "cleaner_dropped", "exact_duplicate", "near_duplicate", "low_quality", "malformed"


def filter_rows(df: DataFrame, config: FilterConfig = FilterConfig(), keep: tuple[str, ...] = ("_ord",)) -> DataFrame:
    """All rows, with normalised and redacted fields, canonical_text, canonical_hash and drop_reason (null: kept so far).

    Columns in ``keep`` pass unchanged; all others are text. Each step is a projection of its own, so a
    redacted column is computed once and read by the length checks and the canonical text. The fields and the reason go
    through a generator of one row: a later filter on the reason stays above it, where the optimiser would otherwise
    put every expression behind the reason into the filter again.
    """
    prior = []
    if "drop_reason" in df.columns:  # rows that are decided already keep their reason
        df, keep, prior = df.withColumnRenamed("drop_reason", "__prior"), (*keep, "__prior"), [F.col("__prior")]
    if not config.enabled:
        return _canonical(df.withColumn("drop_reason", prior[0] if prior else F.lit(None).cast("string")).drop("__prior"), config)
    title, body, url = config.title_field, config.body_field, config.url_field
    has_url = url in df.columns
    norm = lambda c: normalize_text(F.coalesce(c.cast("string"), F.lit("")), config.normalize_whitespace)
    out = df.select(*[F.col(c) if c in keep else norm(F.col(c)).alias(c) for c in df.columns])
    for missing in (title, body):
        if missing not in out.columns:
            out = out.withColumn(missing, F.lit(""))
    patterns = [p for p in config.boilerplate_patterns if p]
    if patterns:
        cleaned: Column = F.col(body)
        for p in patterns:
            cleaned = F.regexp_replace(cleaned, p, " ")
        out = out.withColumn(body, normalize_text(cleaned, config.normalize_whitespace))
    found = F.lit(False)
    if config.enable_pii_redaction:
        fields = [title, body, *([url] if has_url else [])]
        found = F.col("__found")
        any_pii = pii.contains(F.col(title)) | pii.contains(F.col(body)) | (pii.contains(F.col(url)) if has_url else F.lit(False))
        out = out.withColumn("__found", any_pii)
        # A row without any match is what redaction would make of it.
        out = out.withColumns({"__before": F.struct(title, body), **{f: F.when(found, pii.redact(F.col(f))).otherwise(F.col(f)) for f in fields}})
        seen_title, seen_body = F.col("__before")[title], F.col("__before")[body]
    else:
        seen_title, seen_body = F.col(title), F.col(body)
    reasons = prior
    if config.require_non_empty_title:
        reasons.append(F.when(seen_title == "", EMPTY_TITLE))
    reasons.append(F.when(seen_body == "", EMPTY_BODY))
    if config.enable_pii_redaction and config.pii_block_on_match:
        reasons.append(F.when(found, PII_BLOCKED))
    reasons.append(F.when(F.length(body) < config.min_body_chars, TOO_SHORT))
    if config.max_body_chars is not None:
        reasons.append(F.when(F.length(body) > config.max_body_chars, TOO_LONG))
    out = out.withColumn("drop_reason", F.coalesce(*reasons)).drop("__found", "__before", "__prior")
    return _canonical(settled(out, keep), config)


def settled(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """df with all columns but those in ``keep`` computed at this place: no later predicate is pushed through."""
    made = [c for c in df.columns if c not in keep]
    out = df.select(*[c for c in df.columns if c in keep], F.inline(F.array(F.struct(*made))))
    return out.select(*df.columns)


def _canonical(df: DataFrame, config: FilterConfig) -> DataFrame:
    fields = [F.col(f) if f in df.columns else F.lit("") for f in config.canonical_fields]
    out = df.withColumn("canonical_text", canonical_text(fields, config.normalize_whitespace))
    return out.withColumn("canonical_hash", canonical_hash(F.col("canonical_text")))


def reason_counts(ledger: DataFrame) -> DataFrame:
    """drop_reason (kept: null) and rows."""
    return ledger.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("rows"))


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("drop_reason").agg(F.sum("rows").alias("rows"))
