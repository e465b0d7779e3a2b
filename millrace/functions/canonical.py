"""Canonical text and its hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import normalize_text, strip_space


def canonical_text(fields: Sequence[Column], collapse: bool = True) -> Column:
    """The non-empty normalised fields, joined by line feeds."""
    parts = [F.nullif(normalize_text(F.coalesce(f, F.lit("")), collapse), F.lit("")) for f in fields]
    return strip_space(F.concat_ws("\n", *parts)) if parts else F.lit("")


def canonical_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
