"""Text cleaning as Column expressions. Python's Unicode classes are spelled out, as Java's defaults are ASCII."""

from __future__ import annotations

import importlib.util

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns whose results must match.
CONTROL = r"[\x00-\x08\x0B-\x1F\x7F]"
SPACE = r"[\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: White space that isn't one single space; the look-ahead passes over printable ASCII by one test.
MORE_SPACE = rf"(?![\x21-\x7E])(?:(?! ){SPACE}{SPACE}*| {SPACE}+)"
LINK = r"\[\[(?:[^|\]]+\|([^\]]+)|([^|\]]+))\]\]"
TEMPLATE = r"\{\{[^{}]*\}\}"
TABLE = r"\{\|[^{}]*\|\}"
TAG = r"<[^>]+>"
REFERENCE_MARK = r"\[[0-9]+\]"
WIKI_URL = "https://en.wikipedia.org/wiki/"


def _text(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_control(c: Column | str) -> Column:
    """Control characters other than tab and line feed become spaces."""
    return F.regexp_replace(_text(c), CONTROL, " ")


def strip_space(c: Column | str) -> Column:
    """Unicode white space goes from both ends."""
    return F.regexp_replace(_text(c), f"^{SPACE}+|{SPACE}+$", "")


def collapse_space(c: Column | str) -> Column:
    """Runs of Unicode white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(_text(c), MORE_SPACE, " "))


def normalize_text(c: Column | str, collapse: bool = True) -> Column:
    cleaned = strip_control(c)
    return collapse_space(cleaned) if collapse else strip_space(cleaned)


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), TAG, " ")


def strip_reference_marks(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), REFERENCE_MARK, " ")


def wiki_markup(c: Column | str) -> Column:
    """One pass each over links, emphasis, templates, tables and tags; only the innermost of nested templates goes."""
    out = F.regexp_replace(_text(c), LINK, "$1$2")
    for quotes in ("'''", "''"):
        out = F.replace(out, F.lit(quotes), F.lit(""))
    for pattern in (TEMPLATE, TABLE, TAG):
        out = F.regexp_replace(out, pattern, " ")
    return out


def wikitext_to_text(c: Column | str, collapse: bool = True) -> Column:
    return normalize_text(strip_tags(strip_reference_marks(wiki_markup(c))), collapse)


def parsed_wikitext(c: Column | str, collapse: bool = True, parser: str = "patterns", required: bool = False) -> Column:
    """wikitext_to_text with a choice of parser: "patterns", or "library" for the optional wikitext library, through an Arrow UDF.

    Without the library, "library" falls back to patterns, or raises ImportError where it is ``required``.
    """
    if parser not in ("patterns", "library"):
        raise ValueError(f"parser must be patterns or library, not {parser!r}")
    if parser == "patterns":
        if required:
            raise ValueError("a required parser must be the library")
        return wikitext_to_text(c, collapse)
    if importlib.util.find_spec("mwparserfromhell") is None:
        if required:
            raise ImportError("the wikitext library (mwparserfromhell) is required but not installed")
        return wikitext_to_text(c, collapse)

    @F.pandas_udf(T.StringType())
    def stripped(texts: pd.Series) -> pd.Series:
        import mwparserfromhell

        return texts.map(lambda t: None if t is None else str(mwparserfromhell.parse(t).strip_code(normalize=True, collapse=True)))

    return normalize_text(strip_tags(strip_reference_marks(stripped(_text(c)))), collapse)


def wiki_url(title: Column | str) -> Column:
    """The article's address: spaces as underscores, and : / ? & = % # left as they are."""
    out = F.url_encode(F.translate(_text(title), " ", "_"))
    for found, put in (("*", "%2A"), ("%7E", "~"), ("%3A", ":"), ("%2F", "/"), ("%3F", "?"), ("%26", "&"), ("%3D", "="), ("%23", "#"), ("%25", "%")):
        out = F.replace(out, F.lit(found), F.lit(put))
    return F.concat(F.lit(WIKI_URL), out)
