"""Detection and redaction of personal data, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and placeholders whose results must match, with Unicode digits, spaces and word edges spelled out.
_D = r"\p{Nd}"
_S = r"[\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}.\-]"
_B = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"
EMAIL = rf"{_B}[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}{_B}"
PHONE = rf"{_B}(?:\+?{_D}{{1,3}}{_S}?)?(?:\(?{_D}{{2,4}}\)?{_S}?)?{_D}{{3,4}}{_S}?{_D}{{4}}{_B}"
IPV4 = rf"{_B}(?:{_D}{{1,3}}\.){{3}}{_D}{{1,3}}{_B}"
KINDS = ((EMAIL, "<EMAIL_ADDRESS>"), (PHONE, "<PHONE_NUMBER>"), (IPV4, "<IP_ADDRESS>"))

# What a match begins with, tried before the costly word edge, and what a text must hold for any match at all.
_STARTS = (r"(?=[a-zA-Z0-9._%+\-])", rf"(?=[+(]|{_D})", rf"(?={_D})")
_NEEDS = ("@", rf"{_D}{{3}}", rf"{_D}\.{_D}")


def _kinds() -> list[tuple[str, str, str]]:
    return [(need, start + pattern, mark) for need, start, (pattern, mark) in zip(_NEEDS, _STARTS, KINDS, strict=True)]


def redact(c: Column) -> Column:
    """E-mail addresses, then phone numbers, then IPv4 addresses become placeholders."""

    def one(out: Column, kind: tuple[str, str, str]) -> Column:
        need, pattern, mark = kind
        # The text so far is named once, so that the three steps don't repeat each other.
        return F.transform(F.array(out), lambda x: F.when(x.rlike(need), F.regexp_replace(x, pattern, mark)).otherwise(x))[0]

    return reduce(one, _kinds(), c)


def contains(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.rlike(need) & c.rlike(pattern) for need, pattern, _ in _kinds()])


def counts(c: Column) -> dict[str, Column]:
    """How often each kind is redacted, as placeholders that redaction adds."""
    done = redact(c)
    return {mark: F.regexp_count(done, F.lit(mark)) - F.regexp_count(c, F.lit(mark)) for _, mark in KINDS}
