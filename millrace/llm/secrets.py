"""Secret scans: keyed patterns plus sliding-window entropy, all as Column expressions.

Each text is one row's work: no shuffle, no Python. Offsets are code points, ends exclusive.

Defined results: a null or empty text has no spans; repeated rows are scanned one by one; an
empty table gives an empty result; extra columns of the input are ignored by ``scan`` and
carried by ``redact``. Memory per row is in proportion to its text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SPANS = "array<struct<start:int,end:int,ord:int>>"


@dataclass(frozen=True)
class EntropyRule:
    """Window length in characters, least candidate length, and least bits for each character class.

    A candidate is a maximal run of base64-like characters holding a digit and a letter. Its class
    is hex, mixed (both letter cases) or plain. ``allow`` suppresses known harmless candidates:
    UUIDs, marked examples and placeholders (where no other part between / and = is long enough to be a secret of its own), and slugs
    of words and short numbers.
    """

    window: int = 20
    least: int = 20
    hex_bits: float = 3.0
    mixed_bits: float = 3.8
    plain_bits: float = 3.6
    allow: str = r"(?i)^(?:[^/=]{0,19}[/=])*[^/=]*(?:example|sample|dummy|placeholder|changeme|xxxx)[^/=]*(?:[/=][^/=]{0,19})*$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^(?:[a-z]+|[0-9]{1,4})(?:[/_=+-]+(?:[a-z]+|[0-9]{1,4}))*$"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _walk(text: str, pattern: str, keep: str, span: str, group: int = 0) -> str:
    """SQL for the kept matches of a pattern: walks gaps and matches in turn, so that lengths give offsets.

    keep and span may use ``x.hit``, ``x.grp`` and ``at``, the offset of the match.
    """
    p = _sql(pattern)
    zipped = f"transform(arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group})), z -> named_struct('gap', z.`0`, 'hit', z.`1`, 'grp', z.`2`))"
    at = "(a.pos + length(x.gap))"
    width = "length(x.gap) + coalesce(length(x.hit), 0)"

    def walked(items: str, begin: str) -> str:
        return (
            f"aggregate({items}, named_struct('pos', {begin}, 'out', cast(array() as {SPANS})), (a, x) -> named_struct("
            f"'pos', a.pos + {width}, 'out', CASE WHEN x.hit IS NOT NULL AND ({keep}) THEN concat(a.out, {span.replace('@at', at)}) ELSE a.out END)).out"
        )

    total = f"aggregate(c, 0, (s, x) -> s + {width})"
    return f"CASE WHEN {text} RLIKE {p} THEN {_in_chunks(zipped, total, walked)} ELSE cast(array() as {SPANS}) END"


def _in_chunks(items: str, total: str, walk) -> str:
    """SQL for a walk over items in about sqrt(n) chunks, each from the sum of the totals before it: arrays that grow by copies stay
    short, so many hits in one text cost little more than in proportion. total: an expression of the chunk ``c``."""
    chunks = f"transform(array({items}), z -> transform(sequence(0, greatest(0, cast(ceil(size(z) / ceil(sqrt(size(z)))) as int) - 1)), k -> slice(z, k * cast(ceil(sqrt(size(z))) as int) + 1, greatest(1, cast(ceil(sqrt(size(z))) as int)))))[0]"
    begins = f"aggregate(y, named_struct('pos', 0, 'out', cast(array() as array<int>)), (b, c) -> named_struct('pos', b.pos + {total}, 'out', array_append(b.out, b.pos))).out"
    both = f"transform(array({chunks}), y -> named_struct('chunks', y, 'begins', {begins}))"
    return f"transform({both}, w -> flatten(transform(w.chunks, (c, i) -> {walk('c', 'w.begins[i]')})))[0]"


def _base(text: str, kind: int) -> str:
    pattern, keep, group = ((ASSIGN, "length(x.grp) >= 8", 2), (ACCESS, "true", 0), (HEX, "true", 0))[kind]
    return _walk(text, pattern, keep, f"array(named_struct('start', @at, 'end', @at + length(x.hit), 'ord', {kind}))", group)


def _entropy(text: str, rule: EntropyRule) -> str:
    """SQL for high-entropy spans: from the first to the last window at or above the class's bits."""
    w = rule.window
    run = "[A-Za-z0-9+/_=-]"
    table = "array(" + ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(w + 2)) + ")"
    bits = (
        f"CASE WHEN NOT x.hit RLIKE '[0-9]' OR NOT x.hit RLIKE '[A-Za-z]' OR x.hit RLIKE {_sql(rule.allow)} THEN NULL "
        f"WHEN x.hit RLIKE '^[0-9a-fA-F]+$' THEN {rule.hex_bits}D WHEN x.hit RLIKE '[a-z]' AND x.hit RLIKE '[A-Z]' THEN {rule.mixed_bits}D ELSE {rule.plain_bits}D END"
    )
    step = "IF(v.p = v.q, 0D, v.g[b.n[v.p] + 1] - v.g[b.n[v.p]] + IF(v.q = 0, 0D, v.g[b.n[v.q] - 1] - v.g[b.n[v.q]]))"
    high = f"v.i >= {w} AND {math.log2(w)!r}D - (b.s + {step}) / {w} >= v.bits"
    counted = (
        f"aggregate(transform(sequence(1, size(y.cs)), i -> named_struct('i', i, 'p', y.cs[i - 1], 'q', IF(i > {w}, y.cs[greatest(i - {w + 1}, 0)], 0), 'bits', y.bits, 'g', y.g)), "
        f"named_struct('n', array_repeat(0, {len(ALPHABET) + 1}), 's', 0D, 'lo', 0, 'hi', 0), (b, v) -> named_struct("
        f"'n', IF(v.p = v.q, b.n, transform(b.n, (c, k) -> c + IF(k = v.p, 1, 0) - IF(k = v.q AND v.q > 0, 1, 0))), "
        f"'s', b.s + {step}, 'lo', IF(b.lo = 0 AND {high}, v.i - {w - 1}, b.lo), 'hi', IF({high}, v.i, b.hi)))"
    )
    found = f"transform(array(named_struct('cs', transform(split(x.hit, ''), c -> instr('{ALPHABET}', c)), 'bits', {bits}, 'g', {table})), y -> {counted})"
    span = f"transform(filter({found}, f -> f.hi > 0), f -> named_struct('start', @at + f.lo - 1, 'end', @at + f.hi, 'ord', 3))"
    return _walk(text, f"(?<!{run}){run}{{{rule.least},}}", f"({bits}) IS NOT NULL", span)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rule: EntropyRule = EntropyRule()) -> DataFrame:
    """key, base spans (assign, access, hex) and all spans, each sorted by start and kind.

    An entropy span that lies inside a base span says nothing new and is left out; base spans always stay.
    """
    t = df.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    return t.select("id", *_found("t", rule)).select("id", "base", _all_spans("base", "extra").alias("spans"))


def _found(text: str, rule: EntropyRule) -> list[Column]:
    base = f"array_sort(concat({', '.join(_base(text, k) for k in range(3))}), (l, r) -> CASE WHEN l.start < r.start OR (l.start = r.start AND l.ord < r.ord) THEN -1 WHEN l.start = r.start AND l.ord = r.ord THEN 0 ELSE 1 END)"
    return [F.expr(base).alias("base"), F.expr(_entropy(text, rule)).alias("extra")]


def _all_spans(base: str, extra: str) -> Column:
    new = f"filter({extra}, e -> NOT exists({base}, b -> b.start <= e.start AND e.end <= b.end))"
    return F.expr(f"IF(size({extra}) = 0, {base}, array_sort(concat({base}, {new}), (l, r) -> CASE WHEN l.start < r.start OR (l.start = r.start AND l.ord < r.ord) THEN -1 WHEN l.start = r.start AND l.ord = r.ord THEN 0 ELSE 1 END))")


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat({names}[s.ord], ':', s.start, ':', s.end)), ',')")


def redact(df: DataFrame, text: str = "text", mark: str = "<SECRET>", rule: EntropyRule = EntropyRule()) -> DataFrame:
    """The input's own columns with every span replaced by a mark; overlapping spans share one. A null text stays null.

    Spans are found once per row, in a projection below the one that cuts the text.
    """
    spans, base, extra = "__millrace_spans", "__millrace_base", "__millrace_extra"
    source = f"`{text}`"
    found = df.withColumns(dict(zip((base, extra), _found(f"coalesce({source}, '')", rule), strict=True)))
    found = found.withColumn(spans, _all_spans(base, extra))
    # Chunks of spans first, so that no step copies or counts from the start of a long text: a chunk's piece of the text ends with its last span.
    size = f"cast(ceil(sqrt(size({spans}))) as int)"
    chunks = f"transform(sequence(0, cast(ceil(size({spans}) / {size}) as int) - 1), k -> slice({spans}, k * {size} + 1, {size}))"
    bounded = (
        f"aggregate({chunks}, named_struct('pos', 0, 'out', cast(array() as array<struct<spans:{SPANS},start:int,end:int>>)), (a, c) -> named_struct("
        f"'pos', greatest(a.pos, array_max(transform(c, s -> s.end))), "
        f"'out', array_append(a.out, named_struct('spans', c, 'start', a.pos, 'end', greatest(a.pos, array_max(transform(c, s -> s.end)))))))"
    )
    piece = "substring(g.t, a.pos - g.start + 1, s.start - a.pos)"
    marked = (
        f"aggregate(g.spans, named_struct('pos', g.start, 'out', ''), (a, s) -> named_struct('pos', greatest(a.pos, s.end), "
        f"'out', CASE WHEN s.start < a.pos THEN a.out ELSE concat(a.out, {piece}, {_sql(mark)}) END)).out"
    )
    pieces = f"transform(transform(b.out, c -> named_struct('t', substring({source}, c.start + 1, c.end - c.start), 'start', c.start, 'spans', c.spans)), g -> {marked})"
    cut = F.expr(f"transform(array({bounded}), b -> concat(array_join({pieces}, ''), substring({source}, b.pos + 1)))[0]")
    return found.withColumn(text, F.when(F.size(spans) > 0, cut).otherwise(F.col(source))).drop(spans, base, extra)
