"""Benchmark decontamination by q-gram lemma filtering in diagonal bands and banded alignment.

Texts and benchmark items are normalised (lower case, everything but letters and digits is one space). An
item is cut into units of ``unit`` bytes and again of ``long`` bytes, half overlapping (shorter items are one unit): short
units find excerpts, any verbatim one of unit + unit // 2 - 1 bytes holds a whole unit, and long ones carry more edits at one
place. A place that matches a unit of length L with at most k edits shares at least L - q + 1 - k * q of its q-grams, all on diagonals
(document position minus unit position) within k of each other. So shared q-grams are counted in
overlapping bands 2k wide, bands that reach the bound are kept, and a banded alignment
verifies each: a document holds an item if some unit aligns within k edits.

The benchmark side is measured first. Up to ``block_bytes`` of text is sent to the executors at once. A larger
benchmark is worked through in blocks of that size, so no broadcast grows with it; a first scan sifts the documents by a
bitmap of fixed size of all blocks' q-grams, and blocks meet only those texts in which some stretch
holds enough of them. Documents are scanned in place, without a shuffle; long texts are hashed in overlapping segments.

Defined results: null and empty texts are clean; null and empty items match nothing; an item shorter than ``least`` normalised
bytes matches where it stands unchanged between word bounds, and with fewer than ``words`` words (or ``q`` bytes) only a document
that is that item and nothing else, as so few words are evidence of nothing inside a text; of several units of an item
that match, the one with most shared q-grams is reported (the first on ties); repeated rows and repeated items are judged alike; an empty
benchmark leaves all documents clean; extra columns are ignored by ``leaks`` and carried by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.textnum import PIECE, small, views


@dataclass(frozen=True)
class LeakRule:
    q: int = 10
    unit: int = 53
    long: int = 160
    rate: float = 0.075
    least: int = 50
    words: int = 3
    block_bytes: int = 4_000_000
    filter_bits: int = 27

    def budget(self, length: int) -> int:
        return max(1, int(self.rate * length))

    def bound(self, length: int, k: int) -> int:
        """Least q-grams that a place with k edits shares with a unit."""
        return max(1, length - self.q + 1 - k * self.q)


_NORM = np.full(256, 32, np.uint8)
_NORM[48:58] = np.arange(48, 58)
_NORM[97:123] = np.arange(97, 123)
_NORM[65:91] = np.arange(97, 123)
_NORM[128:] = np.arange(128, 256)
_NORM[0] = 0  # stands between documents
_TABLE_BITS = 22


def _kept(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes before white space collapses, and which of them stay."""
    v = _NORM[raw]
    latin = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)  # upper-case Latin-1 letters
    v[1:][latin] += 0x20
    space = v == 32
    keep = np.ones(len(v), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return v, keep


def normalise(text: bytes | memoryview) -> np.ndarray:
    v, keep = _kept(np.frombuffer(text, np.uint8))
    return v[keep]


def _grams(v: np.ndarray, q: int) -> np.ndarray:
    """32-bit hashes of all q-grams, built by doubling."""
    if len(v) < q:
        return np.empty(0, np.uint32)
    base, powers, runs, n = 2654435761, {1: 2654435761}, {1: (v.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)}, 1
    while n * 2 <= q:
        runs[2 * n] = runs[n][:-n] * np.uint32(powers[n]) + runs[n][n:]
        powers[2 * n] = pow(base, 2 * n, 1 << 32)
        n *= 2
    h, done = runs[n], n
    while done < q:
        t = 1 << ((q - done).bit_length() - 1)
        size = len(v) - (done + t) + 1
        h = h[:size] * np.uint32(powers[t]) + runs[t][done : done + size]
        done += t
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(12))


def units_of(text: str | None, rule: LeakRule) -> Iterator[tuple[np.ndarray, int | None]]:
    """The units of an item with their edit budgets; None stands for an item that must be a document's whole text."""
    v = normalise((text or "").encode())
    v = v[int(len(v) > 0 and v[0] == 32) : len(v) - int(len(v) > 1 and v[-1] == 32)]
    if not len(v):
        return
    if len(v) < rule.least:
        if int((v == 32).sum()) + 1 < rule.words or len(v) + 2 < rule.q:
            yield v, None
        else:
            yield np.concatenate(([32], v, [32])).astype(np.uint8), 0
        return
    spans = set()
    for size in (rule.unit, rule.long):
        starts = {*range(0, max(1, len(v) - size + 1), size // 2), max(0, len(v) - size)}
        spans |= {(s, min(len(v), s + size)) for s in starts}
    for s, e in sorted(spans):
        yield v[s:e], rule.budget(e - s)


class Index:
    """Units of the benchmark and their q-grams: sorted hashes with the places of each.

    An item of ``least`` bytes or more gives units that may have edits. A shorter one is a single unit between spaces that
    must be found unchanged, or, below ``words`` words, counts where a document is that item and nothing else.
    """

    def __init__(self, items: list[tuple[int, str]], rule: LeakRule):
        self.rule, self.items, self.units, budgets = rule, [], [], []
        self.whole: dict[bytes, list[int]] = {}
        for item, text in items:
            for unit, k in units_of(text, rule):
                if k is None:
                    self.whole.setdefault(unit.tobytes(), []).append(item)
                    continue
                self.items.append(item)
                self.units.append(unit)
                budgets.append(k)
        grams = [_grams(u, rule.q) for u in self.units]
        size = [len(g) for g in grams]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint32)
        unit = np.repeat(np.arange(len(size)), size)
        place = np.concatenate([np.arange(n) for n in size]) if size else np.empty(0, int)
        order = np.argsort(flat, kind="stable")
        self.hashes, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.unit, self.place = unit[order].astype(np.int32), place[order].astype(np.int32)
        self.k = np.array(budgets, np.int64)
        #: Width of a diagonal stripe; an exact unit has no edits but stripes all the same.
        self.stripe = np.maximum(self.k, 1)
        self.bound = np.array([rule.bound(len(u), k) for u, k in zip(self.units, budgets)], np.int64)
        self.least_hits = int(self.bound.min()) if size else 0
        self.shift = max((len(u) for u in self.units), default=0)
        #: No text of fewer bytes can hold a unit; a space at each end is no byte of the text.
        self.least_bytes = int(min((len(u) - k - 2 for u, k in zip(self.units, budgets)), default=0))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.hashes >> np.uint32(32 - _TABLE_BITS)] = True

    def search(self, texts: list[bytes | memoryview]) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text number, item, start, end, edits, shared) with offsets in normalised bytes, the best unit of each item found."""
        group, size = [], 0
        for i, t in enumerate(texts):
            if self.whole and len(t) <= 4 * self.rule.least:
                v = normalise(t)
                edge = int(len(v) > 0 and v[0] == 32)
                for item in self.whole.get(v.tobytes().strip(b" "), ()):
                    yield i, item, edge, len(v) - int(len(v) > 1 and v[-1] == 32), 0, 0
            if len(t) < self.least_bytes or not len(self.hashes):
                continue
            group.append(i)
            size += len(t)
            if size >= PIECE:
                yield from self._group(texts, group)
                group, size = [], 0
        if group:
            yield from self._group(texts, group)

    def _group(self, texts, group):
        # Every text stands between spaces, so that units between spaces are found at its ends, too.
        v, keep = _kept(np.frombuffer(b" " + b" \0 ".join(texts[i] for i in group) + b" ", np.uint8))
        # NUL bytes inside a text read as separators of q-grams only: bounds come from lengths.
        begins = np.cumsum([0] + [len(texts[i]) + 3 for i in group])
        kept_before = np.concatenate(([0], np.cumsum(keep)))
        starts, stops = kept_before[begins[:-1]], kept_before[np.minimum(begins[1:] - 1, len(v))]
        v = v[keep]
        q = self.rule.q
        where, which = [], []
        for s in range(0, len(v), PIECE):
            h = _grams(v[s : s + PIECE + q - 1], q)
            at = np.flatnonzero(self.table[h >> np.uint32(32 - _TABLE_BITS)])
            k = np.searchsorted(self.hashes, h[at])
            k[k == len(self.hashes)] = 0
            real = self.hashes[k] == h[at]
            where.append(at[real] + s)
            which.append(k[real])
        where, which = np.concatenate(where), np.concatenate(which)
        for n, i in enumerate(group):
            a, b = np.searchsorted(where, (starts[n], stops[n]))
            if b - a >= self.least_hits:
                own = v[starts[n] : stops[n]]
                added = int(not len(texts[i]) or _NORM[texts[i][0]] != 32)
                size = len(own) - added
                for item, start, end, edits, shared in self._text(own, where[a:b] - starts[n], which[a:b]):
                    # Back to the text's own normalised bytes, without spaces at the edges.
                    start, end = start + int(own[start] == 32), end - int(own[end - 1] == 32)
                    yield i, item, max(0, start - added), min(size, end - added), edits, shared

    def _text(self, v, where, which):
        times = self.first[which + 1] - self.first[which]
        flat = np.repeat(self.first[which] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        unit, shift = self.unit[flat].astype(np.int64), self.shift
        band = (np.repeat(where, times) - self.place[flat] + shift) // self.stripe[unit]
        keys, count = np.unique((unit << 40) | band, return_counts=True)
        # Bands 2k wide overlap by half: each is two neighbouring stripes.
        both = count.copy()
        next_ = np.flatnonzero(keys[1:] == keys[:-1] + 1)
        both[next_] += count[next_ + 1]
        good = both >= self.bound[keys >> 40]
        seen: set[int] = set()
        for c in np.flatnonzero(good)[np.argsort(-both[good], kind="stable")]:
            u, j = int(keys[c] >> 40), int(keys[c] & ((1 << 40) - 1))
            item, k, w = self.items[u], int(self.k[u]), int(self.stripe[u])
            if item in seen:
                continue
            start = max(0, j * w - shift - w)
            found = align(self.units[u], v[start : (j + 2) * w - shift + len(self.units[u]) + 2 * w], k)
            if found:
                seen.add(item)
                yield item, start + found[0], start + found[1], found[2], int(both[c])


def align(unit: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best place of unit in region with at most k edits, or None.

    The unit may start anywhere in the region; beyond that a row is one vector step, insertions by a running minimum.
    """
    exact = region.tobytes().find(unit.tobytes())
    if exact >= 0:
        return exact, exact + len(unit), 0
    n = len(region)
    at = np.arange(n + 1)
    row, begin = np.zeros(n + 1, np.int64), at.copy()
    for i, x in enumerate(unit):
        sub, gone = row[:-1] + (region != x), row[1:] + 1
        new = np.concatenate(([i + 1], np.minimum(sub, gone)))
        origin = np.concatenate(([0], np.where(sub <= gone, begin[:-1], begin[1:])))
        best = np.minimum.accumulate(new - at)
        source = np.maximum.accumulate(np.where(new - at == best, at, 0))
        row, begin = best + at, origin[source]
        if row.min() > k:
            return None
    end = int(row.argmin())
    return (int(begin[end]), end, int(row[end])) if row[end] <= k else None


def _original(text: bytes | memoryview, start: int, end: int) -> tuple[int, int]:
    """Offsets of normalised bytes as code points of the text."""
    raw = np.frombuffer(text, np.uint8)
    places = np.flatnonzero(_kept(raw)[1])
    first = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    a, b = int(places[start]), int(places[end - 1]) + 1
    return int(first[a]), int(first[b])


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    return benchmark.select(F.col(f"`{item}`").cast("long").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")


def _blocks(items: DataFrame, n: int) -> Iterator[list[tuple[int, str]]]:
    for k in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in block.orderBy("i", "t").toLocalIterator()]


def _n_blocks(items: DataFrame, rule: LeakRule) -> int:
    return int((items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // rule.block_bytes) + 1


class Sieve:
    """A bitmap of all q-grams of the benchmark, of fixed size, and what a text must hold of them to be searched at all."""

    def __init__(self, bits: np.ndarray, least_hits: int, least_bytes: int, window: int, whole: bool, rule: LeakRule):
        self.bits, self.least_hits, self.least_bytes, self.window, self.whole, self.rule = bits, least_hits, least_bytes, window, whole, rule

    @classmethod
    def of(cls, items: DataFrame, rule: LeakRule) -> Sieve:
        shift = np.uint32(32 - rule.filter_bits)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                grams, least, window, fewest, whole = [np.empty(0, np.uint32)], 1 << 30, 0, 1 << 30, 0
                for t in batch.column(1).to_pylist():
                    for unit, k in units_of(t, rule):
                        if k is None:
                            whole = 1
                            continue
                        grams.append(_grams(unit, rule.q))
                        least, window, fewest = min(least, rule.bound(len(unit), k)), max(window, len(unit) + 4 * max(k, 1)), min(fewest, len(unit) - k - 2)
                h = np.unique(np.concatenate(grams) >> shift)
                word, first = np.unique(h >> np.uint32(6), return_index=True)
                values = np.bitwise_or.reduceat(np.uint64(1) << (h & np.uint32(63)).astype(np.uint64), first) if len(h) else np.empty(0, np.uint64)
                word, values = np.append(word.astype(np.int64), [-1, -2, -3, -4]), np.append(values.view(np.int64), [-least, window, -fewest, whole])
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(values, pa.int64())], ["w", "v"])

        rows = items.mapInArrow(run, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v"), F.max("v").alias("m")).toArrow()
        w, v, m = (rows[c].to_numpy() for c in ("w", "v", "m"))
        bits = np.zeros(1 << (rule.filter_bits - 6), np.int64)
        bits[w[w >= 0]] = v[w >= 0]
        most = dict(zip(w[w < 0].tolist(), m[w < 0].tolist()))
        return cls(bits.view(np.uint64), -most.get(-1, 0), -most.get(-3, 0), most.get(-2, 0), bool(most.get(-4, 0)), rule)

    def may_hold(self, text: bytes | memoryview) -> bool:
        """False only for texts in which no stretch of a unit's length holds enough q-grams of the benchmark."""
        if self.whole and len(text) <= 4 * self.rule.least:
            return True
        if len(text) < self.least_bytes or not self.window:
            return False
        v = normalise(b" " + bytes(text) + b" ")
        at = []
        for s in range(0, len(v), PIECE):
            h = _grams(v[s : s + PIECE + self.rule.q - 1], self.rule.q) >> np.uint32(32 - self.rule.filter_bits)
            hit = (self.bits[h >> np.uint32(6)] >> (h & np.uint32(63)).astype(np.uint64)) & np.uint64(1)
            at.append(np.flatnonzero(hit) + s)
        at, n = np.concatenate(at), self.least_hits
        return len(at) >= n and bool((at[n - 1 :] - at[: len(at) - n + 1] <= self.window).any())


def _sifted(docs: DataFrame, sieve: Sieve, at: int, want: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield batch.filter(pa.array([sent.value.may_hold(t) == want for t in views(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def leaks(docs: DataFrame, benchmark: DataFrame, rule: LeakRule = LeakRule(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start, end (code points), edits, shared for each item that a document holds; clean documents have no row."""
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "doc_id long, item_id long, start long, end long, edits int, shared int"
    items = _items(benchmark, item, item_text)
    n = _n_blocks(items, rule)
    if n > 1:
        d = staged(_sifted(d, Sieve.of(items, rule), 1, True), "leaks-sifted")
    found = []
    for block in _blocks(items, n):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, rule)
            for batch in small(batches):
                texts, rows = views(batch.column(1)), []
                for i, it, a, b, edits, shared in index.search(texts):
                    rows.append((batch.column(0)[i].as_py(), it, *_original(texts[i], a, b), edits, shared))
                columns = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "start", "end", "edits", "shared"])

        part = d.mapInArrow(run, schema)
        found.append(part if n == 1 else staged(part, "leaks-block"))
    # Each block's rows are a small written table; the sum of all is one more.
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rule: LeakRule = LeakRule(), text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    at = docs.columns.index(text)
    items = _items(benchmark, item, item_text)
    n, rest = _n_blocks(items, rule), None
    if n > 1:
        sieve = Sieve.of(items, rule)
        rest, docs = _sifted(docs, sieve, at, False), staged(_sifted(docs, sieve, at, True), "leaks-sifted")
    for block in _blocks(items, n):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, rule)
            for batch in small(batches):
                bad = {found[0] for found in index.search(views(batch.column(at)))}
                yield batch if not bad else batch.filter(pa.array([i not in bad for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
        if n > 1:
            docs = staged(docs, "leaks-kept")
    return docs if rest is None else rest.unionByName(docs)
