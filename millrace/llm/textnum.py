"""Vectorised word hashing over UTF-8 bytes for Arrow batches.

Texts are joined into pieces of bounded size (a long text is cut at white space), so memory stays
bounded however long a text is. A word's 64-bit hash is the difference of two prefix sums of
byte values times powers of an odd base, brought to position 0 by the inverse power and mixed.

Defined results: a null text is empty, and an empty one has no words and no shingles; only A-Z are folded; a word's hash doesn't depend on its
place, its text or the piece it is read in; words of any length are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A finalising mixer on unsigned 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n odd pseudo-random constants."""
    return mix(np.arange(1, n + 1, dtype=U) * U(_BASE) + U(seed)) | U(1)


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: For words of letters and digits only.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LINE_END = np.zeros(256, bool)
LINE_END[[10, 13]] = True
#: Byte values with A-Z folded to lower case.
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_VALUE = constants(17, 256)[_FOLD]
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("size", 0) < n:
        size = max(PIECE + 4096, n)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            t = np.full(size, base, U)
            t[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.multiply.accumulate(t)
        _powers["size"] = size
    return _powers["up"], _powers["down"]


def views(column: pa.Array) -> list[bytes | memoryview]:
    """Each text's bytes without copies; null is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type):
        kind = np.int32
    else:
        return [x.encode() if x else b"" for x in column.to_pylist()]
    if not len(column):
        return []
    valid, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].tolist()
    if data is None:
        return [b""] * len(column)
    raw = memoryview(data)
    out = [raw[a:b] for a, b in zip(at, at[1:])]
    if column.null_count:
        out = [b"" if null else x for x, null in zip(out, column.is_null().to_pylist())]
    return out


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker's arrays stay small whatever size the engine's batches have."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _pieces(texts: list[bytes | memoryview]) -> Iterator[tuple[list[int], list[bytes | memoryview]]]:
    """Lists of (text number, bytes) of about PIECE bytes; no word is cut."""
    ids, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = at + PIECE
            if stop < len(text):  # on to the next white space
                while stop < len(text):
                    gaps = np.flatnonzero(SEPARATOR[np.frombuffer(text[stop : stop + 4096], np.uint8)])
                    if len(gaps):
                        stop += int(gaps[0])
                        break
                    stop += 4096
            part = text[at : min(stop, len(text))]
            ids.append(i)
            parts.append(part)
            size += len(part)
            at = stop
            if size >= PIECE:
                yield ids, parts
                ids, parts, size = [], [], 0
    if parts:
        yield ids, parts


def word_hashes(texts: list[bytes | memoryview], separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words (A-Z folded), one after another, and each text's number of words."""
    hashes, counts = stem_hashes(texts, separator, ())
    return hashes[:, 0], counts


def stem_hashes(texts: list[bytes | memoryview], separator: np.ndarray, stems: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """As word_hashes, with a column more for each length in stems: the hash of the word's first bytes, of its last where the
    length is negative, or of the word if it isn't longer."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    for ids, parts in _pieces(texts):
        raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        gap = separator[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[0::2], edge[1::2]
        starts = starts[: len(ends)]
        up, down = _power_tables(len(raw) + 1)
        sums = np.empty(len(raw) + 1, U)
        sums[0] = 0
        np.cumsum(_VALUE[raw] * up[: len(raw)], out=sums[1:])
        spans = [(starts, ends), *((starts, np.minimum(ends, starts + n)) if n > 0 else (np.maximum(starts, ends + n), ends) for n in stems)]
        columns = [mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U)) for a, b in spans]
        hashes.append(np.stack(columns, axis=1) if stems else columns[0][:, None])
        offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
        per = np.diff(np.searchsorted(starts, offsets))
        np.add.at(counts, ids, per)
    return (np.concatenate(hashes) if hashes else np.empty((0, 1 + len(stems)), U)), counts


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of ``width`` words; fewer words count as one run, no words as none."""
    n = len(words)
    if n == 0:
        return np.empty(0, U)
    c = constants(29, width)
    if n < width:
        with np.errstate(over="ignore"):
            return mix(np.array([(words * c[:n]).sum(dtype=U) + U(n)], U))
    total = words[: n - width + 1] * c[0]
    for k in range(1, width):
        total = total + words[k : n - width + 1 + k] * c[k]
    return np.unique(mix(total))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
