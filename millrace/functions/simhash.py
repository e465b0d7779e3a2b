"""64-bit SimHash, Hamming distance and bands. Fingerprints are two's-complement longs."""

from __future__ import annotations

import hashlib
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # the interpreter's own MD5 begins a digest faster than OpenSSL's
    from _md5 import md5
except ImportError:
    from hashlib import md5

BITS = 64
DIGESTS = {"blake2b": partial(hashlib.blake2b, digest_size=8), "md5": partial(md5, usedforsecurity=False)}


#: Bounds of a worker's table of token hashes, about 6 MB: texts bring ever new tokens, and a larger table saves little time.
KNOWN_TOKENS, KNOWN_CHARS = 1 << 15, 32


class _Hashes(dict):
    """The first 64 bits of tokens' digests; starts anew when it is full, and long tokens aren't kept."""

    def __init__(self, digest: str):
        super().__init__()
        self.digest = DIGESTS[digest]

    def __missing__(self, token: str) -> bytes:
        found = self.digest(token.encode("utf-8", "surrogatepass")).digest()[:8]
        if len(token) <= KNOWN_CHARS:
            if len(self) >= KNOWN_TOKENS:
                self.clear()
            self[token] = found
        return found


_hashes = lru_cache(maxsize=None)(_Hashes)


def simhash_of(text: str | None, digest: str = "blake2b") -> int:
    """Every token votes with the first 64 bits of its digest; a tie sets the bit; no token gives 0."""
    tokens = (text or "").split()
    if not tokens:
        return 0
    known, votes = _hashes(digest), np.zeros(BITS, np.int64)
    for at in range(0, len(tokens), 8192):  # bounded memory for long texts
        raw = b"".join(map(known.__getitem__, tokens[at : at + 8192]))
        votes += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * votes >= len(tokens)).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def simhash(text: Column, digest: str = "blake2b") -> Column:
    """simhash_of as an Arrow UDF; digest: blake2b or md5. Texts become strings one at a time, never a whole batch of them."""

    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([simhash_of(t.as_py(), digest) for t in texts], pa.int64())

    return run(text)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def bands(fp: Column, band_bits: int = 16) -> Column:
    """array<struct<band,segment>>; band 0 holds the lowest bits."""
    mask = (1 << band_bits) - 1
    return F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(fp, band_bits * i).bitwiseAND(F.lit(mask).cast("long")).alias("segment")) for i in range(BITS // band_bits)])


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def band_masks(band_bits: int = 16) -> list[int]:
    return [_signed(((1 << band_bits) - 1) << at) for at in range(0, BITS, band_bits)]


def block_masks(threshold: int, blocks: int) -> list[int]:
    """Signed 64-bit masks, each of ``blocks - threshold`` of ``blocks`` parts of the bits: two fingerprints that differ in at most
    ``threshold`` bits are equal under one of them at least."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(part, blocks - threshold)]


def masked(fp: Column, masks: list[int]) -> Column:
    """array<struct<band,segment>> of the fingerprint under each mask."""
    return F.array(*[F.struct(F.lit(i).alias("band"), fp.bitwiseAND(F.lit(m).cast("long")).alias("segment")) for i, m in enumerate(masks)])
