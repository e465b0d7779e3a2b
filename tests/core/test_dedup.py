import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.simhash import simhash_of
from millrace.operators import dedup
from millrace.plans.config import NearConfig


def greedy(items, threshold=3, bits=16, index=()):
    """Sequential keep-first with banded candidates; items: (order, fp)."""
    kept, out = [(None, f & (2**64 - 1)) for f in index], []
    mask = (1 << bits) - 1
    for o, f in sorted(items):
        f &= 2**64 - 1
        if any(bin(f ^ k).count("1") <= threshold and any((f >> s) & mask == (k >> s) & mask for s in range(0, 64, bits)) for _, k in kept):
            continue
        kept.append((o, f))
        out.append(o)
    return out


def run(spark, items, config=NearConfig(), index=None, parts=3):
    df = spark.createDataFrame(items, "_ord long, fp long").repartition(parts)
    gone = {r._ord for r in dedup.near_duplicates(df, config, index).collect()}
    return sorted(o for o, _ in items if o not in gone)


def family(seed, n):
    rng = random.Random(seed)
    bases = [rng.getrandbits(63) for _ in range(max(1, n // 8))]
    out = []
    for i in range(n):
        f = rng.choice(bases)
        for _ in range(rng.randint(0, 5)):
            f ^= 1 << rng.randrange(63)
        out.append((i, f))
    return out


def test_chain_keeps_both_ends(spark):
    assert run(spark, [(0, 0), (1, 0b111), (2, 0b111111)]) == [0, 2]


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 4), (3, 16)])
def test_equals_sequential(spark, seed, parts):
    items = family(seed, 160)
    assert run(spark, items, parts=parts) == greedy(items)


def test_lossy_bands_need_a_shared_band(spark):
    items = family(9, 120)
    assert run(spark, items, NearConfig(hamming_threshold=8)) == greedy(items, 8)
    with_bits = NearConfig(hamming_threshold=64, band_bits=1)
    a, b = simhash_of("deep learning improves reasoning"), simhash_of("deep learning improves reasoning!")
    assert run(spark, [(0, a), (1, b)], with_bits) == greedy([(0, a), (1, b)], 64, 1)


def test_index_of_earlier_runs(spark):
    items = family(5, 150)
    first = run(spark, items[:70])
    index = spark.createDataFrame([(f,) for o, f in items if o in first], "fp long")
    second = run(spark, items[70:], index=index)
    assert first + second == greedy(items)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=30), st.integers(1, 6))
def test_exact_keeps_first_under_any_partitioning(spark, keys, parts):
    df = spark.createDataFrame([(i, str(k)) for i, k in enumerate(keys)], "_ord long, canonical_hash string").repartition(parts)
    gone = {r._ord for r in dedup.exact_duplicates(df).collect()}
    assert [i for i in range(len(keys)) if i not in gone] == [i for i, k in enumerate(keys) if k not in keys[:i]]


def test_exact_index_and_bad_keys(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "b")], "_ord long, canonical_hash string")
    index = spark.createDataFrame([("a",)], "canonical_hash string")
    assert {r._ord for r in dedup.exact_duplicates(df, index).collect()} == {0, 2}
    with pytest.raises(PySparkException):
        dedup.checked_index(index.withColumn("canonical_hash", F.lit("not-hex"))).collect()


def test_long_chain_and_rounds(spark):
    """A path of 1,000 nodes in order keeps every other one; rounds and one walk decide alike."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(999)], "lo long, hi long").repartition(4)
    assert sorted(r.node for r in dedup.greedy_dropped(edges).collect()) == list(range(1, 1000, 2))
    short = edges.where("hi < 12")
    assert sorted(r.node for r in dedup.greedy_dropped(short, finish=1).collect()) == list(range(1, 12, 2))
    assert dedup.greedy_dropped(edges.where("false")).count() == 0


def test_long_keys_find_the_pairs_of_bands(spark):
    items = family(4, 200)
    df = spark.createDataFrame(items, "_ord long, fp long").dropDuplicates(["fp"])
    pairs = lambda c: sorted((r.lo, r.hi) for r in dedup.near_pairs(df, c).collect())
    for threshold in (1, 2, 3):
        assert pairs(NearConfig(hamming_threshold=threshold, many=0)) == pairs(NearConfig(hamming_threshold=threshold))
