"""Exact and near deduplication that keep the first row in input order (``_ord``).

Near dedup is greedy in input order, not by components: a dropped document shadows nothing. With the fingerprints of
one run collapsed to their earliest holder, the kept set is the lexicographically first maximal independent set
of the graph of close fingerprints; rounds find it without a sequential scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.simhash import band_masks, block_masks, hamming, masked, simhash
from millrace.operators.staging import new_path, staged
from millrace.plans.config import NearConfig


def first_of(df: DataFrame, key: str = "canonical_hash", order: str = "_ord") -> DataFrame:
    """(key, first order) of every key: partial sums first, so a hot key costs one row a task."""
    return df.groupBy(key).agg(F.min(order).alias("__first"))


def exact_kept(df: DataFrame, index: DataFrame | None = None, key: str = "canonical_hash", order: str = "_ord") -> DataFrame:
    """(key, order) of each key's first row, but for keys that the index knows: one shuffle of narrow partial minima."""
    first = first_of(df, key, order).withColumnRenamed("__first", order)
    return first if index is None else first.join(index.select(key).distinct(), key, "left_anti")


def exact_duplicates(df: DataFrame, index: DataFrame | None = None, key: str = "canonical_hash", order: str = "_ord") -> DataFrame:
    """order of the rows whose key occurs earlier, in df or in the index (one column, the key)."""
    narrow = df.select(key, order)
    dup = narrow.join(first_of(narrow, key, order), key).where(F.col(order) > F.col("__first")).select(order)
    if index is not None:
        known = narrow.join(index.select(key).distinct(), key, "left_semi").select(order)
        dup = dup.unionByName(known).distinct()
    return dup


def checked_index(index: DataFrame, key: str = "canonical_hash") -> DataFrame:
    """Fails on keys that aren't SHA-256 in hex."""
    valid = F.col(key).rlike("^[0-9a-f]{64}$")
    return index.select(F.when(F.coalesce(valid, F.lit(False)), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("not a SHA-256 key: "), F.coalesce(F.col(key), F.lit("null"))))).alias(key))


def fingerprints(df: DataFrame, config: NearConfig = NearConfig(), text: str = "canonical_text") -> DataFrame:
    """df with fp, the SimHash of text. Rows with a drop_reason cost nothing and have a null one."""
    if "drop_reason" not in df.columns:
        return df.withColumn("fp", simhash(F.col(text), config.simhash))
    live = F.col("drop_reason").isNull()
    return df.withColumn("fp", simhash(F.when(live, F.col(text)), config.simhash)).withColumn("fp", F.when(live, F.col("fp")))


def _masks(config: NearConfig, many: bool) -> list[int]:
    """Parts of the bits of which every pair within the threshold is equal in one.

    Plain bands have 2**band_bits values whatever the corpus holds, so their buckets grow with it. Where bands are lossless, ``many``
    fingerprints are keyed by choices of blocks instead: for a threshold of 3 these are 20 keys of about 32 bits.
    The pairs are the same; only the buckets are smaller.
    """
    if many and config.lossless and config.bucket_cap is None and 0 < config.hamming_threshold <= 3:
        return block_masks(config.hamming_threshold, 2 * config.hamming_threshold)
    return band_masks(config.band_bits)


def _keyed(df: DataFrame, config: NearConfig, masks: list[int]) -> DataFrame:
    out = df.select("*", F.inline(masked(F.col("fp"), masks)))
    if config.bucket_cap:
        rank = F.row_number().over(Window.partitionBy("band", "segment").orderBy("_ord"))
        out = out.withColumn("__rank", rank).where(F.col("__rank") <= config.bucket_cap).drop("__rank")
    return out


def near_pairs(fps: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """(lo, hi) orders of distinct fingerprints that share a band and lie within the threshold; fps: fp, _ord."""
    masks = _masks(config, fps.count() > config.many)
    b = staged(_keyed(fps, config, masks), "bands")
    l, r = b.alias("l"), b.alias("r")
    close = (F.col("l.band") == F.col("r.band")) & (F.col("l.segment") == F.col("r.segment")) & (F.col("l._ord") < F.col("r._ord"))
    # A pair that shares several keys comes from the lowest of them alone.
    differ = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    lowest = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(i)) for i, m in enumerate(masks)])
    joined = l.join(r, close & (hamming(F.col("l.fp"), F.col("r.fp")) <= config.hamming_threshold) & (lowest == F.col("l.band")))
    return joined.select(F.col("l._ord").alias("lo"), F.col("r._ord").alias("hi"))


def _greedy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """node of what keep-first drops, in one walk over the edges by their later end's order."""
    edges, gone = pd.concat([pd.DataFrame({"lo": [], "hi": []}, dtype="int64"), *batches]), set()
    for lo, hi in sorted(zip(edges["lo"].tolist(), edges["hi"].tolist()), key=lambda e: (e[1], e[0])):
        if lo not in gone:
            gone.add(hi)
    yield pd.DataFrame({"node": sorted(gone)}, dtype="int64")


def greedy_dropped(edges: DataFrame, finish: int = 500_000) -> DataFrame:
    """node of every document that greedy keep-first drops, from edges (lo, hi).

    In each round, documents without a living earlier neighbour are kept and drop their later neighbours;
    edges of decided documents leave. Every round decides the first document of each component, so rounds end;
    once at most ``finish`` edges live, one task walks these in order. So long chains of alternating decisions cost rounds
    only while there are more edges than one task takes.
    """
    spark = edges.sparkSession
    path = new_path(spark, "dropped")
    live = staged(edges, "edges")
    add = lambda nodes: nodes.write.mode("append").parquet(path)
    while (left := live.count()) > finish:
        waiting = live.select("hi").distinct()
        kept = live.select("lo").distinct().join(waiting, F.col("lo") == F.col("hi"), "left_anti")
        gone = staged(live.join(kept, "lo", "left_semi").select(F.col("hi").alias("node")).distinct(), "dropped")
        add(gone)
        decided = gone.select("node").unionByName(kept.select(F.col("lo").alias("node")))
        live = staged(live.join(decided.withColumnRenamed("node", "lo"), "lo", "left_anti").join(gone.withColumnRenamed("node", "hi"), "hi", "left_anti").select("lo", "hi"), "edges")
    if left:
        add(live.select("lo", "hi").repartition(1).mapInPandas(_greedy, "node long"))
    else:
        add(live.select(F.col("lo").alias("node")))
    return spark.read.schema("node long").parquet(path)


def near_duplicates(df: DataFrame, config: NearConfig = NearConfig(), index: DataFrame | None = None) -> DataFrame:
    """_ord of the rows that near dedup drops; df: _ord, fp, in which exact duplicates are gone. index: fp of kept documents of earlier runs."""
    rows = df.select("_ord", "fp")
    first = rows.groupBy("fp").agg(F.min("_ord").alias("_ord"))
    shadowed = None
    if index is not None:
        known = index.select("fp").distinct().withColumn("_ord", F.lit(0).cast("long"))
        masks = _masks(config, known.count() > config.many)
        old, new = _keyed(known, config, masks), _keyed(first, config, masks)
        close = (F.col("n.band") == F.col("o.band")) & (F.col("n.segment") == F.col("o.segment")) & (hamming(F.col("n.fp"), F.col("o.fp")) <= config.hamming_threshold)
        shadowed = staged(new.alias("n").join(old.alias("o"), close, "left_semi").select("n.fp").distinct(), "shadowed")
        first = first.join(shadowed, "fp", "left_anti")
    first = staged(first.select("fp", "_ord"), "first")
    gone = greedy_dropped(near_pairs(first, config))
    kept = first.join(gone, first["_ord"] == gone["node"], "left_anti").select("fp", F.col("_ord").alias("__kept"))
    return rows.join(kept, "fp", "left").where(F.col("__kept").isNull() | (F.col("_ord") > F.col("__kept"))).select("_ord")
