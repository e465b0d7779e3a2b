"""Mixing sources to target token weights by entropy balancing, as DataFrame operations.

Within each source the mix takes document i at rate r_i and must meet one token constraint,
sum(size_i * r_i) = target, with 0 <= r_i <= cap. Entropy balancing minimises the divergence of the
rates from 1; its dual is convex in one multiplier for each source and gives exponentially tilted rates,
r_i = min(cap, exp(lambda * size_i / scale)). Newton steps, kept inside a bracket, solve all sources'
duals at once over a histogram of sizes: a rate depends on source and size only, so the histogram is exact.

Rates become copies by systematic rounding: within a source, cells (size, hash bucket) in order of size
take their share of a running sum of fractional rates, and within a cell the documents with the
smallest hashes take the extra copy. The running sum keeps the mix within about one document of
its target. A last step then moves a few copies where that brings the source nearer its target.

Defined results: a null text has size 0; documents of size 0 take 0 words (and 0 copies); a null source
is the last source; repeated rows share one decision by doc_id hash order, so reruns agree;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, n_words, staged


@dataclass(frozen=True)
class MixRule:
    """weights repeat over the sources in code-point order; cap bounds both a document's rate and a source's target. buckets: for each
    ``rows`` documents."""

    weights: tuple[int, ...] = (5, 2, 1)
    cap: int = 3
    rounds: int = 60
    tolerance: float = 1e-9
    buckets: int = 64
    rows: int = 50_000_000
    repairs: int = 3


def source_targets(sources: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """src, source_size, target from (src, source_size), one row for each source.

    Giving a total out by weight, stopping at caps and resharing the excess ends at the water level L with
    sum(min(cap_i, L * w_i)) = total. Sorted by cap_i / w_i, the level follows from running sums.
    """
    weights = F.array(*[F.lit(float(w)) for w in rule.weights])
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    s = sources.withColumn("w", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(rule.weights) + 1).cast("int")))
    s = s.withColumn("most", F.col("source_size").cast("double") * rule.cap).withColumn("ratio", F.col("most") / F.col("w"))
    everything = Window.orderBy("ratio", F.col("src").asc_nulls_last())
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    rest = everything.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1))).cast("double")
    s = s.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # The level is the one of the first source that it doesn't fill to its cap.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(Window.partitionBy(F.lit(1)))["level"]
    return s.withColumn("found", level).select("src", "source_size", F.least(F.col("most"), F.coalesce(F.col("found"), F.lit(float("inf"))) * F.col("w")).alias("target"))


def _rate(rule: MixRule, size: str = "size") -> Column:
    """exp of the capped exponent, as exp(710) overflows; full sources sit at the cap."""
    e = F.least(F.col("lam") * F.col(size) / F.col("scale"), F.lit(50.0))
    return F.when(F.col("full"), F.lit(float(rule.cap))).otherwise(F.least(F.lit(float(rule.cap)), F.exp(e)))


def solve(histogram: DataFrame, targets: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """src, target, lam, scale, full for each source, by Newton steps on the dual.

    histogram: src, size, n. One row of state for each source is checkpointed after each step; each step
    joins it with the histogram and sums gradient and curvature by source.
    """
    size = F.col("size").cast("double")
    scale = histogram.groupBy("src").agg((F.sum(size * size * F.col("n")) / F.sum(size * F.col("n"))).alias("scale"), F.min("size").alias("least"))
    state = targets.alias("t").join(scale.alias("h"), F.col("t.src").eqNullSafe(F.col("h.src"))).select(
        "t.src", "t.source_size", "t.target", "h.scale", F.lit(0.0).alias("lam"), F.lit(-1e9).alias("lo"),
        # At this multiplier even the smallest document is at the cap.
        (F.log(F.lit(float(rule.cap))) * F.col("h.scale") / F.col("h.least") + 1.0).alias("hi"),
        (F.col("t.target") >= F.col("t.source_size") * rule.cap * (1 - 1e-12)).alias("full"), F.lit(False).alias("done"),
    )
    state = cut(state)
    for _ in range(rule.rounds):
        x, r = size, _rate(rule)
        sums = histogram.alias("h").join(state.alias("t"), F.col("t.src").eqNullSafe(F.col("h.src"))).groupBy("t.src").agg(
            F.sum(F.col("n") * x * r).alias("took"), F.sum(F.when(r < rule.cap, F.col("n") * x * x / F.col("scale") * r).otherwise(0.0)).alias("slope"),
        )
        j = state.alias("t").join(sums.alias("u"), F.col("t.src").eqNullSafe(F.col("u.src"))).select("t.*", "u.took", "u.slope")
        gap = F.col("took") - F.col("target")
        done = F.col("full") | (F.abs(gap) <= rule.tolerance * F.col("target") + 1e-9)
        j = j.withColumn("lo", F.when(gap < 0, F.greatest("lo", "lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(gap > 0, F.least("hi", "lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.greatest(F.lit(-4.0), F.least(F.lit(4.0), gap / F.col("slope")))
        half = F.when(F.col("lo") < -1e8, F.col("lam") * 2 - 1.0).otherwise((F.col("lo") + F.col("hi")) / 2)
        step = F.when((F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise(half)
        state = cut(j.select("src", "source_size", "target", "scale", F.when(done, F.col("lam")).otherwise(step).alias("lam"), "lo", "hi", "full", done.alias("done")))
        if state.where(~F.col("done")).isEmpty():
            break
    return state


def mix(docs: DataFrame, rule: MixRule = MixRule(), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, src, size, source_size, target, rate, copies for every document."""
    d = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("src"), n_words(F.col(f"`{text}`")).alias("size"))
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    d = staged(d.withColumn("h", order), "mix-sizes")
    # The documents of one size are ranked bucket by bucket, so buckets grow in number with the corpus.
    buckets = rule.buckets * max(1, -(-d.count() // rule.rows))
    d = d.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    cells = staged(d.groupBy("src", "size", "bucket").count().withColumnRenamed("count", "n"), "mix-cells")
    histogram = cells.where("size > 0").groupBy("src", "size").agg(F.sum("n").alias("n"))
    sources = cells.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = cut(source_targets(sources, rule))
    state = solve(histogram, targets, rule)

    # Whole copies, and each cell's share of the running sum of fractional rates.
    c = cells.alias("c").join(state.alias("t"), F.col("c.src").eqNullSafe(F.col("t.src")), "left").select("c.*", "t.target", "t.lam", "t.scale", "t.full")
    c = c.withColumn("rate", F.when(F.col("size") == 0, 0.0).otherwise(_rate(rule)))
    c = c.withColumn("whole", F.floor("rate").cast("int")).withColumn("part", (F.col("rate") - F.floor("rate")) * F.col("n"))
    # The running sum goes over a source's sizes first, and over the buckets of one size after that.
    c = staged(c, "mix-rates")
    earlier = F.sum("part").over(Window.partitionBy("src").orderBy("size").rowsBetween(Window.unboundedPreceding, -1))
    sizes = c.groupBy("src", "size").agg(F.sum("part").alias("part")).select(F.col("src").alias("s"), F.col("size").alias("z"), F.coalesce(earlier, F.lit(0.0)).alias("before"))
    inside = F.sum("part").over(Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    c = c.withColumn("inside", inside).join(sizes, F.col("src").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).withColumn("upto", F.col("before") + F.col("inside")).drop("s", "z", "before", "inside")
    # Sums of doubles in two orders may differ in the last digits; rounding them first keeps neighbouring cells' boundaries equal.
    edge = lambda x: F.floor(F.round(x, 6) + 0.5)
    extra = edge(F.col("upto")) - edge(F.col("upto") - F.col("part"))
    c = c.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("n"), extra)).cast("long")).drop("upto", "part", "lam", "scale", "full")
    c = _repair(staged(c, "mix-copies"), rule)

    rank = F.row_number().over(Window.partitionBy("src", "size", "bucket").orderBy("h", "doc_id"))
    ranked = d.withColumn("rank", rank).alias("d")
    plan = c.join(targets.select(F.col("src").alias("src2"), "source_size", F.col("target").alias("target2")), F.col("src").eqNullSafe(F.col("src2"))).alias("c")
    same = F.col("d.src").eqNullSafe(F.col("c.src")) & (F.col("d.size") == F.col("c.size")) & (F.col("d.bucket") == F.col("c.bucket"))
    copies = F.col("whole") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)
    return ranked.join(plan, same).select("d.doc_id", F.col("d.src").alias("src"), F.col("d.size").alias("size"), "source_size", F.col("target2").alias("target"), "rate", copies.cast("int").alias("copies"))


def _repair(c: DataFrame, rule: MixRule) -> DataFrame:
    """Up to ``repairs`` times, gives or takes one copy in the cell of each source whose size best fits what is missing."""
    for _ in range(rule.repairs):
        sums = c.groupBy("src").agg(F.max("target").alias("target"), F.sum(F.col("size") * (F.col("whole") * F.col("n") + F.col("extra"))).alias("took"))
        j = c.alias("c").join(sums.alias("s"), F.col("c.src").eqNullSafe(F.col("s.src"))).select("c.*", (F.col("s.target") - F.col("took")).alias("miss"))
        better = (F.abs(F.abs("miss") - F.col("size")) < F.abs("miss")) & (F.col("size") > 0)
        can = F.when(F.col("miss") > 0, (F.col("extra") < F.col("n")) & (F.col("whole") < rule.cap)).otherwise(F.col("extra") > 0)
        best = j.where(better & can).groupBy("src").agg(F.min_by(F.struct("size", "bucket", "miss"), F.struct(F.abs(F.abs("miss") - F.col("size")), "size", "bucket")).alias("b"))
        hit = F.col("c.src").eqNullSafe(F.col("b.src")) & (F.col("c.size") == F.col("b.b.size")) & (F.col("c.bucket") == F.col("b.b.bucket"))
        c = cut(c.alias("c").join(best.alias("b"), hit, "left").select(
            "c.src", "c.size", "c.bucket", "c.n", "c.target", "c.rate", "c.whole", (F.col("c.extra") + F.coalesce(F.signum("b.b.miss"), F.lit(0))).cast("long").alias("extra"),
        ))
    return c
