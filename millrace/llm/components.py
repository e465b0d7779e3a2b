"""Connected components by hooking and shortcutting; the state is a narrow written table.

Defined results: ids without an edge to another id have no row; a null id has none either; repeated edges and both directions count once; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, few_files


def components(edges: DataFrame) -> DataFrame:
    """id, comp (smallest id reachable) for every id in edges (a, b).

    Every id points to a smaller one of its component. In each round it takes the smallest of its own pointer's pointer and its neighbours', and hands
    what it has seen to the id it pointed to, so that whole trees move at once and the number of rounds is about the logarithm of the longest path,
    in whatever order its ids come. Minima of a hot hub or root are summed map-side. Pointers only fall, so rounds end.
    """
    e = cut(few_files(edges.where("a <> b").select("a", "b").distinct()))
    both = cut(few_files(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()))
    labels = cut(few_files(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("f"))))
    while True:
        up = labels.select(F.col("id").alias("f"), F.col("f").alias("g"))
        far = labels.join(up, "f").select("id", "f", "g")
        seen = both.join(far.select(F.col("id").alias("b"), "g"), "b").groupBy("a").agg(F.min("g").alias("m"))
        own = far.join(seen.withColumnRenamed("a", "id"), "id").select("id", "f", F.least("g", "m").alias("low"))
        moved = F.inline(F.array(F.struct(F.col("id").alias("id"), F.least("low", "f").alias("to"), F.col("f").alias("old")), F.struct(F.col("f").alias("id"), F.col("low").alias("to"), F.lit(None).cast("long").alias("old"))))
        after = cut(few_files(own.select(moved).groupBy("id").agg(F.min("to").alias("f"), F.max("old").alias("old"))))
        labels = after.select("id", "f")
        if after.where("f <> old").isEmpty():
            return labels.withColumnRenamed("f", "comp")
