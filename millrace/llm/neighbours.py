"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, results merged.

Equal vectors are one point of the graph, which keeps its ``top`` + 1 smallest ids: no query can want more of
them, and a frequent vector can't crowd the graph. Points are dealt to shards of about ``shard_points`` by a hash of
the vector, so shards grow in number and not in size. Each shard's graph is built in one task, level by
level, into flat neighbour arrays (a fixed number of slots a point) and staged as one row. Query blocks of
bounded size then meet every shard once, search its graph from the top level down, and each query's
best of all shards are merged. Distances of results are computed anew in double precision.

Defined results: rows with a null id, and vectors that are null, empty, all zero or hold null or non-finite
components take no part, neither as queries nor as candidates; an id that occurs again counts once, with its smallest
vector; vectors of other lengths than the query's are no candidates; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import new_path, staged


@dataclass(frozen=True)
class GraphRule:
    """slots: neighbours of a point on a level (twice as many on the lowest); build and search: sizes of the candidate lists."""

    top: int = 10
    shard_points: int = 4096
    slots: int = 16
    build: int = 64
    search: int = 96
    block_bytes: int = 16 << 20


class Graph:
    """Flat arrays: vectors, and for each level a (points x slots) array of neighbours, -1 where a slot is free."""

    def __init__(self, x: np.ndarray, rule: GraphRule, levels: np.ndarray, links: list[np.ndarray], entry: int):
        self.x, self.rule, self.levels, self.links, self.entry = x, rule, levels, links, entry
        self.seen = np.zeros(len(x), np.int64)
        self.turn = 0

    @classmethod
    def built(cls, x: np.ndarray, keys: np.ndarray, rule: GraphRule) -> Graph:
        """keys: a hash of each point; it decides the point's level and the order of insertion, so builds agree."""
        n = len(x)
        u = ((keys.astype(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        levels = np.minimum((-np.log(u) / math.log(rule.slots)).astype(int), 12)
        top = int(levels.max()) if n else 0
        links = [np.full((n, rule.slots * (2 if k == 0 else 1)), -1, np.int32) for k in range(top + 1)]
        order = np.argsort(keys, kind="stable")
        g = cls(x, rule, levels, links, int(order[0]) if n else -1)
        far = [np.zeros(a.shape) for a in links]
        used = [np.zeros(n, np.int32) for _ in links]
        for p in order[1:].tolist():
            g._insert(p, far, used)
        return g

    def _near(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        d = self.x[ids] - q
        return np.einsum("ij,ij->i", d, d)

    def _search(self, q: np.ndarray, start: list[tuple[float, int]], size: int, links: np.ndarray) -> list[tuple[float, int]]:
        """The ``size`` nearest points found from start, nearest first, as (squared distance, point)."""
        self.turn += 1
        turn, seen = self.turn, self.seen
        heap = list(start)
        heapq.heapify(heap)
        best = [(-d, -p) for d, p in start]
        heapq.heapify(best)
        for _, p in start:
            seen[p] = turn
        while heap:
            d, p = heapq.heappop(heap)
            if len(best) >= size and d > -best[0][0]:
                break
            ids = links[p]
            ids = ids[(ids >= 0) & (seen[ids] != turn)]
            if not len(ids):
                continue
            seen[ids] = turn
            near = self._near(q, ids)
            if len(best) >= size:
                close = near < -best[0][0]
                ids, near = ids[close], near[close]
            for d2, p2 in zip(near.tolist(), ids.tolist()):
                if len(best) < size:
                    heapq.heappush(best, (-d2, -p2))
                elif d2 < -best[0][0]:
                    heapq.heapreplace(best, (-d2, -p2))
                else:
                    continue
                heapq.heappush(heap, (d2, p2))
        return sorted((-d, -p) for d, p in best)

    def _chosen(self, found: list[tuple[float, int]], most: int) -> list[tuple[float, int]]:
        """Diverse neighbours: a candidate nearer to a chosen one than to the point waits; free slots go to those that wait, nearest first."""
        if len(found) <= most:
            return found
        ids = np.array([p for _, p in found])
        v = self.x[ids]
        square = np.einsum("ij,ij->i", v, v)
        apart = square[:, None] + square[None] - 2 * (v @ v.T)
        least = np.full(len(ids), np.inf)
        taken, waiting = [], []
        for i, (d, _) in enumerate(found):
            if d <= least[i]:
                taken.append(i)
                if len(taken) == most:
                    break
                np.minimum(least, apart[i], out=least)
            else:
                waiting.append(i)
        return [found[i] for i in taken + waiting[: most - len(taken)]]

    def _insert(self, p: int, far: list[np.ndarray], used: list[np.ndarray]) -> None:
        q, level = self.x[p], int(self.levels[p])
        high = int(self.levels[self.entry])
        start = [(float(self._near(q, np.array([self.entry]))[0]), self.entry)]
        for k in range(high, level, -1):
            start = self._search(q, start, 1, self.links[k])
        for k in range(min(level, high), -1, -1):
            found = self._search(q, start, self.rule.build, self.links[k])
            links, apart, count = self.links[k], far[k], used[k]
            chosen = self._chosen(found, self.rule.slots)
            for j, (d, o) in enumerate(chosen):
                links[p, j], apart[p, j] = o, d
            count[p] = len(chosen)
            for d, o in chosen:
                n = int(count[o])
                if n < links.shape[1]:
                    links[o, n], apart[o, n] = p, d
                    count[o] = n + 1
                else:  # a full point chooses anew among its neighbours and this one
                    own = sorted([*zip(apart[o].tolist(), links[o].tolist()), (d, p)])
                    kept = self._chosen(own, links.shape[1] - 4)
                    links[o] = -1
                    for j, (e, r) in enumerate(kept):
                        links[o, j], apart[o, j] = r, e
                    count[o] = len(kept)
            start = found
        if level > high:
            self.entry = p

    def nearest(self, q: np.ndarray, size: int) -> list[int]:
        if self.entry < 0:
            return []
        start = [(float(self._near(q, np.array([self.entry]))[0]), self.entry)]
        for k in range(int(self.levels[self.entry]), 0, -1):
            start = self._search(q, start, 1, self.links[k])
        return [p for _, p in self._search(q, start, size, self.links[0])]


def points(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and v of every row that takes part; v has floats where the column has, else doubles."""
    kind = "array<float>" if embeddings.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    e = embeddings.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(kind).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    e = e.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad & F.exists("v", lambda x: x != 0))
    # Adding 0 makes one of the two zeros, so that equal vectors are equal values.
    return e.groupBy("id").agg(F.min(F.transform("v", lambda x: x + F.lit(0.0).cast(kind[6:-1]))).alias("v"))


_NONE = np.iinfo(np.int64).min


def build(pts: DataFrame, rule: GraphRule = GraphRule()) -> tuple[DataFrame, int]:
    """The staged index, one row a shard, and the number of shards."""
    by_vector = Window.partitionBy("v").orderBy("id")
    few = pts.withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= rule.top + 1)
    distinct = staged(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("h", F.xxhash64("v")), "ann-points")
    shards = max(1, math.ceil(distinct.count() / rule.shard_points))
    wide = np.float32 if pts.schema["v"].dataType.simpleString() == "array<float>" else np.float64

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h", kind="stable").reset_index(drop=True)
        x = np.stack(rows["v"].to_list()).astype(wide)
        keys = (rows["h"].to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5851F42D4C957F2D)
        g = Graph.built(x, keys, rule)
        ids = np.full((len(x), rule.top + 1), _NONE, np.int64)
        for i, a in enumerate(rows["ids"]):
            ids[i, : len(a)] = a
        return pd.DataFrame([{
            "shard": int(rows["shard"].iloc[0]), "dim": x.shape[1], "wide": x.itemsize, "ids": ids.tobytes(), "vectors": x.tobytes(), "levels": g.levels.astype(np.int64).tobytes(),
            "links": [a.tobytes() for a in g.links], "entry": g.entry,
        }])

    dealt = distinct.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("h", F.lit(11)), F.lit(shards)).cast("int"))
    schema = "shard int, dim int, wide int, ids binary, vectors binary, levels binary, links array<binary>, entry int"
    return staged(dealt.repartition(shards, "shard").groupBy("shard", "dim").applyInPandas(lambda rows: shard(rows), schema), "ann-index"), shards


class Best:
    """Each query's nearest so far, over all shards that a task has met."""

    def __init__(self, queries: int, top: int):
        self.top, self.rows = top, [[] for _ in range(queries)]

    def add(self, query: int, found: list[tuple[float, int]]) -> None:
        self.rows[query] = heapq.nsmallest(self.top, self.rows[query] + found)


def _searched(sent, rule: GraphRule):
    """Searches the task's shards for a block of queries; sent: ids and vectors of the block, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        best = {dim: Best(len(ids), rule.top) for dim, (ids, _) in block.items()}
        for batch in batches:
            for k in range(batch.num_rows):
                s = {name: batch.column(name)[k] for name in batch.schema.names}
                dim = s["dim"].as_py()
                if dim not in block:
                    continue
                x = np.frombuffer(s["vectors"].as_py(), np.float32 if s["wide"].as_py() == 4 else np.float64).reshape(-1, dim)
                ids = np.frombuffer(s["ids"].as_py(), np.int64).reshape(len(x), -1)
                links = [np.frombuffer(a, np.int32).reshape(len(x), -1) for a in s["links"].as_py()]
                g = Graph(x, rule, np.frombuffer(s["levels"].as_py(), np.int64), links, s["entry"].as_py())
                for i, (own, v) in enumerate(zip(block[dim][0].tolist(), block[dim][1])):
                    found = np.array(g.nearest(v.astype(x.dtype), rule.search))
                    # The graph's distances choose candidates; results are measured anew in double precision, summed from the first component on.
                    apart = x[found].astype(np.float64) - v
                    d = np.sqrt(np.cumsum(apart * apart, axis=1)[:, -1])
                    near = ids[found]
                    ok = (near != own) & (near != _NONE)
                    best[dim].add(i, list(zip(np.broadcast_to(d[:, None], near.shape)[ok].tolist(), near[ok].tolist())))
        rows = [(own, p, d) for dim, (ids, _) in block.items() for own, found in zip(ids.tolist(), best[dim].rows) for d, p in found]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    return run


def search(queries: DataFrame, index: DataFrame, rule: GraphRule = GraphRule()) -> DataFrame:
    """query_id, rank, vec_id, score: every query's nearest points of all shards; queries: id, v.

    Queries go out in blocks of at most ``block_bytes``, each broadcast once; a block meets each shard where its file lies, so no
    vector is shuffled, and a task hands on only each query's best over all of its shards.
    """
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    blocks = max(1, math.ceil(size.n * (size.dim or 0) * 8 / rule.block_bytes))
    spark, path = queries.sparkSession, new_path(queries.sparkSession, "ann-found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    for k in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("id", F.lit(31)), F.lit(blocks)) == k).select("id", "v", F.size("v").alias("dim")).toArrow()
        block = {}
        for dim in sorted(set(part["dim"].to_pylist())):
            rows = part.filter(pc.equal(part["dim"], dim))
            block[dim] = rows["id"].to_numpy(), np.array(rows["v"].combine_chunks().flatten().to_numpy(), np.float64).reshape(-1, dim)
        found = index.mapInArrow(_searched(spark.sparkContext.broadcast(block), rule), "query_id long, vec_id long, score double")
        found.withColumn("rank", rank).where(F.col("rank") <= rule.top).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score double").parquet(path)


def nearest(embeddings: DataFrame, every: int = 100, rule: GraphRule = GraphRule(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Searches the rows whose id is divisible by ``every`` against all rows."""
    pts = staged(points(embeddings, key, vector), "ann-rows")
    index, _ = build(pts, rule)
    return search(pts.where(F.col("id") % every == 0), index, rule)
