import random

from millrace.llm.components import components
from millrace.operators import staging


def test_long_paths_stars_and_repeats(spark):
    rng = random.Random(2)
    ids = list(range(3000))
    rng.shuffle(ids)
    edges = [(a, b) for a, b in zip(ids, ids[1:])] + [(10_000, 10_000 + k) for k in range(1, 500)] + [(20_001, 20_000), (20_000, 20_001), (5, 5)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long").selectExpr("*", "1 AS comp")).collect()}
    assert {got[i] for i in ids} == {0} and {got[10_000 + k] for k in range(500)} == {10_000} and got[20_001] == 20_000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(None, 1), (2, None), (3, 4)], "a long, b long")).count() == 2


def test_small_tables_are_few_files(spark):
    """Else their footers take them over the size of a broadcast, and each join of a round runs a task for each shuffle partition."""
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old, mark = {k: spark.conf.get(k) for k in settings}, staging.mark()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.id: r.comp for r in components(spark.createDataFrame([(k, k + 1) for k in range(400)], "a long, b long")).collect()}
        files = [len(staging.sizes(spark, p, ".parquet")) for p in staging._written[mark:]]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        staging.release(spark, mark)
    assert got == dict.fromkeys(range(401), 0) and len(files) > 3 and max(files) <= 25
