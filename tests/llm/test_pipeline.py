import re

import corpus_pipeline as P
from millrace.llm.common import staged

from .test_decontaminate import plain
from .test_minhash import brute
from .test_mixing import shares
from .test_secrets import base

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        out = staged(stage(spark, docs, SF), "t")
        if name != "mix":
            assert out.columns == columns
        seen[name] = (docs.collect(), out.collect())
        docs = out

    before, after = seen["quality"]
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert sum(r.doc_id in kept for r in before if y.get(r.doc_id) == 1) > 0.98 * sum(y.get(r.doc_id) == 1 for r in before)
    assert sum(r.doc_id in kept for r in before if y.get(r.doc_id) == 0) < 0.2 * sum(y.get(r.doc_id) == 0 for r in before)

    before, after = seen["near_duplicates"]
    want = brute([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {i for i, (_, c) in want.items() if i == c}

    before, after = seen["decontaminate"]
    items = [plain(r.text).strip(b" ") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in before if any(v in plain(r.text) for v in items)}
    kept = {r.doc_id for r in after}
    assert whole and not whole & kept and len(before) - len(after) <= len(whole) + 3

    before, after = seen["secrets"]
    old = {r.doc_id: r for r in before}
    assert len(after) == len(before) and any("<SECRET>" in r.text for r in after)
    for r in after:
        assert not base(r.text) and (r.text == old[r.doc_id].text or "<SECRET>" in r.text and r.n_chars == len(r.text))

    before, after = seen["mix"]
    sizes = {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want, took = shares(sizes), {}
    for r in after:
        took[r.source] = took.get(r.source, 0) + r.taken
        assert r.copies <= 3
    assert len(after) == len(before) and all(abs(took[s] - want[s]) <= 0.02 * want[s] + 5 for s in sizes)


def test_odd_rows_go_through(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "x " * 40, "en", "a", 3), (2, "x " * 40, "en", "a", 3), (None, "q w e r t y u", "de", "b", 4), (5, "word " * 60_000, "en", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS size", "2 AS score", "3 AS rep")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = P.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "2", "5", "None"]
    empty = tmp_path / "empty"
    for name, schema in (("documents", docs.schema), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(empty / f"{name}.parquet"))
    assert P.run(spark, str(empty)).count() == 0
