import bz2
import gzip
import json
import shutil

import pytest
from pyspark.errors import PySparkException

from millrace.__main__ import main
from millrace.operators.quality import HeuristicModel, ScoreStats, model_for, score_stats
from millrace.plans import pipeline, state
from millrace.plans.config import FilterConfig, NearConfig, OutputConfig, QualityConfig, RunConfig
from millrace.sources import download, readers, sinks


def test_xml_pages(spark, tmp_path):
    page = lambda title, ns, i, text, more="", second="": f"<page><title>{title}</title><ns>{ns}</ns><id>{i}</id>{more}<revision><id>9</id><text x='1'>{text}</text></revision>{second}</page>"
    pages = [page("A", 0, 1, "body one"), page("B", 1, 2, "talk"), page("C", 0, 3, "x", "<redirect title='A'/>"), page("D", 0, 4, "  "), page("", 0, 5, "first", second="<revision><text>second</text></revision>"), "<page><ns>0</ns><id>6</id><revision><text>no title</text></revision></page>"]
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(("<mediawiki>" + "".join(pages[:3])).encode()) + bz2.compress(("".join(pages[3:]) + "</mediawiki>").encode()))
    rows = readers.read_pages(spark, str(tmp_path / "d.xml.bz2")).orderBy("_ord").collect()
    assert [(r.id, r.title, r.text) for r in rows] == [("1", "A", "body one"), ("5", "", "first")]
    assert readers.read_pages(spark, str(tmp_path / "d.xml.bz2"), include_redirects=True).count() == 3


def test_tsv(spark, tmp_path):
    (tmp_path / "d.tsv.gz").write_bytes(gzip.compress(b"D1\thttp://e\tmy title\tmy\tbody\nbad line\nD2\tu\tt\tb\xff\n"))
    d = readers.read_tsv(spark, str(tmp_path / "d.tsv.gz"))
    kept = readers.apply_malformed_policy(d).orderBy("_ord").collect()
    assert [(r.doc_id, r.body) for r in kept] == [("D1", "my\tbody"), ("D2", "b�")]
    with pytest.raises(PySparkException):
        readers.clean_tsv(readers.apply_malformed_policy(d, "raise")).collect()
    dense = readers.dense_order(d).orderBy("_ord").collect()
    assert [r._ord for r in dense] == [0, 1, 2]
    cleaned = readers.clean_tsv(readers.apply_malformed_policy(d), min_body_chars=4).orderBy("_ord").collect()
    assert [(r.body, r.drop_reason) for r in cleaned] == [("my body", None), ("b�", "cleaner_dropped")]
    assert [r.drop_reason for r in readers.clean_tsv(d).orderBy("_ord").collect()] == [None, "malformed", None]


def test_broken_and_rootless_pages(spark, tmp_path):
    page = lambda i, text: f"<page><title>T{i}</title><ns>0</ns><id>{i}</id><revision><text>{text}</text></revision></page>\n"
    (tmp_path / "d.xml").write_text(page(1, "a") + page(2, "b\x02c") + "<page><title>q</title><ns>0</ns><id>9</id><revision><text>open</revision></page>" + page(3, "c") + "</mediawiki>")
    scan = readers.scan_pages(spark, str(tmp_path / "d.xml"))
    assert [r.is_malformed for r in scan.orderBy("_ord").collect()] == [False, True, True, False]
    assert [r.id for r in readers.read_pages(spark, str(tmp_path / "d.xml")).orderBy("_ord").collect()] == ["1", "3"]
    with pytest.raises(PySparkException):
        readers.read_pages(spark, str(tmp_path / "d.xml"), policy="raise").select("title").collect()


def test_shards_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(i, str(i)) for i in range(5)], "_ord long, text string").repartition(3)
    m = sinks.write_shards(df, tmp_path, OutputConfig(shard_rows=2, prefix="p"))
    assert [(s["name"], s["num_rows"]) for s in m["shards"]] == [("p-00000.parquet", 2), ("p-00001.parquet", 2), ("p-00002.parquet", 1)]
    assert [r.text for r in spark.read.parquet(m["shards"][0]["path"]).collect()] == ["0", "1"]
    with pytest.raises(FileExistsError):
        sinks.write_shards(df, tmp_path, OutputConfig(shard_rows=2, prefix="p"))
    assert sinks.write_shards(df.where("false"), tmp_path, OutputConfig(prefix="q"))["num_shards"] == 0
    assert sinks.merged_manifest(m, m)["total_rows"] == 10 and sinks.total_bytes(m["shards"]) > 0 and sinks.total_bytes([{"name": "x"}]) == 0


def rows_of(spark, n, start=0):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    return spark.createDataFrame([(i, f"d{i}", "t", " ".join(words[(i * k) % 10] + str(i % 7 * k) for k in range(1, 30))) for i in range(start, start + n)], "_ord long, doc_id string, title string, body string")


def test_resumed_runs_equal_one_run(spark, tmp_path):
    config = RunConfig(output=OutputConfig(shard_rows=4, prefix="s"))
    whole = pipeline.run(rows_of(spark, 30), tmp_path / "one", config)
    pipeline.run(rows_of(spark, 30), tmp_path / "two", RunConfig(output=config.output, max_rows=11))
    second = pipeline.run(rows_of(spark, 30), tmp_path / "two", config)
    for key in ("written_rows_total", "drop_reasons", "processed_rows_total", "quality"):
        assert second[key] == whole[key], key
    assert whole["processed_rows_total"] == 30 == whole["written_rows_total"] + whole["dropped_rows"] and whole["quality"]["count"] == whole["written_rows_total"]
    assert (second["processed_rows_new"], second["dedup"]["near"]["inserted_total"]) == (19, whole["dedup"]["near"]["inserted_total"])
    assert set(second["stage_seconds"]) == {"deterministic_filter", "exact_dedup", "near_dedup", "quality_scoring"} and second["total_output_bytes"] > 0
    ids = lambda p: sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / p / "data")).collect())
    assert ids("one") == ids("two")
    with pytest.raises(RuntimeError):
        pipeline.run(rows_of(spark, 30), tmp_path / "two", RunConfig(near=NearConfig(hamming_threshold=2)))
    assert "# corpus" in (tmp_path / "two" / "README.md").read_text()
    # An index in another place is another index; a run that doesn't resume starts anew.
    shutil.copytree(tmp_path / "two", tmp_path / "three")
    with pytest.raises(RuntimeError):
        pipeline.run(rows_of(spark, 30), tmp_path / "three", config)
    again = pipeline.run(rows_of(spark, 30), tmp_path / "three", RunConfig(output=config.output, resume=False))
    assert again["written_rows_total"] == whole["written_rows_total"] and ids("three") == ids("one")


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    lines = [f"D{i}\thttp://e/{i}\ttitle\t" + " ".join(words[(i * k) % 10] + str(i * k % 17) for k in range(1, 30)) for i in range(12)]
    (tmp_path / "d.tsv.gz").write_bytes(gzip.compress("\n".join([*lines[:6], "bad line", lines[0], *lines[6:]]).encode()))
    run = lambda *a: main(list(a), spark) or json.loads(capsys.readouterr().out)
    s = run("tsv", "--input", str(tmp_path / "d.tsv.gz"), "--output", str(tmp_path / "out"), "--set", "output.shard_rows=5", "--title", "Docs")
    assert (s["processed_rows_total"], s["malformed_rows"], s["drop_reasons"]["exact_duplicate"]) == (14, 1, 1)
    assert s["num_shards_total"] == -(-s["written_rows_total"] // 5)
    assert spark.read.parquet(str(tmp_path / "out" / "data")).columns == ["doc_id", "url", "title", "body", "source", "version"]
    with pytest.raises(PySparkException):
        run("tsv", "--input", str(tmp_path / "d.tsv.gz"), "--output", str(tmp_path / "strict"), "--set", "malformed_row_policy=raise")
    page = lambda i: f"<page><title>T{i}</title><ns>0</ns><id>{i}</id><revision><text>''T{i}'' [[a|b]] " + " ".join(f"word{i * k}" for k in range(1, 40)) + "</text></revision></page>"
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(("<mediawiki>" + "".join(page(i) for i in range(5)) + "</mediawiki>").encode()))
    s = run("wiki", "--input", str(tmp_path / "d.xml.bz2"), "--output", str(tmp_path / "wiki"))
    assert s["written_rows_total"] == 5 and spark.read.parquet(str(tmp_path / "wiki" / "data")).columns == ["id", "title", "body", "url", "source", "dump_date"]
    with pytest.raises(ImportError):
        run("wiki", "--input", str(tmp_path / "d.xml.bz2"), "--output", str(tmp_path / "w2"), "--parser", "library", "--require-parser")
    samples = [f"__label__{'high_quality' if i % 2 else 'low'} {'good words here' if i % 2 else 'spam spam buy'} {i}" for i in range(40)]
    (tmp_path / "train.txt").write_text("\n".join([*samples, "", "oneword"]))
    t = run("train-quality", "--train-file", str(tmp_path / "train.txt"), "--model-out", str(tmp_path / "model"), "--validation-file", str(tmp_path / "train.txt"), "--calibration-out", str(tmp_path / "c.json"))
    assert t["calibration"]["f1"] == 1.0 and json.loads((tmp_path / "c.json").read_text()) == t
    df = spark.createDataFrame([("good words here",), ("spam spam buy",)], "text string")
    scores = lambda label: [r.q for r in model_for(QualityConfig(enabled=True, model_path=str(tmp_path / "model"), positive_label=label)).score(df, "text", "q").collect()]
    high, low = scores("__label__high_quality")
    assert high > 0.5 > low and scores("__label__other") == [0.0, 0.0]
    with pytest.raises(ValueError):
        model_for(QualityConfig(enabled=True, model_path=str(tmp_path / "none")))
    monkeypatch.delenv("HF_TOKEN", raising=False)
    with pytest.raises(ValueError):
        sinks.publish(str(tmp_path / "out"), "a/b", dry_run=True)
    monkeypatch.setenv("HF_TOKEN", "x")
    assert sinks.publish(str(tmp_path / "out"), "a/b", dry_run=True) is False


def test_public_names_and_environment(tmp_path, monkeypatch):
    import millrace
    from millrace import runtime

    assert all(getattr(millrace, name) is not None for name in millrace.__all__) and len(millrace.__all__) > 50
    with pytest.raises(AttributeError):
        millrace.nothing
    (tmp_path / ".env").write_text("# note\nexport MILL_A='x'\nMILL_B=y\n")
    monkeypatch.setenv("MILL_B", "kept")
    monkeypatch.delenv("MILL_A", raising=False)
    assert runtime.load_env(tmp_path / ".env") == {"MILL_A": "x"}
    assert runtime.tagged_folder("logs", " ") == runtime.tagged_folder("logs") == "logs" and runtime.tagged_folder("logs", " a ").endswith("a")
    runtime.set_seed(3)
    monkeypatch.delenv("MILL_A")


def test_low_quality_first_copy_shadows_later_ones(spark):
    df = spark.createDataFrame([(0, "t", "x" * 30), (1, "t", "x" * 30), (2, "t", "short")], "_ord long, title string, body string")

    class Low:
        def score(self, d, text, out):
            from pyspark.sql import functions as F

            return d.withColumn(out, F.lit(0.1))

    book = pipeline.ledger(df, RunConfig(quality=QualityConfig(enabled=True)), Low())
    assert [r.drop_reason for r in book.orderBy("_ord").collect()] == ["low_quality", "exact_duplicate", "too_short"]
    off = pipeline.ledger(df, RunConfig(filtering=FilterConfig(enabled=False))).where("drop_reason IS NULL")
    assert off.count() == 2


def test_quality_models_and_stats(spark):
    assert model_for(QualityConfig()) is None
    with pytest.raises(ValueError):
        model_for(QualityConfig(enabled=True))
    assert isinstance(model_for(QualityConfig(enabled=True), HeuristicModel()), HeuristicModel)
    df = spark.createDataFrame([(i, x / 10) for i, x in enumerate((1, 2, 3, 4, 5))], "_ord long, quality_score double")
    s = score_stats(df).first()
    assert abs(s["mean"] - 0.3) < 1e-12 and abs(s.p50 - 0.3) < 1e-12 and s["count"] == 5
    assert score_stats(df.where("false")).first()["mean"] == 0.0


def test_score_stats_across_runs():
    a, b = ScoreStats(2, 0.3, 0.1, 0.2, [0.1, 0.2]), ScoreStats(3, 1.2, 0.3, 0.5, [0.3, 0.4, 0.5])
    m = ScoreStats.from_state(a.state()).merged(b)
    assert m.summary() == {"count": 5, "sum": 1.5, "mean": 0.3, "min": 0.1, "max": 0.5, "quantiles": {"p10": pytest.approx(0.14), "p50": 0.3, "p90": pytest.approx(0.46)}}
    assert ScoreStats().merged(ScoreStats()).summary() == {"count": 0, "sum": 0.0, "mean": 0.0, "min": None, "max": None, "quantiles": {}}
    assert a.merged(b, 3).first == [0.1, 0.2, 0.3]


def test_state(spark, tmp_path):
    path = tmp_path / "s.json"
    assert state.load_state(spark, path) == {}
    state.save_state(spark, {"kept_rows": 3, "drop_reasons": None}, path)
    assert state.load_state(spark, path)["kept_rows"] == 3 and state.load_state(spark, path)["drop_reasons"] == {}
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["s.json"]
    path.write_text("{")
    (tmp_path / ".s.json.crc").unlink(missing_ok=True)
    with pytest.raises(json.JSONDecodeError):
        state.load_state(spark, path)
    assert state.merge_counts({"a": 1, "b": 2}, {"b": 3, "c": 1}) == {"a": 1, "b": 5, "c": 1}
    assert state.checkpoint_due(10, 0, 40, 0) and not state.checkpoint_due(0, 0, 99, 0) and not state.checkpoint_due(10, 0, 1, 0)
    assert state.chunk_size(0, 4) == 1 and state.chunk_size(10, 4) == 10 and state.chunk_size(10_000, 4) == 625


def test_download_checks_card_and_upload(tmp_path):
    f = tmp_path / "f"
    with pytest.raises(FileNotFoundError):
        download.verify(f)
    f.write_bytes(b"abc")
    download.verify(f, " BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD ", 3)
    for bad in ({"size": 4}, {"sha256": "00"}):
        with pytest.raises(ValueError):
            download.verify(f, **bad)
    assert download.download(f.as_uri(), f, size=3) == f
    assert download.download(f.as_uri(), tmp_path / "g").read_bytes() == b"abc"
    with pytest.raises(ValueError):
        download.download(f.as_uri(), tmp_path / "k", size=4)
    with pytest.raises(OSError):
        download.download((tmp_path / "none").as_uri(), tmp_path / "h", retries=2, sleep=lambda s: None)
    assert "- `quality.quantiles.p50`: 0.3" in sinks.dataset_card("T", "S", ["id"], {"quality": {"quantiles": {"p50": 0.3}}})

    class Client:
        def __init__(self, fails):
            self.fails, self.calls = fails, 0

        def create_repo(self, repo_id, *, private):
            self.calls += 1
            if self.calls <= self.fails:
                raise OSError("busy")

        def upload_folder(self, repo_id, folder, path_in_repo):
            self.done = (repo_id, path_in_repo)

    ok, waits = Client(2), []
    sinks.upload(ok, "a/b", "x", sleep=waits.append)
    assert ok.done == ("a/b", "data") and waits == [5, 10]
    with pytest.raises(OSError):
        sinks.upload(Client(9), "a/b", "x", sleep=waits.append)
    for bad in (None, "", "None"):
        with pytest.raises(ValueError):
            sinks.upload(ok, bad, "x")
