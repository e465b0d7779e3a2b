from types import SimpleNamespace

import pytest

from millrace.operators import staging


def test_tables_are_written_and_released(spark):
    mark = staging.mark()
    one, two = staging.staged(spark.range(5), "a"), staging.staged(spark.range(3), "b")
    paths = staging._written[mark:]
    assert one.count() == 5 and two.count() == 3 and all(staging.exists(spark, p) for p in paths)
    staging.release(spark, mark, keep=(paths[1],))
    assert not staging.exists(spark, paths[0]) and two.count() == 3
    staging.release(spark, mark)
    assert not staging.exists(spark, paths[1]) and staging.mark() == mark


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None)
    for master in ("yarn", "spark://x:7077", "local-cluster[2,1,1024]", "k8s://x"):
        session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master))
        with pytest.raises(RuntimeError):
            staging.shared_dir(session)


def test_small_inputs_are_spread_and_files_move(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert staging.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and staging.spread(df).count() == 100
    wide = df.repartition(64)
    assert staging.spread(wide).rdd.getNumPartitions() == 64
    staging.write_text(spark, str(tmp_path / "a.txt"), "é")
    staging.write_text(spark, str(tmp_path / "a.txt"), "é2")
    assert staging.read_text(spark, str(tmp_path / "a.txt")) == "é2" and staging.read_text(spark, str(tmp_path / "none")) is None
    staging.write_text(spark, str(tmp_path / "b.txt"), "b")
    with pytest.raises(FileExistsError):
        staging.move(spark, str(tmp_path / "b.txt"), str(tmp_path / "a.txt"))
    staging.move(spark, str(tmp_path / "b.txt"), str(tmp_path / "a.txt"), overwrite=True)
    assert staging.read_text(spark, str(tmp_path / "a.txt")) == "b" and "a.txt" in staging.sizes(spark, str(tmp_path))


def test_written_tables_let_the_driver_collect_its_garbage(spark, monkeypatch):
    def whole():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before, mark = whole(), staging.mark()
    monkeypatch.setattr(staging, "_settled", float("-inf"), raising=False)
    assert staging.staged(spark.range(5), "a").count() == 5
    once = whole()
    assert once > before
    assert staging.staged(spark.range(5), "b").count() == 5 and whole() == once
    staging.release(spark, mark)
