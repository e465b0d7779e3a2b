"""Written intermediate tables in the folder that driver and executors share, and files by the engine's own file systems."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that ``staged`` wrote and nobody has released yet, oldest first.
_written: list[str] = []

#: Inputs up to this size are dealt to all cores before work that a scan of few row groups would leave to one.
SMALL_INPUT = 64 << 20

#: Seconds between two collections of the driver's garbage by ``settle``.
SETTLE_S = 15.0

_settled = 0.0


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where none is set, a local master gets a temporary folder; on a cluster that is an error,
    as executors' files in a machine-local folder can't be seen by others."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/millrace-{tag}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """df written as Parquet and reread: lineage ends, size estimates are real, and a lost executor loses nothing."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    settle(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Collects the driver's garbage, if the last time is ``SETTLE_S`` ago. Plans, broadcasts and shuffle files of finished rounds go only
    when the driver's JVM does so; left alone in a loop of many tasks, it takes its whole heap first and never gives any back."""
    global _settled
    if time.monotonic() - _settled >= SETTLE_S:
        gc.collect()
        spark._jvm.System.gc()
        _settled = time.monotonic()


def few_files(df: DataFrame) -> DataFrame:
    """df in fewer partitions, so that a narrow table of few rows isn't one small file for each shuffle partition: their footers alone would take
    it over the size of a broadcast, and every join with it would shuffle. For plans that end in an aggregate; rows and order stay."""
    cores, dealt = df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(4 * cores, dealt // 8))


def mark() -> int:
    """A point in time for ``release``."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Deletes the tables staged since a mark; results that still read them must have been written. keep: paths that stay."""
    for path in _written[since:]:
        if path not in keep:
            delete(spark, path)
    _written[since:] = [p for p in _written[since:] if p in keep]


def spread(df: DataFrame) -> DataFrame:
    """A small input's rows dealt to all cores, where its scan has few partitions; any other stays as it is. Row order and results don't depend on it."""
    plan, cores = df._jdf.queryExecution(), df.sparkSession.sparkContext.defaultParallelism
    size = int(str(plan.optimizedPlan().stats().sizeInBytes()))
    if cores == 1 or not 0 < size <= SMALL_INPUT or plan.toRdd().getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the engine, for any scheme it knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def sizes(spark: SparkSession, folder: str, suffix: str = "") -> dict[str, int]:
    """Bytes of each file right below a folder, by name; {} where there is no folder."""
    fs, p = file_system(spark, folder)
    if not fs.exists(p):
        return {}
    found = {s.getPath().getName(): s.getLen() for s in fs.listStatus(p) if s.isFile()}
    return {name: size for name, size in found.items() if name.endswith(suffix)}


def move(spark: SparkSession, old: str, new: str, overwrite: bool = False) -> None:
    """Renames a file; FileExistsError where the new one is there and may not be replaced."""
    fs, to = file_system(spark, new)
    if fs.exists(to):
        if not overwrite:
            raise FileExistsError(new)
        fs.delete(to, False)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(old), to):
        raise OSError(f"{old} could not be renamed to {new}")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the old file or the new one: the text goes to a file beside it, which then takes its name."""
    folder, _, name = path.rpartition("/")
    part = f"{folder}/.{name}.{uuid.uuid4().hex}" if folder else f".{name}.{uuid.uuid4().hex}"
    fs, p = file_system(spark, part)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    replace(spark, part, path)


def replace(spark: SparkSession, old: str, new: str) -> None:
    """Renames over an existing file in one step, where the file system can."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(_qualified(spark, new)), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new), options)


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    return str(fs.makeQualified(p).toString()).replace(" ", "%20")
