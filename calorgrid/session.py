"""Session helpers: default local session and lineage cutting that survives lost executors."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

_shipped: dict[str, str] = {}


def local_session(name: str = "calorgrid", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # a checkpoint goes when nothing refers to it
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder named by ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a folder of its own; elsewhere the executors couldn't read it."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="calorgrid-"))
    return df.checkpoint(eager=True)


def parallelism(df: DataFrame, least: int = 1) -> int:
    """Partitions to spread a wide stage over: the session's shuffle partitions."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: inputs below this estimate take plain forms with fewer jobs; results are the same
SMALL_BYTES = 16 << 20


def by_range(df: DataFrame, order: list[Column], bytes_each: int = 128 << 20) -> DataFrame:
    """``df`` range-partitioned by ``order``: into the session's shuffle partitions, or more where the optimizer's estimate
    of its size asks for them."""
    parts = estimated_bytes(df) // bytes_each
    known = parallelism(df) < parts < 1 << 20  # an estimate beyond that isn't one
    return df.repartitionByRange(int(parts), *order) if known else df.repartitionByRange(*order)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each Spark application.

    The archive is written to the folder in ``spark.checkpoint.dir``; a session that names none serves it from a folder of
    the driver's own, which no executor reads."""
    sc = spark.sparkContext
    if _shipped.get("app") == sc.applicationId:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="calorgrid-")
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/{sc.applicationId}", "calorgrid.zip")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    _shipped["app"] = sc.applicationId


def spread(df: DataFrame, per_core: int = 3) -> DataFrame:
    """``df`` dealt out evenly where its files make fewer partitions than there are cores, for stages whose work a row is
    heavy. A large input has partitions enough and isn't moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * per_core) if df.rdd.getNumPartitions() < cores else df
