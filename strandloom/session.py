"""Session helpers: a tuned local session for tests and benches, and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strandloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint, so that later steps read it once made.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.  A folder of our own is
    made only where none is named and everything runs in one JVM, as in tests.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, as a compressed table in the shared folder: for wide rows read often."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []


def clear_staged(spark: SparkSession) -> int:
    """Delete the tables this process staged, once the results that read them are written; gives their number.

    Checkpoints go with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    n = len(_STAGED)
    while _STAGED:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables that all executors share."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="spark-strandloom-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
