"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cashcast", warehouse_dir: str | None = None) -> SparkSession:
    """Local session used by tests and bench.py. On a cluster, use the cluster's session."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = SparkSession.builder
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    spark = (
        builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local files are read by one task; a local read of what it shuffled would be one task again
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when nothing is configured and the master is local (tests) a fresh scratch
    folder is made; a cluster without the setting is an error, never a local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder: ids are checkpointed there")
        configured = tempfile.mkdtemp(prefix="cashcast-ckpt-")
        _delete_on_exit(spark, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per Spark context.

    Functions of grouped maps are pickled by module name, so every worker must be able to
    import the package, whatever folder the driver was started from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_cashcast_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cashcast-ship-"), "cashcast_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("cashcast", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._cashcast_shipped = True


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system of ``path`` delete it when the JVM ends."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: the table outlives executors, and later stages read exactly these
    rows. Each call writes a folder of its own under one for the application, which is
    deleted when the application's JVM ends.
    """
    spark = df.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cashcast-{spark.sparkContext.applicationId}"
    if getattr(spark.sparkContext, "_cashcast_store", None) != root:
        _delete_on_exit(spark, root)
        spark.sparkContext._cashcast_store = root
    path = f"{root}/{uuid.uuid4().hex}/{label}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cashcast_path = path
    return out


def release(*stored: DataFrame) -> None:
    """Delete tables that ``store`` wrote and that no frame still to be computed reads."""
    for df in stored:
        jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
        where = jvm.org.apache.hadoop.fs.Path(df._cashcast_path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


#: Rows of a narrow table that may be broadcast: a few columns of numbers, so tens of MB.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, stored and counted, with a broadcast hint if it has at most ``rows`` rows.

    For the narrow side of a join with wide rows, which then need no shuffle; beyond the
    bound the join is Spark's own choice.
    """
    df = store(df, "narrow")
    return F.broadcast(df) if df.count() <= rows else df
