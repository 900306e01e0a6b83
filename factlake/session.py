"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark then removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LOCAL_FOLDER_CONF = "factlake.local.folder"
#: Rows that a task sorts or folds at most, about, where ``spread`` is used.
TASK_ROWS = 1 << 19


def build_session(app: str = "factlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Unset, a local master (tests, bench) gets a temporary folder; a cluster is refused, because its
    executors would not see a machine-local one.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        named = spark.sparkContext.getCheckpointDir() or spark.conf.get(LOCAL_FOLDER_CONF, None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    if not named:
        named = tempfile.mkdtemp(prefix="factlake-")
        spark.conf.set(LOCAL_FOLDER_CONF, named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, path: str) -> None:
    """Write a table as Parquet; the shuffle files of the plan go with the end of the query."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_CONF, None)
    conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP_CONF)
        else:
            conf.set(CLEANUP_CONF, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write a table in the shared folder and read it back.

    A result used several times is then computed once, survives the loss of executors, and later
    plans see a short lineage, pruned columns and real sizes.  What is not discarded is left to the
    cluster's own retention, like a checkpoint.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned and no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def many(spark: SparkSession, rows: int) -> int | None:
    """Partitions for ``rows`` rows where one for each core would hold more than ``TASK_ROWS``; else null.

    Adaptive execution joins partitions until there is one for each core or some 64 MB, as compressed; narrow rows that compress
    well are then millions a task, which a sort or a hash table holds unpacked.
    """
    return rows // TASK_ROWS + 1 if rows > TASK_ROWS * spark.sparkContext.defaultParallelism else None


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` over as many partitions as ``many`` asks for; unchanged where Spark's own number does."""
    n = many(df.sparkSession, rows)
    return df if n is None else df.repartition(n, *keys)
