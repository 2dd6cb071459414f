"""Session helpers: a local builder for tests and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.files.maxPartitionBytes", "8m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a
    cluster without it is refused, since another executor could not read
    what was written.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="sluice-checkpoint-")
    context.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new table in the checkpoint folder and go on from it.

    This cuts the lineage like a checkpoint. A columnar table also keeps column
    pruning and lets the planner see true sizes.
    """
    folder = f"{intermediates(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def intermediates(spark: SparkSession) -> str:
    """The folder that holds this application's intermediate tables."""
    return f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results not yet written can't be read after that."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(intermediates(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
