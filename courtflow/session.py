"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: For files of whole documents. Spark decodes up to 4,096 rows of a row group at once, whatever their size, so
#: groups are kept small: 4 MB packed are some 30 MB of JSON, and more still of nested columns.
DOCUMENT_FILES = {"parquet.block.size": 4 << 20}


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("courtflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # small test files in as many splits as there are cores
        .config("spark.sql.files.minPartitionNum", str(shuffle_partitions))
        # call sites of Column functions cost more than building the plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting, as in tests, gets one of its own; on a
    cluster a machine's own folder would lose rows.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="courtflow-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/courtflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once below the shared folder, with df's schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
