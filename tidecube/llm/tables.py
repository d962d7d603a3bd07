"""Reading the given tables and keeping intermediate ones in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, as in tests, one is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='llm-shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def bounded(df: DataFrame) -> DataFrame:
    """The frame, after seeing to it that its session sends texts to Python in small batches.

    Spark's default of 10,000 rows a batch makes tens of megabytes of ordinary documents. A
    session that has set another number keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(ARROW_ROWS, "10000") == "10000":
        conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return df


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Writes a frame as a Parquet table in the shared folder and reads it back.

    It cuts the lineage: a lost executor costs the tasks it ran, not the stages before. The
    tables stay in the shared folder until the cluster clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
