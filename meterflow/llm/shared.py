"""Where intermediate tables go, and the size of the batches that Python tasks receive."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 512
_DEFAULT_BATCH_ROWS = "10000"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the folder that all executors share.

    Without that setting a session on one machine (``local[...]``, as in tests) gets a
    temporary folder; on a cluster this is an error, as executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_root(spark)
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def _local_root(spark: SparkSession) -> str:
    """One temporary folder for a session on one machine."""
    if not hasattr(spark, "_llm_local_root"):
        spark._llm_local_root = tempfile.mkdtemp(prefix="llm-")
    return spark._llm_local_root


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a written table: its lineage ends there, and a lost executor costs no more than a reread."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> SparkSession:
    """Let Python tasks take ``BATCH_ROWS`` rows at a time, unless the session names a number of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, _DEFAULT_BATCH_ROWS) == _DEFAULT_BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark
