"""Session helpers: recommended settings, and where shared scratch data goes."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the jobs are written for. Shuffle width is left to the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot compiles no method above 8000 bytes of bytecode: beyond that the split-up
    # code of the single operators is faster than one interpreted stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Fill in the recommended settings that the session does not set itself."""
    chosen = spark._jsparkSession.sessionState().conf()
    for key, value in RECOMMENDED.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("meterflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder of the cluster.

    Only a session on one machine (``local[...]``) without that setting gets a local temporary folder; on a
    cluster every executor would write to a disk of its own, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="meterflow-")
    return f"{root}/meterflow/{label}-{uuid.uuid4().hex}"


def small_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few rows as a local relation, whose size the optimizer knows."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)
