"""A session with the settings that the operators assume."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "foliant", **conf: str) -> SparkSession:
    """Adaptive execution with skew joins, UTC; anything else through conf."""
    builder = SparkSession.builder.appName(name)
    fixed = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    for k, v in (fixed | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, one of our own on a local master (tests), else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="foliant-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: partition numbers in it stay what they are, and lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/foliant/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
