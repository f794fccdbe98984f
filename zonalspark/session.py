"""Session factory: UTC, adaptive execution, and partitions by the cores at hand."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "zonalspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators count on; conf overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder in the one that the cluster shares (spark.checkpoint.dir); only on one machine without that setting, one of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix=f"{kind}-")
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there and survives lost executors."""
    path = shared_folder(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
