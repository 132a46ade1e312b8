"""Session helpers: a local builder for tests and benchmarks, and the shared staging folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def local_session(cpus: int = 8, memory: str = "8g", app: str = "sparring") -> SparkSession:
    """A `local[cpus]` session. On a cluster the caller brings their own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Call-site capture costs more than building the plans does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="sparring-")


def staging_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a scratch folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the staging folder; never reused, so a retried run overwrites nothing."""
    return f"{staging_dir(spark)}/sparring/{label}-{uuid.uuid4().hex[:12]}"


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small driver-side table as a local relation, which Spark can broadcast without a job."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    frame = pa.table(
        [pa.array(values, type=to_arrow_type(f.dataType)) for values, f in zip(columns, schema)], names=schema.names
    )
    return spark.createDataFrame(frame, schema)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the staging folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def release(*staged: DataFrame) -> None:
    """Delete the tables that `materialize` wrote for these frames; nothing may read them afterwards."""
    for df in staged:
        path = getattr(df, "_staged_path", None)
        if path:
            delete_path(df.sparkSession, path)
            df._staged_path = None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark can read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark can write to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
