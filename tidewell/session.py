"""Sessions, input tables and the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the library relies on: UTC days, and partition values that stay text ("1d", "09").
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
}


def session(name: str = "tidewell") -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one on a single machine, and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-tidewell-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidewell-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    What follows starts from files that every executor can read, so a lost executor costs a re-read and
    never a re-computation, and Spark knows the true size of the table when it chooses a join. ``forget``
    deletes the files once nothing reads them any more.
    """
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def forget(*settled: DataFrame | None) -> None:
    """Delete the files of settled tables; what was made from them must have been written before."""
    for df in settled:
        if path := getattr(df, "settled_at", None):
            context = df.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
