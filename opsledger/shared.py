"""The folder that all executors share, and cuts of the lineage through it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the context's; on a local master a temporary folder if neither is set, on a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="opsledger-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def checkpoint(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Cuts the lineage through files in the shared folder, which outlive lost executors. ``paths`` takes their place down, for ``dropped``."""
    shared_dir(df.sparkSession)
    out = df.checkpoint()
    if paths is not None:
        paths.append(out._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return out


def stored(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again, which cuts the lineage as ``checkpoint`` does. ``paths`` takes its place down, for ``dropped``."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Deletes stored tables that nothing reads any more, as what was made of them is stored itself."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    paths.clear()
