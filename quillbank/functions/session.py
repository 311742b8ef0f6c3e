"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable: the session's ``spark.checkpoint.dir``, else (local masters only) a new folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir isn't set; a cluster needs a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def kept(rows: DataFrame) -> DataFrame:
    """The rows, written once to the checkpoint folder: by columns and compressed, which takes a fraction of a checkpoint's disk."""
    spark = rows.sparkSession
    use_checkpoints(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/kept-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
