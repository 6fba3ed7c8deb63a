"""Results that outlive lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.

    Only a local session without one gets a folder of its own; on a cluster
    the folder has to be shared, and its absence is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named:
            sc.setCheckpointDir(named)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there.

    Iterative jobs read their input hundreds of times; after this a lost
    executor costs a re-read of the small result, not of the calls behind it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
