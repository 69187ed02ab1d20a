"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks; on a cluster the session comes from the outside."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("helixframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def _checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a local one where it names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is not set")
            folder = tempfile.mkdtemp(prefix="helixframe-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """The name of a new folder that all executors share."""
    return f"{_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint.

    The folder is the one that the cluster names in ``spark.checkpoint.dir``; only when there is
    none, as in tests, is a local one made. The files outlive the executors that wrote them.
    """
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
