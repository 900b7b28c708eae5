"""SparkSession and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one that is given."""
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | conf
    return SparkSession.builder.master(master).config(map=settings).getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """The rows without their lineage: a reliable checkpoint in spark.checkpoint.dir.

    A temporary folder is used only where that is unset and the master is local.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
