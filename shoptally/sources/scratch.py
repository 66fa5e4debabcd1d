"""The shared folder for intermediate tables, and tables that are kept there to cut a lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share.

    Where none is named, a temporary folder is made for the context if all of Spark runs in this one process;
    on a cluster that is an error, because each machine would write to its own disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp())
    return named or context.getCheckpointDir()


def saved(rows: DataFrame) -> DataFrame:
    """Write ``rows`` to the checkpoint folder and read them from there; a lost executor does not cost them."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()
