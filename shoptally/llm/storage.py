"""Where intermediate tables of the operators are kept."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from shoptally.sources.scratch import shared_folder


def saved(rows: DataFrame, release: bool = False) -> DataFrame:
    """Write ``rows`` to the checkpoint folder and cut the lineage there.

    Shuffle files of finished steps stay until the driver's JVM next collects its garbage;
    ``release`` asks for that now, after a step with large shuffles that is not needed any more.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    out = rows.checkpoint()
    if release:
        del rows
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return out
