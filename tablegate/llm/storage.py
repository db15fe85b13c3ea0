"""Results written once to the cluster's shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablegate.workspace import scratch_folder


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the folder of ``spark.checkpoint.dir``.

    Cuts the lineage: later jobs, and tasks repeated after an executor is
    lost, read the files and compute nothing again.
    """
    path = scratch_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
