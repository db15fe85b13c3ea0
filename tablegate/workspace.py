"""Shared scratch space for tables a job derives and reads back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary
    folder: on a cluster the executors could not see it.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        # not local-cluster, whose executors are processes of their own
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tablegate-")
    return f"{shared.rstrip('/')}/tablegate-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """Create a database of a new name in a scratch folder; returns the name."""
    name = f"tablegate_{uuid.uuid4().hex}"
    location = scratch_folder(spark).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name
