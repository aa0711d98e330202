"""Folders for tables that a query derives on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``, the shared folder the cluster names. Only a
    local session, where driver and executors are one process, may do without.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/starloom/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"starloom-{label}-")
