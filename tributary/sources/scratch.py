"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under the shared checkpoint folder of the cluster.

    Only a local session may do without the setting; elsewhere executors would not see the folder.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return f"{root.rstrip('/')}/tributary-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tributary-")
    raise ValueError(f"set {SETTING} to a folder that all executors share")
