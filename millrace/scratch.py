"""Where written intermediates go.

Executors must all see the folder, so it hangs below the one the cluster names
in ``spark.checkpoint.dir``. A temporary folder of our own is used only where
that setting is missing and the session runs on a single machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_own_folder: str | None = None


def _base(spark: SparkSession) -> str:
    global _own_folder
    shared = spark.conf.get(_SETTING, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="run-")
    return _own_folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, grouped by application for later removal."""
    app = spark.sparkContext.applicationId
    return f"{_base(spark)}/millrace/{app}/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    """A catalog or database name nobody has used yet."""
    return f"{label}_{uuid.uuid4().hex[:12]}"
