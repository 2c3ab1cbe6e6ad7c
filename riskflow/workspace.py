"""Where jobs put state, topics and lineage-cutting tables.

Everything goes under the shared folder the cluster names in
``spark.checkpoint.dir`` (read from the session).  Only when it is unset in a
local session is a fresh folder created.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CONF_KEY = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, taken to be shared as the
    cluster says.  Where it is unset a cluster is an error, and a local
    session gets a folder of its own, set on its context."""
    root = spark.conf.get(CONF_KEY, None) or _context_folder(spark)
    if not root:
        if master(spark) != "local" and not master(spark).startswith("local["):
            raise RuntimeError(f"set {CONF_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="riskflow-")   # unset: local run or test only
        spark.sparkContext.setCheckpointDir(root)
        root = _context_folder(spark)
    return root.rstrip("/")


def _context_folder(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        return None


def master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        return spark.conf.get("spark.master", "unknown")


def parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (default parallelism), for sizing splits."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        return int(spark.conf.get("spark.default.parallelism",
                                  spark.conf.get("spark.sql.shuffle.partitions", "200")))


def path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_root(spark), *parts])


def new_run(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one run (never reused, never cleared)."""
    return path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def is_local_path(p: str) -> bool:
    return p.startswith("/") or p.startswith("file:")


def ensure_local_dir(p: str) -> None:
    if is_local_path(p):
        os.makedirs(p.replace("file:", "", 1), exist_ok=True)
