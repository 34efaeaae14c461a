"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Runtime SQL settings only, so they also apply to a session that already runs.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Fact rows may pile up on one key. AQE splits such a partition; "force" lets it do so
    # also where the split costs one more exchange for a join further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    # Sizes are compared compressed, and the rows of one key compress well.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    # A task writes a few slices side by side instead of sorting all its rows by slice first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the adaptive-execution settings the operators are planned for."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; a cluster session is
    refused, since a machine-local folder would lose rows there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def at_once(steps: Iterable[Callable[[], object]]) -> list:
    """Run independent steps side by side, so that their Spark jobs share the cluster."""
    todo = list(steps)
    with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
        return [done.result() for done in [pool.submit(step) for step in todo]]
