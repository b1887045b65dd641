"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# What one task of a shuffle should get to see; it sorts and spills comfortably in a usual executor.
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024


def build_session(
    app_name: str = "starloom",
    master: str | None = None,
    largest_shuffle_bytes: int | None = None,
    filter_keys_up_to: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on.

    ``largest_shuffle_bytes`` is a guess at the biggest shuffle of the job. Its tasks are cut to
    some 256 MB each, and adaptive execution merges what turns out smaller, so that a guess too
    high costs little and one too low shows as spilling.

    ``filter_keys_up_to`` is the size in bytes of a filtered dimension up to which Spark makes a Bloom
    filter of its keys and drops facts without a match before they are shuffled, where the fact
    table is at least ten times as large. It is for dimensions too large to broadcast; the filter
    itself is at most 8 MB. Pass further settings with dots written
    as double underscores; they override those made here.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Concurrent writes share the executors instead of queueing behind the largest.
        "spark.scheduler.mode": "FAIR",
    }
    if largest_shuffle_bytes is not None:
        tasks = max(1, -(-largest_shuffle_bytes // SHUFFLE_TASK_BYTES))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(tasks)
    if filter_keys_up_to is not None:
        prefix = "spark.sql.optimizer.runtime.bloomFilter"
        settings[f"{prefix}.enabled"] = "true"
        settings[f"{prefix}.creationSideThreshold"] = str(filter_keys_up_to)
        settings[f"{prefix}.applicationSideScanSizeThreshold"] = str(10 * filter_keys_up_to)
    settings.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of the cluster.

    The folder is ``spark.checkpoint.dir``, which every executor can reach. Only a local-mode
    session without that setting falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
