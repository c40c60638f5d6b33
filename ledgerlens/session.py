"""Session helpers: a tuned builder and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "ledgerlens", master: str | None = None,
                  shuffle_partitions: int | None = None, shared: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew joins, UTC timestamps and a state store for timers.

    `shared` is a folder that all executors can write to and read; work tables go there.

    On a cluster leave `master` and `shuffle_partitions` unset: the submit
    command names the master, and adaptive execution coalesces the initial
    partition number down to what the data needs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(STATE_STORE, ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache
def _own_folder(app: str) -> str:
    """One temporary folder for each application on one machine."""
    return tempfile.mkdtemp(prefix="ledgerlens-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path for checkpoints and hand-over tables.

    It lies in the shared folder the cluster names in `spark.checkpoint.dir`. Where
    that is unset, a session on one machine gets a temporary folder of its own;
    executors elsewhere could not read it, so any other master is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder(spark.conf.get("spark.app.id", ""))
    return os.path.join(root, f"ledgerlens-{purpose}-{uuid.uuid4().hex}")
