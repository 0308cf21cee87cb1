"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Keeps the state of streams beside the heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


@contextmanager
def own_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that start within use the store of ``STATE_STORE``, whatever the session's; a stream takes its settings as it starts.

    Each partition of state costs every micro-batch a commit and Python work, however little it holds, so there are no more than two per core.
    """
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    settings = {**STATE_STORE, "spark.sql.shuffle.partitions": str(partitions)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_session(cores: int | str = "*", memory: str = "4g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, submit with its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kerbstat")
        .config(map=STATE_STORE)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a temporary folder,
    made once per session. On a cluster a machine-local folder would be lost with its
    executor, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = spark.conf.get("kerbstat.scratch.dir", None)
    if root is None:
        root = tempfile.mkdtemp(prefix="kerbstat-")
        spark.conf.set("kerbstat.scratch.dir", root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the scratch root; nothing is created or deleted."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative trainers a checkpoint folder so that their lineage is cut."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
