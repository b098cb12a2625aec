"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import SparkSession

# What a job should run with. Sizes come from cluster_conf.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call-site capture for every Column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# State on disk instead of the heap, for long-running streams.
STREAM_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def cluster_conf(shuffle_gb: float, split_mb: int = 128) -> dict[str, str]:
    """Partition sizes for a run that shuffles at most ``shuffle_gb`` and reads in splits of ``split_mb``.

    AQE merges shuffle partitions but never splits below their first number,
    so that number has to fit the largest shuffle; 256 MB per task leaves room
    for its sort or hash table. For scans of many terabytes 512 MB splits keep the
    number of tasks the driver tracks in the hundred thousands.
    """
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(200, int(shuffle_gb * 4))),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
    }


def build_session(app: str = "fleetgauge", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **STREAM_STATE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def together(*calls: Callable[[], object]) -> None:
    """Run independent Spark work at the same time, so that small jobs don't wait for each other.

    All calls are waited for; then the first error is raised.
    """
    failed: list[BaseException] = []

    def run(call: Callable[[], object]) -> None:
        try:
            call()
        except BaseException as error:  # handed to the caller below
            failed.append(error)

    threads = [InheritableThread(target=run, args=(call,)) for call in calls]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the cluster shares.

    Only a local session may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="fleetgauge-")
    return f"{shared.rstrip('/')}/{purpose}-{os.urandom(8).hex()}"
