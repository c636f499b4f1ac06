"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batch of the Python workers: bounds memory per batch of images.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Streaming state outside the JVM heap, so large join/dedup state spills.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_conf(input_bytes: int, executor_cores: int = 4, executors: int = 1000,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at ~input / target (at least 2x the cores) so no
    task holds more than ~256 MB of shuffle data; AQE then coalesces small
    ones and splits skewed ones. Scan splits are capped at the same size.
    """
    cores = executor_cores * executors
    parts = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "alertflow", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, submit with the cluster's own conf."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def default_state_partitions(spark: SparkSession) -> int:
    """State partitions for a stateful stream: one per core of the cluster.

    AQE does not coalesce streaming shuffles, and every state partition costs a
    state-store commit per micro-batch, so the count follows the cores rather
    than the batch-oriented ``spark.sql.shuffle.partitions``.
    """
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # noqa: BLE001 - no SparkContext handle (remote session)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Temporarily set ``spark.sql.shuffle.partitions`` (e.g. around starting a
    stream: the value is fixed into the stream's checkpoint at its first start)."""
    if n is None:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@contextmanager
def session_conf(spark: SparkSession, name: str, value: str):
    """Temporarily set one session setting (a stream reads its own at its start)."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests, the
    bench) a fresh temporary folder is created and registered as the checkpoint
    dir. On a cluster an unset folder is an error: a machine-local one would
    leave each executor with its own files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # static config: cannot be set on a running session, so register the
        # folder with the context only
        d = tempfile.mkdtemp(prefix="alertflow-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one job's output."""
    base = shared_dir(spark)
    return f"{base}/alertflow/{name}/{uuid.uuid4().hex}"
