"""Session construction and the shared scratch location.

Jobs never pick a machine-local folder on a cluster: intermediate tables and
stream checkpoints live under ``spark.checkpoint.dir``, which the cluster sets
to a shared filesystem. Only when the setting is absent (local runs, tests) do
we create one under the system temp folder and record it in the session.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that matter for the plans built here. AQE re-plans joins and
# shuffle partition counts from runtime sizes and splits skewed join
# partitions; timestamps are interpreted in UTC so that hour and window
# boundaries do not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Tasks never wait for a preferred slot; on a cluster, readers of shuffle
    # output and cached blocks are spread by AQE rather than by locality.
    "spark.locality.wait": "0s",
    # Streaming state (detector moments per meter, open gold windows, join
    # buffers) lives in RocksDB off the JVM heap; commits upload changelogs.
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

MB = 1024 * 1024


def sizing_conf(input_bytes: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of input.

    Scan splits and post-shuffle partitions of about ``target_partition_bytes``
    keep every task's working set well inside executor memory (sorts and
    window buffers spill beyond it). The initial shuffle partition count is
    an upper bound from the input size; AQE coalesces small partitions at run
    time and splits skewed join partitions above 4x the target.
    """
    parts = max(8, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "meterlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch area (``spark.checkpoint.dir``).

    Reads the setting from the session; sets a local one only when it is
    unset on a local master (tests, single-machine runs). On a cluster a
    machine-local folder would be a different one on each executor.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a shared folder on master {master!r}")
        d = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared scratch area."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (memo key for per-session work)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 -- sessions without a local SparkContext
        return f"session-{id(spark)}"


def ship_package(spark: SparkSession) -> None:
    """Make ``meterlake`` importable in the executors' Python workers.

    The stateful detector and the file deleter run Python on executors;
    their functions refer to this package. It is zipped once per
    application and added with ``addPyFile`` (what ``--py-files`` does at
    submit time), so workers import it whatever their working folder.
    """
    key = app_key(spark)
    if key in _shipped:
        return
    import os
    import zipfile

    import meterlake
    pkg = os.path.dirname(os.path.abspath(meterlake.__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="meterlake-pkg-"), "meterlake.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(dirpath, n)
                    z.write(full, os.path.relpath(full, root))
    try:
        spark.sparkContext.addPyFile(zpath)
    except Exception:  # noqa: BLE001 -- Spark Connect sessions ship artifacts instead
        spark.addArtifacts(zpath, pyfile=True)
    _shipped.add(key)


class conf_scope:
    """Set SQL configs for the duration of a block, then restore them.

    Used around ``writeStream.start()``: a query captures the session's
    configuration when it starts (e.g. its number of state partitions).
    """

    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf, self.saved = spark, conf, {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def state_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * MB) -> int:
    """State / shuffle partitions for a stream over ``input_bytes`` per run.

    About ``target_bytes`` per partition and at least one per core, so a
    partition's state does not grow with the input.
    """
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        cores = 8
    return max(1, cores, -(-input_bytes // target_bytes))
