"""Session construction and the shared checkpoint folder."""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once their RDDs are unreachable (marts are separate files)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidewell", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` wins.  Only a local-mode
    session (tests, laptops) may fall back to a private temporary folder; on a
    cluster a machine-local folder would lose checkpoints with the executor,
    so an unset setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tidewell-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def observer_session(spark: SparkSession) -> SparkSession:
    """A session of its own for jobs that observe metrics, with the settings of
    ``spark``.  A session that has observed metrics can no longer be serialized,
    and the training summary of a fitted Spark ML model holds its session: the
    caller's session is kept out of it."""
    out = getattr(spark, "_tidewell_observer", None)
    if out is None:
        out = spark._tidewell_observer = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if out.conf.isModifiable(key) and out.conf.get(key, None) != value:
            out.conf.set(key, value)
    return out


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewell`` importable by Python workers (needed by the few
    pandas UDF / mapInPandas closures): zip the package once per context and
    register it with addPyFile, which distributes it to every executor."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewell_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tidewell-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._tidewell_shipped = True


class sql_conf:
    """Temporarily set session SQL options, restoring the previous values.

    Used around driver loops of many tiny, fixed-shape jobs (Lloyd
    iterations, likelihood evaluations): their plans are already optimal —
    a broadcast of a parameter-sized local table and an aggregate to a
    parameter-sized result — so adaptive re-planning only adds a per-stage
    round trip to every iteration."""

    def __init__(self, spark: SparkSession, options: dict[str, str]):
        self.spark, self.options, self.saved = spark, options, {}

    def __enter__(self):
        for k, v in self.options.items():
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


def static_plans(spark: SparkSession, shuffle_partitions: int | None = None) -> sql_conf:
    opts = {"spark.sql.adaptive.enabled": "false"}
    if shuffle_partitions:
        opts["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return sql_conf(spark, opts)


# bytes that a task should take from storage or a shuffle: its sorts and hash tables, about
# four times that each, then fit the memory a core has on small executors
TASK_BYTES = 16 << 20
# bytes of stored input for which a shuffle has a partition of its own before AQE joins small
# ones: AQE never cuts one, so their number has to follow the input
SHUFFLE_BYTES = 4 << 20


def _bytes(setting: str) -> int:
    n, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", setting.strip().lower()).groups()
    return int(n) << (10 * " kmgt".index(unit or " "))


def sized_tasks(spark: SparkSession, input_bytes: int) -> sql_conf:
    """Tasks by bytes for the writes of large layers: by default a task takes 64 MB of
    a compressed shuffle or 128 MB of files, and its sorts spill.  Lower settings stay."""
    limits = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    parts = max(int(spark.conf.get(initial, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-input_bytes // SHUFFLE_BYTES))
    return sql_conf(spark, {k: str(min(_bytes(spark.conf.get(k)), TASK_BYTES)) for k in limits} | {initial: str(parts)})
