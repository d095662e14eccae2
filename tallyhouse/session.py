"""Session defaults and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Only runtime SQL confs are set here, so
# the helper is safe to call on a session someone else created.
_SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.exchange.reuse": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def configured(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings the operators rely on, for a while: the session's own
    come back at the end."""
    before = {key: spark.conf.get(key, None) for key in _SQL_DEFAULTS}
    try:
        yield configure(spark)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            elif spark.conf.get(key, None) != value:
                spark.conf.set(key, value)


def build_local_session(cores: int = 8, shuffle_partitions: int = 8,
                        app: str = "tallyhouse") -> SparkSession:
    """Session used by tests and the benchmark (never on a cluster)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _shared(path: str, local: bool) -> str:
    """A checkpoint folder, unless it is in a machine's temporary folder on
    a cluster: other machines would not see what is written there."""
    plain = path.removeprefix("file:").lstrip("/")
    own = os.environ.get("TMPDIR", "").lstrip("/").rstrip("/")
    if not local and path.startswith(("file:", "/")) and own and plain.startswith(f"{own}/"):
        raise RuntimeError(f"spark.checkpoint.dir is this machine's temporary folder: {path}")
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a local-mode session without one (tests) gets a fresh
    scratch folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if current:
        return _shared(current, local)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return _shared(sc.getCheckpointDir(), local)
    if not local:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="tallyhouse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def write_through(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint folder (the
    cluster's shared scratch) and read it back. Cuts lineage and pins
    non-deterministic ids like a checkpoint, but the result keeps file
    statistics (size-checked broadcasts work), column pruning and filter
    pushdown."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    folder = _SCRATCH[-1] if _SCRATCH else "tallyhouse-tables"
    path = f"{root}/{folder}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Scratch folders of the batches being run, innermost last.
_SCRATCH: list[str] = []


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """Within it, ``write_through`` writes to one folder, which is removed
    at the end: what is read later must have been written elsewhere."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"tallyhouse-tables/scratch-{uuid.uuid4().hex}"
    _SCRATCH.append(name)
    try:
        yield f"{root}/{name}"
    finally:
        _SCRATCH.remove(name)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan, if available."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))  # py4j gives an int or a BigInt proxy
    except Exception:  # Spark Connect or plan without statistics
        return None
