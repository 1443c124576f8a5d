"""SparkSession construction and shared-folder resolution."""

from __future__ import annotations

import logging
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at every scale: AQE re-plans joins and coalesces
# small shuffle partitions, skew-join splits hot join keys, UTC keeps
# timestamps comparable with other engines, no UI server is started.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints (rank inputs) are removed once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lapworks", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local") and "spark.sql.warehouse.dir" not in (extra or {}):
        # local runs only: keep managed tables out of the working directory
        conf["spark.sql.warehouse.dir"] = os.environ.get("LAPWORKS_WAREHOUSE") or tempfile.mkdtemp(
            prefix="lapworks-wh-", dir=os.environ.get("TMPDIR", "/tmp"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A cluster names it; only when it is unset (local tests) do we create
    a scratch folder of our own.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    if sc is not None:
        d = d or sc.getCheckpointDir()
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            # Unset, one process (local runs and tests): take a scratch folder of our own.
            d = tempfile.mkdtemp(prefix="lapworks-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set for this session")
    return d


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    The sources are zipped once per Spark application and distributed by
    ``addPyFile``; a cluster needs no installed copy and no PYTHONPATH.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lapworks_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lapworks-src-"), "lapworks_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in sorted(os.walk(here)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.join("lapworks", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._lapworks_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df):
    """Compute ``df`` once into the shared folder (a reliable ``checkpoint``):
    later actions read the stored rows instead of recomputing the plan, and a
    lost executor does not lose them (unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Removes a folder of any file system that Spark can write; False (and a warning) if
    that fails, as under Spark Connect, where the client has no file system."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    except Exception:
        logging.getLogger("lapworks").warning("Folder %s could not be removed.", path)
        return False


def recommended_conf(input_bytes: int, cores: int, *, shuffle_target: int = 200 << 20,
                     scan_split: int = 256 << 20) -> dict:
    """Partition sizing for an input of ``input_bytes`` on ``cores`` task slots.

    Shuffle partitions aim at ~200 MB each (a multiple of the slots, at least one
    wave); scans split at 256 MB; AQE coalesces towards 128 MB and treats a
    partition five times the median and above 512 MB as skewed.  The distributed
    rank / rolling / median use the shuffle partitions as their number of ranges.
    """
    waves = max(1, -(-input_bytes // (shuffle_target * max(cores, 1))))
    return {
        "spark.sql.shuffle.partitions": str(max(cores, 1) * waves),
        "spark.sql.files.maxPartitionBytes": str(scan_split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }
