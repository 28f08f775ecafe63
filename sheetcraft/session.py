"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every sheetcraft job relies on: UTC wall clock (timestamps are
# zone-less exports), AQE for runtime join/partition choices and skew splits.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app: str = "sheetcraft",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only with a local
    master, as in tests, a fresh folder is made where it is unset; elsewhere
    that raises, as a folder of one machine would not do.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="sheetcraft-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def shared_base(spark: SparkSession) -> str:
    """Base of the shared folder (``spark.checkpoint.dir``), without the
    per-application suffix Spark adds."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        ensure_checkpoint_dir(spark)
        base = spark.conf.get("spark.checkpoint.dir")
    return base.rstrip("/")


def _scratch_base(spark: SparkSession) -> str:
    return f"{shared_base(spark)}/sheetcraft/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one job's written tables."""
    path = f"{_scratch_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    local = local_path(path)
    if local is not None:
        os.makedirs(local, exist_ok=True)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; call it when its results
    are stored, as DataFrames may still read them."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(_scratch_base(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def local_path(path: str) -> str | None:
    """POSIX path for a ``file:`` URI or a plain path; None for other schemes."""
    if path.startswith("file:"):
        rest = path[len("file:"):]
        while rest.startswith("//"):
            rest = rest[1:]
        return rest
    if "://" in path:
        return None
    return path


def ship_package(spark: SparkSession) -> None:
    """Make ``sheetcraft`` importable in Python workers (``addPyFile`` of a
    zip written once per application into the shared folder)."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_sheetcraft_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target_dir = scratch_dir(spark, "pyfiles")
    local = local_path(target_dir)
    if local is None:
        local = tempfile.mkdtemp(prefix="sheetcraft-pyfiles-")
    zpath = os.path.join(local, "sheetcraft.zip")
    with zipfile.ZipFile(zpath, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    sc._sheetcraft_shipped = True


def scale_conf(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Settings sized to the input: enough initial shuffle partitions that
    each holds about ``target_partition_bytes`` (AQE coalesces small ones and
    splits skewed ones), at least two waves of tasks, and scan splits of the
    same size.  Pass the result as ``extra`` to ``build_session`` or to
    ``spark-submit --conf``."""
    slots = max(1, executors * cores_per_executor)
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(2 * slots, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
