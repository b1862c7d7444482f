"""Spark session and shared-folder helpers.

Every job in this package is a DataFrame plan; the only state it keeps
outside Spark is files in the shared folder the cluster names in
``spark.checkpoint.dir``.  That folder is read from the session and only
set here when nothing set it (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = "*", app: str = "trainprep", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus)))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # folders of many small text / JSON files: count an open as 256 KB,
        # not 4 MB, so small files pack into fewer, fuller tasks
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        # checkpoint files of frames that went out of scope are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TRAINPREP_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="trainprep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/trainprep-{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``trainprep`` importable on the executors (``addPyFile``).

    Arrow / pandas functions are pickled by reference to their module, so
    the workers must be able to import the package wherever the driver runs.
    The zip is written once per application into the shared scratch folder.
    """
    import io
    import zipfile

    from pyarrow import fs

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.join("trainprep", os.path.relpath(full, root)))
    target = f"{scratch_dir(spark, 'pyfiles')}/trainprep.zip"
    filesystem, inner = fs.FileSystem.from_uri(target)
    filesystem.create_dir(os.path.dirname(inner), recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
