"""Session helpers: building a local session for tests/bench and finding a shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "erascore") -> SparkSession:
    """A local session configured the way the library expects a cluster session to be configured."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``erascore`` importable in the Python workers (pandas UDFs, ``mapInPandas``).

    Zips the package once per application and registers it with ``addPyFile`` -- what
    ``--py-files`` does at submit time; Spark distributes the file to every executor."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    target = os.path.join(tempfile.mkdtemp(prefix="erascore-pyfiles-"), "erascore.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(target)
    else:
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(app)


def prepare_session(spark: SparkSession) -> str:
    """Library set-up for a session the caller created: package shipped to the workers and a
    checkpoint folder (the cluster's own when configured)."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; only when none is configured and the session is
    local (a test) create a private one under the system temp folder. On a cluster without one this raises: a
    folder of one machine would be invisible to the others."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        configured = tempfile.mkdtemp(prefix="erascore-ckpt-")
        atexit.register(shutil.rmtree, configured, True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables, inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "erascore-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def release_cached() -> int:
    """Free the intermediates the library persisted (range-numbered frames, counted broadcast
    tables, report tables) once their results have been consumed."""
    from .operators.sizing import release_cached as _release

    return _release()
