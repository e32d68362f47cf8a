"""Session helpers: one place for the confs every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CKPT: str | None = None
_SHIPPED: set[str] = set()


def get_session(master: str | None = None, app: str = "marquee",
                shuffle_partitions: int | None = None, driver_memory: str = "16g") -> SparkSession:
    """Build (or reuse) a session with AQE on, UI off and UTC time.

    ``master`` is only set for local runs and tests; on a cluster the
    launcher decides it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        # local mode: the driver JVM is the only executor, size its heap
        b = b.master(master).config("spark.driver.memory", driver_memory)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    on a local master (tests) a private temporary folder is created and registered.
    """
    global _LOCAL_CKPT
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="marquee-ckpt-")
        d = _LOCAL_CKPT
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    ship_package(spark, d)
    return d


def ship_package(spark: SparkSession, shared_dir: str) -> None:
    """Make ``marquee`` importable in Python workers (once per application).

    Functions handed to Spark (UDF helpers, partition kernels) are pickled by
    reference to this package. The zip is written to the shared folder and
    distributed with ``addPyFile``; a deployment that already ships the
    package with ``--py-files`` can set ``marquee.shipped=true``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or spark.conf.get("marquee.shipped", "false") == "true":
        return
    import io
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    local = shared_dir[len("file:"):] if shared_dir.startswith("file:") else shared_dir
    if "://" in local:
        tmp = tempfile.mkdtemp(prefix="marquee-pkg-")
        target = os.path.join(tmp, "marquee.zip")
    else:
        os.makedirs(local, exist_ok=True)
        target = os.path.join(local, f"marquee-{app}-{uuid.uuid4().hex[:8]}.zip")
    with open(target, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/marquee-{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
