"""Spark session helpers.

The library never sets cluster-wide knobs on a session it did not create,
except the session time zone, which every timestamp rule here assumes is UTC
(the reference stores TIMESTAMPTZ and reasons in UTC days).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# A landed payload can be tens of MB (one GTFS-realtime feed is ~30 MB), so
# Arrow batches to Python workers are cut by bytes as well as by rows.
ARROW_MAX_BYTES = 128 * 1024 * 1024


def build_session(master: str | None = None, app: str = "movelake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and benches. On a cluster, pass master=None and let
    spark-submit supply the master; size shuffle partitions to the data
    (AQE coalesces small ones at runtime)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(ARROW_MAX_BYTES),
        "spark.driver.memory": "16g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Day chunks, minute buckets and RFC 3339 parsing are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables and stream checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system). Only when it is unset -- local tests -- do we create one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: tables, dead letters and "
                               "stream checkpoints must outlive any one machine")
        d = tempfile.mkdtemp(prefix="movelake-ckpt-")  # local runs only (tests)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at runtime; the context dir below suffices
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    base = shared_dir(spark)
    return f"{base}/movelake/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def makedirs_if_local(path: str) -> None:
    if is_local_path(path):
        os.makedirs(local_fs_path(path), exist_ok=True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``movelake`` importable in Python workers (what ``--py-files``
    does on a cluster): zip the package once per application and add it
    with ``addPyFile``. Called before any Python step (mapInPandas)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    bound_arrow_batches(spark)
    import movelake
    pkg = os.path.dirname(os.path.abspath(movelake.__file__))
    base = shared_dir(spark)
    target_dir = (local_fs_path(base) if is_local_path(base) else tempfile.mkdtemp(prefix="movelake-pkg-"))
    os.makedirs(f"{target_dir}/movelake-pkg", exist_ok=True)
    zpath = f"{target_dir}/movelake-pkg/movelake-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def bound_arrow_batches(spark: SparkSession, max_bytes: int = ARROW_MAX_BYTES) -> None:
    """Cut Arrow batches to Python workers at ``max_bytes`` unless the
    session already sets a byte bound (default is unbounded), so a batch
    of large payloads cannot exhaust a worker's memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    cur = spark.conf.get(key, None)
    try:
        unbounded = cur is None or int(str(cur)) >= 2**31 - 1 - 1024
    except ValueError:
        unbounded = False  # a user-set size with a unit: keep it
    if unbounded:
        spark.conf.set(key, str(max_bytes))
