"""Session construction, table loading and the shared work folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings of local sessions (tests, bench), and those every docflow job wants;
# the latter are applied only where the cluster or the caller sets nothing.
LOCAL_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows here are whole documents or file bodies: bound Arrow batches by
    # bytes as well as rows, so a batch sent to Python fits a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "docflow",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with docflow's defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(LOCAL_CONF) if master and master.startswith("local") else {}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()                    # spark-defaults, submit options and the above
    for k, v in DEFAULT_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's, or a local one in tests."""
    return _checkpoint_root(spark)


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - unset key on some versions
            root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        # A machine-local folder serves a single-process session only: on a
        # cluster each executor would write to its own disk.
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="docflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Every call gives a new sub-folder, so re-running a job never sees the
    files (or streaming checkpoints) of an earlier run.
    """
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/docflow/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop FileSystem serving ``path`` (any URI scheme) and the Path."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table of an sf folder, e.g. ``table(spark, d, "events")``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``docflow`` importable in the Python workers (like ``--py-files``).

    Steps that run Python on executors (``mapInPandas``) unpickle docflow
    functions and classes there. The package is zipped once per
    application into the shared folder and added with ``addPyFile``; a
    cluster that installs docflow on its executors loses nothing by it.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, base))
    path = shared_dir(spark, "pkg") + "/docflow.zip"
    fs, jpath = hadoop_fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(app)
