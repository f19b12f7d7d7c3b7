"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions (hot tokens, hot topics); the UI is off
# because no server may be started.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Model calls have side effects and cost money: never run a task twice on
    # purpose.
    "spark.speculation": "false",
}


def get_spark(app: str = "supportlens", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with ``DEFAULT_CONF``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    submitted = os.environ.get("PYSPARK_SUBMIT_ARGS", "") or os.environ.get("SPARK_ENV_LOADED")
    conf = dict(DEFAULT_CONF)
    if master or not submitted:  # else spark-submit's master and memory stand
        builder = builder.master(master or "local[*]")
        conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not submitted:
        conf["spark.sql.shuffle.partitions"] = "8"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets this to a shared filesystem; it is only
    filled in here when unset (local runs and tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="supportlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


class scratch_scope:
    """Collects the tables that ``materialize(..., scope=...)`` writes and
    deletes them on exit (e.g. per stream micro-batch, once its output is
    written). A scope only ever holds the tables written for it, so streams and
    batch queries of one process cannot delete each other's."""

    def __init__(self, spark):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        delete_paths(self.spark, self.paths)
        self.paths.clear()
        return False


def delete_paths(spark: SparkSession, paths) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def materialize(df, spread_out: bool = False, scope: scratch_scope | None = None):
    """Write an intermediate once as Parquet under the shared checkpoint folder
    and continue from that table.

    One job computes and writes the data (``Dataset.checkpoint`` of an
    unpersisted plan computes it twice: once to count, once to write), the
    lineage is cut, the result survives executor loss (unlike a cache), and
    AQE sees its real size when planning the next joins. ``spread_out``: see
    below. A table written for a ``scope`` goes with it; others stay until the
    shared folder is cleared, since a lazy result may read them at any time.
    """
    import uuid

    from .sources.tables import spread

    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{uuid.uuid4().hex}")
    df.write.parquet(path)
    if scope is not None:
        scope.paths.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    # A small result is often one file (AQE coalesces small partitions); a
    # consumer doing heavy per-row work (model calls, k-means) asks for it to
    # be spread over all task slots again.
    return spread(back) if spread_out else back


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None) -> None:
    """Make this package importable in executor Python workers.

    Pandas UDFs and ``mapInPandas`` functions refer to this package's
    functions, so the workers must import it. The package is zipped once per
    application and registered with ``SparkContext.addPyFile`` (what
    ``--py-files`` does); Spark ships it to every executor.
    """
    import os
    import zipfile

    if spark is None:  # no session in this thread yet: nothing to ship to
        return
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    archive = os.path.join(tempfile.mkdtemp(prefix="supportlens-pyfiles-"), "supportlens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, filenames in os.walk(pkg):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in filenames:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
