"""Session construction and shared-storage helpers."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from real shuffle sizes
# (size-checked broadcast with a sort-merge fallback), splits skewed join
# partitions and coalesces small shuffle outputs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "strata", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings applied.

    ``master`` defaults to ``local[$STRATA_CPUS or *]`` only when no master is
    configured, so the same call works under spark-submit on a cluster.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    elif not os.environ.get("SPARK_MASTER") and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        b = b.master(f"local[{os.environ.get('STRATA_CPUS', '*')}]")
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master
    (tests, a laptop) gets a temporary folder if it is unset.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint dir for staged tables/files.

    Every executor can read it (unlike a machine-local temp folder).  With
    ``unique`` a fresh sub-folder is returned per call so reruns never
    overwrite data another job may still be reading.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p)
    path = f"{base}/strata/{leaf}" if leaf else f"{base}/strata"
    if unique:
        path = f"{path}/{uuid.uuid4().hex[:12]}"
    return path


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` in the shared checkpoint folder.

    Reliable checkpoint (never ``localCheckpoint``): the files survive the loss
    of the executor that wrote them, and later stages re-read them instead of
    recomputing a long lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return _bounded_estimate(df.checkpoint(eager=eager))


_UNKNOWN_BYTES = (1 << 63) - 1      # what Spark takes for a frame of unknown size


def _bounded_estimate(df):
    """A checkpoint without the size that its plan was estimated at, if Spark's own
    figure for unknown sizes is smaller (plans are the same: nothing of either size
    is broadcast).

    A join is estimated at the product of its inputs, and a checkpoint keeps that:
    in a loop of joins the number's digits double with every round until they fill
    the driver's memory."""
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD" or plan.stats().sizeInBytes() <= _UNKNOWN_BYTES:
        return df
    jvm, session = df.sparkSession._jvm, df._jdf.sparkSession()
    plain = jvm.org.apache.spark.sql.execution.LogicalRDD(
        plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(), plan.stream(),
        session, jvm.scala.Option.empty(), jvm.scala.Option.apply(plan.constraints()))
    return type(df)(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, plain), df.sparkSession)


def stage_columns(df):
    """Materialise ``df`` as Parquet files in the shared checkpoint folder.

    Like :func:`cut_lineage`, for frames that several jobs read by a few columns
    each: a checkpoint holds whole serialised rows, so every reader pays for all
    columns; here columns and row groups that a job does not need are skipped.
    """
    path = shared_dir(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``strata`` importable on executors (needed wherever Python runs
    inside tasks, e.g. ``mapInPandas``): zip the package once per
    SparkContext and add it with ``addPyFile``, the programmatic form of
    ``--py-files``.  A no-op when the package is already shipped."""
    import os
    import tempfile
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="strata-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
