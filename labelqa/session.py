"""Spark session helpers.

Everything in the package is a ``DataFrame -> DataFrame`` function; this
module only builds a session with the settings the operators assume and
resolves the shared folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splits a hot key of a sort-merge join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python paths see whole documents: bound rows per Arrow batch
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    # Python dict semantics for repeated keys: the later value wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "labelqa",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SCRATCH: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system and is used as is
    (it is read, never changed); a cluster run without it is an error. Only
    local runs (tests, benchmarks) fall back to a scratch folder, created
    once per application.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path and not str(sc.master).startswith("local"):
        # a machine-local folder is not shared between cluster nodes
        raise ValueError("set spark.checkpoint.dir to a shared folder for cluster runs")
    if not path:
        app = sc.applicationId
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.mkdtemp(prefix="labelqa-ckpt-")
        path = _SCRATCH[app]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def durable(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to parquet under the checkpoint folder and read it back.

    Used after external (paid, non-deterministic) calls so that later actions
    never re-run them and a lost executor only re-reads written files.
    """
    spark = spark or df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the input has fewer partitions than cores.

    Small inputs (one file, one row group) otherwise run CPU-heavy per-row
    work in a single task. On large inputs the scan already yields far more
    partitions than cores and this is a no-op (no extra shuffle).
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a remote session): leave as is
        return df
    return df.repartition(target) if current < target else df


ROWS_PER_TASK = 100_000     # tables beyond one such task per core get more tasks, so that slow ones weigh less


def spread_scan(df: DataFrame) -> DataFrame:
    """``spread`` for a table as read from files, by the rows that its tasks read.

    Parquet is cut at row groups, so a scan may have as many tasks as cores and
    still read all rows in a few of them. The rows of each task are counted (file
    footers only, no column is read), and the rows are dealt anew where a core
    would wait for the largest task; evenly cut tables stay as they are.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # a remote session: leave as is
        return df
    held = df.select(F.spark_partition_id().alias("task")).groupBy("task").count()
    tasks, most, rows = held.agg(F.count(F.lit(1)), F.max("count"), F.sum("count")).first()
    if tasks >= cores and most * cores <= 2 * rows:
        return df
    return df.repartition(min(4 * cores, max(cores, -(-(rows or 0) // ROWS_PER_TASK))))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``labelqa`` importable in Python workers (UDFs, ``mapInPandas``).

    Functions of the package are pickled by reference, so workers must
    import it; the package is zipped once per application and distributed
    with ``addPyFile`` (Spark's own file distribution).
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="labelqa-pkg-"), "labelqa.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
