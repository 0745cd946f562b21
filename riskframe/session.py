"""Spark session helpers.

The library never creates its own session inside an operator: every operator takes a DataFrame and
returns a DataFrame.  These helpers exist for tests, ``bench.py`` and the command-line plans.
"""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings of our local sessions (results do not depend on them; timestamps are zone-free).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "riskframe") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is.  Only when it is unset (a bare
    local test session) do we pick a fresh scratch folder of our own; a cluster without it is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    path = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or (current.get() if current.isDefined() else None))
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    if current.isEmpty():
        sc.setCheckpointDir(path)
    return path


def materialize(df, keep_partitioning: bool = False):
    """Cut lineage with a reliable checkpoint into the shared ``spark.checkpoint.dir`` folder.

    Used where a result feeds several passes (rank cuts read their input three times) so that an
    expensive upstream plan is computed once, and a lost executor recomputes from the checkpoint.

    ``keep_partitioning``: the checkpoint remembers the hash partitioning of ``df`` (e.g. after
    ``repartition(n, keys)``), so later ``groupBy(keys)`` stages need no exchange.  Adaptive execution
    hides the partitioning from the checkpoint, so it is switched off for this one action.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not keep_partitioning:
        return df.checkpoint(eager=True)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riskframe`` importable by the Python workers that run our pandas functions.

    Zips the package's ``.py`` files once per application into the shared checkpoint folder (through the
    Hadoop FileSystem API, so any cluster file system works) and registers the zip with
    ``SparkContext.addPyFile``; Spark copies it to every executor, including executors added later.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    base = ensure_checkpoint_dir(spark).rstrip("/")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/riskframe-code/riskframe-{key}.zip")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(key)
