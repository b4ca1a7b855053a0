"""Sessions and durable intermediate tables.

Every multi-step operator cuts its lineage by writing a compact parquet table
below the folder that the cluster names in ``spark.checkpoint.dir``.  That
folder is shared by all executors, so a lost executor costs a re-read and never
a recomputation of the steps before it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: list[str] = []
_USED: set[str] = set()


def local_session(cpus: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gristmill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables below the cluster's ``spark.checkpoint.dir``; it is removed when the application ends.

    Only where that setting is absent and all runs on one machine (tests, a
    laptop) a private folder is made; a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN_DIRS:
            own = tempfile.mkdtemp(prefix="gristmill-")
            _OWN_DIRS.append(own)
            atexit.register(shutil.rmtree, own, True)
        return f"file://{_OWN_DIRS[0]}/{spark.sparkContext.applicationId}"
    path = f"{named.rstrip('/')}/gristmill-{spark.sparkContext.applicationId}"
    if path not in _USED:
        _USED.add(path)
        full = spark._jvm.org.apache.hadoop.fs.Path(path)
        full.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(full)
    return path


def durable(df: DataFrame, sort_within: list[str] | None = None) -> DataFrame:
    """Write ``df`` below :func:`shared_dir` and return a scan of the written table."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
