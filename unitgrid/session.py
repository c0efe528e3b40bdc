"""Session defaults and the shared scratch folder used to cut long lineages."""

import os
import sys
import tempfile
import uuid

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import SparkSession


def local_session(cpus="8", app="unitgrid", shuffle_partitions=None):
    """Session for tests and the bench; a cluster brings its own."""
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_by_value(module_name):
    """Send a module's functions to the executors with the job, so they need no installed package."""
    register_pickle_by_value(sys.modules[module_name])


def scratch_root(spark):
    """Shared folder for intermediate tables: the session's `spark.checkpoint.dir`.

    Only a session that names none (a local test) falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark, label):
    return f"{scratch_root(spark)}/unitgrid/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df, label="step"):
    """Write `df` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, pins the result of anything that depends on row
    placement, and gives the optimizer real sizes for its broadcast decisions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables):
    """Delete tables that `materialize` returned; nothing may read them any more."""
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def numbered(spark, folder, prefix, complete=False):
    """Numbers of the folders `prefix<number>` in `folder`, ascending; none if it does not exist.

    With `complete` only those whose write has ended (they hold a _SUCCESS file).
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    where = path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(p.getName()[len(prefix):]) for p in found if p.getName().startswith(prefix) and (not complete or fs.exists(path(p, "_SUCCESS"))))
