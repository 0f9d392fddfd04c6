"""Session helpers: a local builder for tests and the shared checkpoint folder."""

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, name="teamlines", **conf):
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark):
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only where nothing is named and the session is a single local
    process; it goes when that process ends. In a named folder the files, all under
    ``teamlines-*``, stay as long as results that read them may be used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="teamlines-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def checkpointed(df):
    """``df`` written to the shared folder, with its lineage cut there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def scratch_path(spark, prefix="frame"):
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/teamlines-{prefix}-{uuid.uuid4().hex}"


def materialized(df, release=False):
    """``df`` written to Parquet in the shared folder and read back.

    For frames that several jobs read, such as the inputs of model fits: the lineage is
    cut, the files survive lost executors, and readers still prune columns. ``release`` asks for
    :func:`release_shuffles` after the write, for frames as large as the input.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    if release:
        release_shuffles(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def release_shuffles(spark):
    """Frees the disk of shuffles that no plan refers to any more.

    Spark deletes a shuffle's files once the driver's collector finds its plan gone, by default within half an hour;
    a run that writes one large frame after another would hold the files of all of them until then.
    """
    gc.collect()  # Python's references to plans go first
    spark.sparkContext._jvm.System.gc()
