"""Session settings and durable intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the skew handling rely on; all can be changed on a running session.
RUNTIME_SETTINGS = {
    # timestamps carry no zone: pin the session so that date arithmetic never meets a DST jump
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys are split at run time, even where that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Deletes the shuffle files of a query when it ends; on while an intermediate table is written, which is not run again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Where intermediate tables go when the cluster names no checkpoint folder.
SCRATCH_SETTING = "arrivo.scratch.dir"
_local_scratch: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "arrivo", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {"spark.ui.enabled": "false", **RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share.

    `spark.checkpoint.dir` if the session names one, else `arrivo.scratch.dir`. Only a local master, where
    everything runs in one process, may do without: it gets a temporary folder that goes with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            f"intermediate tables need a folder that all executors reach: set spark.checkpoint.dir or {SCRATCH_SETTING}"
        )
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="arrivo-"))
        atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
    return _local_scratch[0]


def scratch_root(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/arrivo/{spark.conf.get('spark.app.id', 'session')}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; call it when their results are written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def materialize(df: DataFrame, name: str, balanced: bool = False, codec: str | None = None) -> DataFrame:
    """Cut the lineage with a written table, which outlives any executor; what was shuffled for it is deleted.

    Parquet rather than `checkpoint()`: readers keep column pruning and the optimizer sees the size.
    `balanced` evens out the files (few for little data, no giant ones after a skewed join), which pays
    for its exchange where a fit reads the table many times. `codec` is how its files are compressed, if not as usual.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.hint("rebalance") if balanced else df).write.mode("overwrite").parquet(path, compression=codec)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_every_task(written: DataFrame) -> bool:
    """Does the planner send this written table to every task of a join instead of shuffling both sides?"""
    known = written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = written.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(known)) <= limit


def discard(*tables: DataFrame) -> None:
    """Delete the written intermediate tables that these read, once all that is made of them is written itself."""
    for df in tables:
        spark = df.sparkSession
        own = f"/arrivo/{spark.conf.get('spark.app.id', 'session')}/"
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if own in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
