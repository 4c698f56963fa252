"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the library relies on; all are runtime-settable SQL options.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "rillstream", cpus: int | str = "*", shuffle: int = 8) -> SparkSession:
    """Single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.driver.memory", os.environ.get("RILL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per expression
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if sc.getCheckpointDir() is None:
        folder = named
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="rillstream-")
        sc.setCheckpointDir(folder)
    return named or sc.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df):
    """Truncate lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, label: str = "stored"):
    """(the same rows as a table in the shared folder, their number): cuts lineage with one pass over the rows."""
    where = scratch(df.sparkSession, label)
    df.write.parquet(where)
    table = df.sparkSession.read.schema(df.schema).parquet(where)
    return table, table.count()  # from the footers
