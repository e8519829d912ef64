"""Session helpers: one place that reads cluster settings, never hard-codes them."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cpus: int | str = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench.  A cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gavelspark")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


#: Local folders made for sessions without a configured one, and folders written in shared ones.
_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, shared by all executors.

    Only where a session has neither that setting nor a checkpoint folder (unit
    tests on one machine) a temporary local folder is set; it is removed at the end.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = spark.sparkContext.applicationId
    if own not in _made:
        _made[own] = tempfile.mkdtemp(prefix="gavelspark-", dir=os.environ.get("TMPDIR"))
        atexit.register(shutil.rmtree, _made[own], ignore_errors=True)
    return f"file://{_made[own]}"


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder, removed at the end of the program as far as the
    session still lives then."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session may be over; then the folder's owner clears it
        return


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a table in the shared folder: columns can be read alone."""
    spark = df.sparkSession
    path = shared_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
