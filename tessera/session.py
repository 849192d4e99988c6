"""Session construction, table loading and lineage cutting."""

from __future__ import annotations

import gc
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


#: By application, the folder of a local session without the setting.
_OWN_FOLDERS: dict[str, str] = {}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """Local session for tests and benchmarks.

    On a cluster the session is normally provided by the launcher; every
    operator in the library only takes a DataFrame and never builds one.
    """
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session
    whose tasks run in the driver's own process (tests) gets a folder of its own; a
    cluster is an error, as its executors would not see a folder of the driver's machine.
    """
    app = spark.sparkContext.applicationId
    path = spark.conf.get("spark.checkpoint.dir", None) or _OWN_FOLDERS.get(app)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # a running session does not take the setting, so the folder is kept here
        path = _OWN_FOLDERS[app] = "file://" + tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files that no plan can read again; else they stay until the driver's JVM happens to collect its garbage."""
    gc.collect()
    time.sleep(1)  # the JVM hears of it on another thread
    spark.sparkContext._jvm.System.gc()


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
