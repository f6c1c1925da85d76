"""Session helpers: session construction, table access, lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder.

    The folder is the cluster's ``spark.checkpoint.dir``. Only a local session
    (tests, a single machine) gets a temporary one where that is unset; on a cluster it is an error,
    as a machine's own folder would not survive that machine.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="qirtas-ckpt-"))
    return df.checkpoint(eager=eager)
