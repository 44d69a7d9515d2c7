"""Session helpers shared by tests, bench and applications."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", name: str = "tessera", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects (UTC, Arrow, AQE)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    attach(spark)
    return spark


def attach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (clusters install it or use --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; where it is unset, a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    configured = configured or os.environ.get("TESSERA_CHECKPOINT_DIR")
    if configured is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Repartition an input that has fewer splits than there are cores, so Python stages use the whole cluster."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, for stages handed over as files."""
    import uuid

    ensure_checkpoint_dir(spark)
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{base}/{name}-{uuid.uuid4().hex}"
