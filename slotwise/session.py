"""Session defaults and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Row limits per group are applied in every task before the shuffle, however large they are.
GROUP_LIMIT, ANY_COUNT = "spark.sql.optimizer.windowGroupLimitThreshold", str(2**31 - 1)


def build_session(app: str = "slotwise", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator expects; `conf` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        GROUP_LIMIT: ANY_COUNT,
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on, for sessions built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(GROUP_LIMIT, ANY_COUNT)
    return spark


def _scratch_root(spark: SparkSession) -> str:
    """The folder for scratch tables below `spark.checkpoint.dir`, which all executors share. Without
    that setting a session in one process uses its warehouse; a cluster has to name a folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/slotwise"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all scratch tables. Results read from them lazily, so call it when the results of a
    job are written and no other job uses the folder. False if there were none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: for a frame several parts of a
    plan need, so that they, and retries after a lost executor, do not compute it again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
