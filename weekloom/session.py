"""Session settings the operators rely on, and the shared staging area."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Session behaviour every operator assumes.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Bytes one shuffle or scan partition should hold.
PARTITION_BYTES = 256 * 1024 * 1024


def sized_conf(input_bytes: int, cores: int = 1) -> dict[str, str]:
    """Partition settings for an input of this size.

    AQE merges small shuffle partitions but never splits below the initial
    number, so that number has to suit the largest shuffle, which is about the
    size of the input.
    """
    wanted = -(-input_bytes // PARTITION_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(max(1, cores, wanted)),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES // 2),
    }


def build_session(app_name: str = "weekloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with UTC, AQE and skew handling switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def local_session(cpus: int = 8, app_name: str = "weekloom-local",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A single-machine session for tests and the bench."""
    local = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": "12g",
        "spark.driver.extraJavaOptions": "-Xss16m",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session(app_name, f"local[{cpus}]", {**local, **(conf or {})})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: whatever ``spark.checkpoint.dir`` names.

    A local session without that setting stages under its warehouse, the one
    folder Spark itself shares; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging/{spark.sparkContext.applicationId}"
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the staging root and return the table read back.

    Cuts the lineage, survives executor loss, and lets later steps read only
    the columns they need.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/weekloom/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
