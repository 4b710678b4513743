"""Session settings the flows rely on, and the folder for tables a job writes on the way."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

PARTITION_BYTES = 128 * 1024 * 1024


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a shuffle of ``input_bytes``: partitions of 128 MB, two per core at least.

    AQE merges partitions that turn out small, so a generous number costs little.
    """
    partitions = max(2 * cores, -(-input_bytes // PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path in the session's checkpoint folder, which all executors share.

    Only a local session without that setting gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="rosterline-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Folders that ``staged`` has written in this process and that ``clear_staged`` deletes, and the
#: names of those that are tables in buckets.
STAGED: list[str] = []
BUCKETED: list[str] = []

#: Tables that are written at the same time.
AT_ONCE = 4


def clear_staged(spark: SparkSession) -> None:
    """Delete the staged tables; for when the results that read them have been written."""
    while BUCKETED:
        spark.sql(f"DROP TABLE IF EXISTS {BUCKETED.pop()}")
    while STAGED:
        root = spark._jvm.org.apache.hadoop.fs.Path(STAGED.pop())
        root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def staged(df: DataFrame, purpose: str, *folders: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for results that are used several times.

    The table outlives lost executors, and its readers prune columns and rows again. With
    ``folders``, columns of few values, a reader that asks for some of them opens no others.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.partitionBy(*folders).option("compression", "zstd").parquet(path)
    STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_buckets(df: DataFrame, purpose: str, key: str) -> DataFrame:
    """``df`` written in buckets of ``key``, as many as there are shuffle partitions.

    Joins of such tables on their key need no shuffle. The rows are shuffled here, so that each
    bucket is one file.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_folder(spark, purpose)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    STAGED.append(path)
    BUCKETED.append(name)
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option(
        "path", path
    ).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def staged_together(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``staged`` for several tables, some of them at the same time."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        made = list(pool.map(lambda item: staged(item[1], item[0]), tables.items()))
    return dict(zip(tables, made, strict=True))
