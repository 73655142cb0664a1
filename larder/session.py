"""Session helpers: settings, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "larder", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for.

    Partition counts are left to adaptive execution on a cluster; pass
    ``spark.sql.shuffle.partitions`` only where it is known to fit.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables that cut lineage: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves a local session; on a
    cluster a machine-local folder would be lost with its machine, so the job
    stops instead.
    """
    found = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="larder-")
    spark.conf.set(CHECKPOINT_KEY, made)
    return made


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh location below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is read several times, or where each round of an
    iteration builds on the last: it survives lost executors, and unlike an RDD
    checkpoint the files carry sizes that the join planner can see.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`materialize` whose readers are done."""
    for table in tables:
        for place in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            delete_path(table.sparkSession, place)


def delete_path(spark: SparkSession, place: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(place)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, place: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(place)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
