"""Shared helpers of the operators: table access and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names; in local mode an unset one is filled with a temporary folder."""
    path = spark.conf.get(SHARED_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SHARED_DIR} must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set(SHARED_DIR, path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def store_bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """store, with rows of equal key in one bucket: groupings and joins by key do not shuffle the table again."""
    spark = df.sparkSession
    name = f"axonweave_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", f"{shared_dir(spark)}/axonweave/{name}").saveAsTable(name)
    return spark.table(name)


def store(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, survives lost executors,
    and keeps later steps from computing it again. The folder may be emptied when the job is over."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/axonweave/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
