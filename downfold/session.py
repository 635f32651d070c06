"""Session settings and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Days, hours and wall-clock casts below are all defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, shared by all executors.

    The setting belongs to the cluster. Only where it is unset and Spark runs in
    local mode (tests) is a temporary folder used; on a cluster that is an error,
    because executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="downfold-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder, for results that several plans reuse."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
