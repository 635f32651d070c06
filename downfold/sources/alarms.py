"""Alarm table snapshots."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.schemas import ALARMS


def read_alarms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALARMS).parquet(path)


def stream_alarms(spark: SparkSession, path: str, max_files_per_trigger: int | None = 100) -> DataFrame:
    """Alarm files as a stream; files must land in arrival order."""
    reader = spark.readStream.schema(ALARMS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    lower_id: int,
    upper_id: int,
    partitions: int,
    fetch_size: int = 10_000,
    **extra,
) -> dict[str, str]:
    """Read in parallel ranges of the primary key; the bounds only shape the ranges."""
    options = {
        "url": url,
        "dbtable": table,
        "partitionColumn": "id",
        "lowerBound": str(lower_id),
        "upperBound": str(upper_id),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }
    return {**options, **{k: str(v) for k, v in extra.items()}}


def read_alarms_jdbc(spark: SparkSession, url: str, table: str = "histalarms", **options) -> DataFrame:
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ALARMS.fields])
