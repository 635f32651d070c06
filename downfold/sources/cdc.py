"""Change-event sources (Kafka, stream and batch)."""

from pyspark.sql import DataFrame, SparkSession

from downfold.constants import CDC_GROUP, CDC_TOPIC


def cdc_options(
    brokers: str,
    topic: str = CDC_TOPIC,
    group: str = CDC_GROUP,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = 5_000_000,
) -> dict[str, str]:
    """Reader options. The offset cap bounds a micro-batch and with it every key's group."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "groupIdPrefix": group,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def _messages(df: DataFrame) -> DataFrame:
    return df.selectExpr("topic", "partition", "offset", "timestamp", "cast(value as string) as value")


def read_cdc_stream(spark: SparkSession, brokers: str, topic: str = CDC_TOPIC, **options) -> DataFrame:
    """Unbounded change events. Offsets live in the query's checkpoint, not in the group."""
    reader = spark.readStream.format("kafka").options(**cdc_options(brokers, topic, **options))
    return _messages(reader.load())


def read_cdc_batch(spark: SparkSession, brokers: str, topic: str = CDC_TOPIC, **options) -> DataFrame:
    """The topic's retained change events as a bounded table."""
    given = cdc_options(brokers, topic, max_offsets_per_trigger=None, **options)
    return _messages(spark.read.format("kafka").options(**given).load())
